"""The pipeline's rows against plain Python, stage by stage."""

import hashlib

import numpy as np
import public_tokenizers as P
import tiktoken

import corpus_pipeline
from heliopanel.llm import byte_bpe, mixing, quality, secret_scan
from heliopanel.llm.common import table
from tests.conftest import SF
from tests.llm.test_mixing import brute as mixed
from tests.llm.test_near_dedup import brute as components
from tests.llm.test_quality import plain

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    docs = table(spark, SF, "documents")
    rows = {r["doc_id"]: r for r in docs.collect()}
    verdict = {r["doc_id"]: r for r in quality.verdicts(docs).collect()}

    kept = corpus_pipeline.quality_rules(spark, docs, SF).cache()
    assert kept.columns == COLUMNS
    ids = {r["doc_id"] for r in kept.collect()}
    assert ids == {i for i, v in verdict.items() if v["kept"]}
    for i, r in rows.items():
        n, _, _, _, repeats = plain(r["text"])
        assert (i not in ids) or not (n < 50 or 100 * repeats > 50 * n)
    good = {r["doc_id"] for r in table(spark, SF, "labels").where("quality = 1").collect()}
    assert all(i in ids for i in good if not verdict[i]["base_failed"])

    left = corpus_pipeline.near_duplicates(spark, kept, SF).cache()
    want = {i for i, _, _, stays in components([(i, rows[i]["text"]) for i in ids]) if stays}
    assert left.columns == COLUMNS and {r["doc_id"] for r in left.collect()} == want

    clean = corpus_pipeline.secrets(spark, left, SF).cache()
    machine = secret_scan.compiled(secret_scan.RULES)
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert clean.columns == COLUMNS and clean.where("n_chars != length(text)").count() == 0
    for i in want:
        data, out, at = rows[i]["text"].encode(), b"", 0
        for s, k, e in machine.spans(data):
            if s >= at:
                out += data[at:s] + f"[{machine.rules[k].kind}]".encode()
            at = max(at, e)
        assert texts[i] == (out + data[at:]).decode()

    mixture = corpus_pipeline.mix_sources(spark, clean, SF).cache()
    _, readings = mixed([(i, texts[i], rows[i]["source"]) for i in texts], mixing.ENTROPY_SHARE, mixing.MAX_REPEATS, 1.0)
    assert mixture.columns == COLUMNS
    assert sorted(r["doc_id"] for r in mixture.collect()) == sorted(i for i, _, _ in readings)

    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                              mergeable_ranks=byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")))
    got = {r["doc_id"]: r for r in corpus_pipeline.encode(spark, mixture, SF).collect()}
    for i in {i for i, _, _ in readings}:
        ids = np.array(coder.encode_ordinary(texts[i]), "<u4")
        assert got[i]["n_tokens"] == len(ids) and got[i]["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(texts[i].encode()).hexdigest()


def test_run_and_empty(spark, tmpdir_path):
    rows = [(i, "word " * 60 + f"id{i} " * 3, "en", "a", 0) for i in range(5)] + [(9, None, None, None, None), (10, "", "en", "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmpdir_path}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmpdir_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, tmpdir_path).count() == 0        # repeated words fail the base rules
    assert corpus_pipeline.run(spark, f"{tmpdir_path}/none").columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "secrets", "mixing", "byte_bpe"]
