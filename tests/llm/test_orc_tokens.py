"""ORC token files against the library, their order, and metadata pruning."""

import os
import random
import re
import shutil
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow.orc as orc
from tokenizers import Tokenizer

from heliopanel.llm import orc_tokens as O
from heliopanel.llm.wordhash import word_hashes

PATH = P.path("word_bpe_49k.json")


def test_words_equal_library():
    library, coder, r = Tokenizer.from_file(PATH), O.WordCoder(PATH), random.Random(2)
    pieces = ["the", "The", " ", "\n", "\t", "é", "é", "́", "日本", "12", "'s", "<|endoftext|>", "<|ENDOFTEXT|>", "K", "\x1c", "\x85",
              " ", " ", "Σ", "ΑΣ", "!!", ".", ",", "a.", "'", "\U0001f600", "x" * 70, "İ", "ing", "\x0b", "\r", "\x00"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randint(0, 30))) for _ in range(2000)]
    got = coder.encode([t.encode() for t in texts])
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(g, "<i4").tolist() for g in got] == want
    words = {w for t in texts for w in t.encode().split()}
    assert not set(word_hashes(b"\n".join(w for w in words if len(w) > 70)).tolist()) & set(coder.hashes.tolist())


def test_files_and_catalogue(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(O, "ROWS_PER_FILE", 70)
    library = Tokenizer.from_file(PATH)
    r = random.Random(1)
    rows = [(i, " ".join(r.choice(["alpha", "Beta", "x9", "été"]) for _ in range(r.randint(0, 50))), i) for i in range(500)]
    rows += [(1000, None, 0), (1001, "", 0), (1002, "word " * 100_000, 0)]
    r.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(5)
    path = tmpdir_path + "/orc"
    O.write_tokens(docs, path, PATH)
    got = sorted(map(tuple, O.catalogue(spark, path).collect()))
    start = 0
    for g, (i, text, _) in zip(got, sorted(rows)):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, O.END_ID], "<u4")
        assert g == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    files = sorted({row["file"] for row in O.read_tokens(spark, path).select("file").collect()})
    tops = [orc.read_table(f"{path}/{f}")["doc_id"].to_pylist() for f in files]
    assert len(files) > 5 and sum(tops, []) == sorted(x[0] for x in rows)
    plan = O.read_tokens(spark, path).where("doc_id = 77")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,77)" in plan
    assert O.read_tokens(spark, path).where("doc_id = 77").count() == 1


def test_repeated_rows_and_empty_table(spark, tmpdir_path):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    O.write_tokens(docs, tmpdir_path + "/r", PATH)
    got = O.catalogue(spark, tmpdir_path + "/r").orderBy("start").collect()
    assert [(g["doc_id"], g["start"], g["n_tokens"]) for g in got] == [(None, 0, 2), (1, 2, 3), (1, 5, 3)]
    O.write_tokens(docs.limit(0), tmpdir_path + "/e", PATH)
    assert O.catalogue(spark, tmpdir_path + "/e").count() == 0


def test_file_order_where_the_uuid_looks_like_a_file_number(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(O, "ROWS_PER_FILE", 20)
    r = random.Random(3)
    rows = [(i, " ".join(r.choice(["alpha", "x9"]) for _ in range(r.randint(0, 50)))) for i in range(400)]
    O.write_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), tmpdir_path + "/written", PATH)
    os.mkdir(tmpdir_path + "/named")
    for name in os.listdir(tmpdir_path + "/written"):
        if name.startswith("part-"):
            named = re.sub("^(part-[0-9]+)-.{36}-", r"\1-0a1b2c3d-c12a-4e5f-8a9b-c12345678901-", name)
            assert named != name
            shutil.copy(f"{tmpdir_path}/written/{name}", f"{tmpdir_path}/named/{named}")
    got = O.catalogue(spark, tmpdir_path + "/named").orderBy("doc_id").collect()
    starts = np.cumsum([0, *[g["n_tokens"] for g in got]])[:-1].tolist()
    assert [g["doc_id"] for g in got] == list(range(400)) and [g["start"] for g in got] == starts
