"""Collocations against counting in plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from heliopanel.llm import phrases as P
from heliopanel.llm.common import table
from tests.conftest import SF_SMALL


def plain(rows, top=2000, least=10):
    """rows: (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    out = {}
    long = {(g, w): a for (g, w), a in f.items() if len(w) == 3 and a >= least}
    inside = Counter()
    for (g, w), a in long.items():
        for p in (w[:2], w[1:]):
            inside[g, p] = max(inside[g, p], a)
    for (g, w), a in f.items():
        if len(w) == 1 or a < least or (len(w) == 2 and 100 * inside[g, w] >= 50 * a and inside[g, w]):
            continue
        cuts = [(1000000 * a * a // (f[g, w[:k]] * f[g, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(g, []).append((-score, -a, " ".join(w).encode(), f[g, w[:k]], f[g, w[k:]]))
    return [(g, i + 1, p.decode(), -a, left, right, n[g], -s) for g in out
            for i, (s, a, p, left, right) in enumerate(sorted(out[g])[:top])]


def of(spark, rows, **kw):
    df = spark.createDataFrame(rows, "lang string, text string, word string, n string")
    return sorted(tuple(r) for r in P.collocations(df, **kw).collect())


def corpus(n, seed=7):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)] + ["The", "the", "é", " x", "A-b"]
    out = []
    for _ in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))]
        text = "".join(w + rng.choice([" "] * 8 + ["  ", "\t", ". ", "\n", ", ", "!", "\r\n"]) for w in words)
        out.append((rng.choice(["en", "de", None, "und"]), text, "own", "own"))
    return out + [("en", None, None, None), (None, "", None, None), ("fr", " .\n", None, None)]


def test_against_plain_counts(spark):
    rows = corpus(300)
    assert of(spark, rows) == sorted(plain([r[:2] for r in rows]))
    assert of(spark, rows, top=7, least=4) == sorted(plain([r[:2] for r in rows], 7, 4))


def test_phrase_inside_longer_one(spark):
    rows = [("en", "new york city. " * 12 + "new york. " * 12 + "york city hall? " * 9, None, None)]
    got = of(spark, rows)
    assert got == sorted(plain([r[:2] for r in rows]))
    assert [r[2] for r in got] == ["new york city"]


def test_stripes_in_parts_and_small_slices(spark, monkeypatch):
    rows = corpus(200, 3)
    want = sorted(plain([r[:2] for r in rows]))
    df = spark.createDataFrame(rows, "lang string, text string, word string, n string").repartition(3)
    monkeypatch.setattr(P, "STRIPE_WORDS", 50)          # read on the driver: most words are dealt over parts
    got = sorted(tuple(r) for r in P.collocations(df).collect())
    assert got == want


def test_merging_goes_on_over_buffers(monkeypatch):
    monkeypatch.setattr(P, "BUFFER", 5)
    monkeypatch.setattr(P, "SLICE_BYTES", 16)
    import pyarrow as pa
    texts = ["a b c a b c a b d", "a b c. a b c", "b c a b"]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 3), pa.array(texts)], ["lang", "text"])
    stripes = pa.Table.from_batches(list(P._stripes(iter([batch]), None))).sort_by([("lang", "ascending"), ("word", "ascending")])
    got = pa.Table.from_batches(list(P._merge(iter(stripes.to_batches(max_chunksize=1)), 1))).to_pylist()
    f = Counter()
    for t in texts:
        for piece in t.split("."):
            w = piece.split()
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[tuple(w[i:i + k])] += 1
    assert {tuple(x for x in (r["w1"], r["w2"], r["w3"]) if x is not None): r["n"] for r in got} == f


@pytest.mark.parametrize("limit", [1, 5, 64])
def test_slices_are_whole_and_end_with_a_break(limit):
    text = b"ab cd. ef\n\ngh " + b"x" * 30 + b", y"
    parts = list(P.slices(text, limit))
    assert b"".join(parts) == text
    assert all(p[-1:] in b".,\n" for p in parts[:-1])


def test_counting_renumbers_wide_keys():
    rng = np.random.default_rng(1)
    cols = tuple(rng.integers(0, 3, 500) * (2**30 - 1) for _ in range(3))
    (a, b, c), n = P._counted(cols, (2**31, 2**31, 2**31), np.ones(500, np.int64))
    want = Counter(zip(*(x.tolist() for x in cols)))
    assert dict(zip(zip(a.tolist(), b.tolist(), c.tolist()), n.tolist())) == want


def test_empty_table(spark):
    assert of(spark, []) == []


def test_nothing_is_broadcast(spark, monkeypatch):
    """Not even small tables: Spark takes the files' size for that of the rows and counts no copies."""
    plans, write = [], P.write_table

    def writing(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(P, "write_table", writing)
    docs = spark.createDataFrame(corpus(100), "lang string, text string, word string, n string")
    found = P.collocations(docs)
    found.collect()
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) == 2
    assert not any("Broadcast" in p for p in plans)


def test_given_documents(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    assert sorted(tuple(r) for r in P.collocations(docs).collect()) == sorted(plain(rows))
