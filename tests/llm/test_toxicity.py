"""Marginals against enumeration, held-out accuracy, and the operator's edge cases."""

import itertools
import zlib

import numpy as np

from heliopanel.llm import toxicity as T
from heliopanel.llm.common import table

SF = "/root/testdata/sf0.1"


def enumerated(step, potential):
    n = len(potential)
    total, out = 0.0, np.zeros(n)
    for tags in itertools.product((0, 1), repeat=n):
        before = (0, *tags[:-1])
        w = np.exp(sum(step[a, b] + (potential[i] if b else 0) for i, (a, b) in enumerate(zip(before, tags))))
        total += w
        out += w * np.array(tags)
    return out / total


def plain(step, potential):
    """Forward-backward, one token at a time."""
    m = np.exp(step)
    f, b = [], np.ones(2)
    v = np.array([1.0, 0.0])
    for x in potential:
        v = (v @ m) * np.exp([0, x])
        v /= v.sum()
        f.append(v)
    out = np.zeros(len(potential))
    for i in range(len(potential) - 1, -1, -1):
        p = f[i] * b
        out[i] = p[1] / p.sum()
        b = m @ (np.exp([0, potential[i]]) * b)
        b /= b.sum()
    return out


def test_marginals():
    r = np.random.default_rng(1)
    step = r.normal(0, 1, (2, 2))
    for n in (1, 2, 7):
        x = r.normal(0, 2, n)
        assert np.allclose(T.marginals(step, x, [n]), enumerated(step, x))
    lengths = [0, 5, T.BLOCK, 0, T.BLOCK + 1, 1000, 3, 0]
    x = r.normal(0, 3, sum(lengths))
    want = np.concatenate([plain(step, part) for part in np.split(x, np.cumsum(lengths)[:-1])])
    assert np.allclose(T.marginals(step, x, lengths), want)
    assert len(T.marginals(step, np.zeros(0), [0, 0])) == 0


def test_held_out_accuracy_and_bounded_sample(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    out = T.toxicity(docs, labels)
    got = out.join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").select("doc_id", "predicted", "toxic", "spans").collect()
    assert all(zlib.crc32(str(g["doc_id"]).encode()) % 4 == 2 for g in got)
    hit = sum(g["predicted"] and g["toxic"] for g in got)
    assert hit / sum(g["toxic"] for g in got) > 0.8 and hit / sum(g["predicted"] for g in got) > 0.9
    texts = {r["doc_id"]: r["text"] for r in docs.where("doc_id < 2000").select("doc_id", "text").collect()}
    spans = [texts[g["doc_id"]][s["start"]:s["end"]] for g in got if g["doc_id"] in texts for s in g["spans"]]
    assert any("idiot" in s for s in spans) and all(s and not s[0].isspace() and not s[-1].isspace() for s in spans)


def test_edges(spark):
    r = np.random.default_rng(2)
    rows = [(i, " ".join(f"w{j}" for j in r.integers(0, 300, 30)) + " vilename" * (i % 5 == 0), i % 5 == 0) for i in range(400)]
    extra = [(1000, None), (1001, ""), (1002, "ok " * 100_000 + "vilename"), (1003, "Vilename!"), (1003, "Vilename!"), (None, "vilename")]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(*e, "x") for e in extra], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows] + [(None, 1), (5, None), (10, 1)], "doc_id long, toxic int")
    got = T.toxicity(docs, labels).collect()
    by = {g["doc_id"]: g for g in got}
    assert len(got) == 406 and all(0 <= g["score"] <= 1 for g in got)
    assert by[1000]["score"] == by[1001]["score"] < 0.3 and not by[1000]["spans"]
    assert by[1002]["predicted"] == by[1003]["predicted"] == by[None]["predicted"] == 1 and not by[None]["held_out"]
    assert [(s["start"], s["end"]) for s in by[1003]["spans"]] == [(0, 9)]
    assert by[1002]["spans"][-1]["start"] == 300_000
    assert T.toxicity(docs.limit(0), labels).count() == 0
    assert len({g["score"] for g in T.toxicity(docs, labels.limit(0)).collect()}) == 1
