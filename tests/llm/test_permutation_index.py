"""Recall against brute force, the footrule identity, ties and unusable vectors."""

import numpy as np
from pyspark.sql import functions as F

from heliopanel.llm import permutation_index as A
from heliopanel.llm.common import table


def brute(ids, vectors, q, k):
    s = (vectors * vectors[ids.index(q)]).sum(axis=1)
    keep = [i for i in range(len(ids)) if ids[i] != q]
    return sorted(((-s[i], ids[i]) for i in keep))[:k]


def test_recall_on_given_vectors(spark, monkeypatch):
    monkeypatch.setattr(A, "SHARD_ROWS", 700)
    monkeypatch.setattr(A, "GROUP_QUERIES", 30)
    rows = table(spark, "/root/testdata/sf0.1", "embeddings")
    got = A.nearest(rows, F.col("id") % 20 == 0).collect()
    data = rows.collect()
    ids, vectors = [r["vec_id"] for r in data], np.array([r["embedding"] for r in data], float)
    hit = total = 0
    for q in [i for i in ids if i % 20 == 0]:
        mine = sorted((g["rank"], -g["score"], g["vec_id"]) for g in got if g["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 21)) and [m[1:] for m in mine] == sorted(m[1:] for m in mine)
        want = {v for _, v in brute(ids, vectors, q, 20)}
        hit += len(want & {m[2] for m in mine})
        total += 20
    assert hit / total >= 0.95


def test_candidates_follow_the_footrule(monkeypatch):
    monkeypatch.setattr(A, "LEAST", 1)
    r = np.random.default_rng(0)
    pivots, vectors = r.normal(size=(200, 8)), r.normal(size=(900, 8))
    top = A.prefixes(vectors, pivots)
    rank = np.full((900, 200), A.PREFIX)
    np.put_along_axis(rank, top, np.arange(A.PREFIX)[None, :].repeat(900, 0), 1)
    index = A._shard(pivots)((0,), __import__("pandas").DataFrame({"id": range(900), "vec": list(vectors)})).iloc[0]
    starts, rows, ranks = (np.frombuffer(index[c], t) for c, t in (("starts", np.int64), ("rows", np.int32), ("ranks", np.int16)))
    for q in range(5):
        foot = np.abs(rank - rank[q]).sum(axis=1)
        want = int(np.ceil(A.SHARE * 900))
        assert set(A.candidates(top[q], starts, rows, ranks, 900)) == set(np.flatnonzero(foot <= np.sort(foot)[want - 1]))


def test_ties_and_unusable_vectors(spark):
    same = [[1.0, 0.0]] * 60
    rows = [(i, v) for i, v in enumerate(same)] + [(100, None), (120, [0.0, 0.0]), (140, [float("nan"), 1.0]),
                                                  (160, [None, 1.0]), (180, [1.0]), (200, [float("inf"), 1.0]),
                                                  (220, []), (None, [1.0, 1.0]), (240, [-1.0, 0.5]), (0, [1.0, 0.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    got = A.nearest(df, F.col("id") % 20 == 0, k=20).orderBy("query_id", "rank").collect()
    by = {}
    for g in got:
        by.setdefault(g["query_id"], []).append((g["vec_id"], g["score"]))
    assert sorted(by) == [0, 20, 40, 240]
    assert [v for v, _ in by[0]] == list(range(1, 21)) and {s for _, s in by[0]} == {1.0}
    assert [v for v, _ in by[20]] == [0, 0, *range(1, 19)]
    few = A.nearest(df.where("vec_id in (0, 20, 240)").dropDuplicates(["vec_id"]), F.col("id") == 240, k=20).collect()
    assert [(g["rank"], g["vec_id"], g["score"]) for g in few] == [(1, 0, -1.0), (2, 20, -1.0)]
    assert A.nearest(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_recall_where_shards_are_pruned(spark, monkeypatch):
    monkeypatch.setattr(A, "SHARD_ROWS", 700)
    monkeypatch.setattr(A, "LEAST", 50)
    rows = table(spark, "/root/testdata/sf0.1", "embeddings")
    got = A.nearest(rows, F.col("id") % 20 == 0).collect()
    data = rows.collect()
    ids, vectors = [r["vec_id"] for r in data], np.array([r["embedding"] for r in data], float)
    asked = [i for i in ids if i % 20 == 0]
    hit = 0
    for q in asked:
        hit += len({v for _, v in brute(ids, vectors, q, 20)} & {g["vec_id"] for g in got if g["query_id"] == q})
    print("recall", hit / (20 * len(asked)))
    assert hit / (20 * len(asked)) >= 0.95
