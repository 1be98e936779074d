"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order.  Pivot inverted files hold, per
pivot, the rows that have it among their ``PREFIX`` nearest, with its rank there.  A query
reads the files of its own nearest pivots; each posting adds what it takes off the footrule
distance (a pivot absent from a list counts as ranked last), so rows end up ranked by
footrule distance between prefixes.  The nearest ``SHARE`` of every shard, ties included,
are reranked by the inner product of the original vectors in double precision.

The index is built in shards of about ``SHARD_ROWS`` vectors, each with its own inverted
files, so it grows by shards; queries come in groups of about ``GROUP_QUERIES``, and a task
holds one shard and one group.  Pivots are a bounded sample (``PIVOTS`` distinct vectors by a
hash of them); every usable vector is indexed.

Vectors that are null, empty, zero or hold a null or non-finite component take no part,
nor do those whose length is not the most frequent one, nor null ids.  Repeated rows of an
id are candidates each, and none is a candidate of a query with the same id.  Ties go to
the smaller id.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_sample, write_table

PIVOTS = 512
PREFIX = 64
SHARE = 0.3
LEAST = 1000
SHARD_ROWS = 8192
GROUP_QUERIES = 4096


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, vec (array of doubles) of the vectors that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")) \
        .where("id is not null and vec is not null and size(vec) > 0") \
        .where("forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))") \
        .where("exists(vec, x -> x != 0)")
    width = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("vec") == (width[0]["n"] if width else 0))


def choose_pivots(rows: DataFrame, n: int = PIVOTS) -> np.ndarray:
    """At most ``n`` distinct vectors, scaled to length 1 (as nearness is by angle)."""
    m = np.array(sorted(r["vec"] for r in bounded_sample(rows.select("vec"), F.xxhash64("vec"), n).collect()), np.float64)
    return m / np.linalg.norm(m, axis=1, keepdims=True) if len(m) else m


def prefixes(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The nearest pivots of each vector in order, ties to the earlier pivot."""
    near = vectors @ pivots.T
    return np.argsort(-near, axis=1, kind="stable")[:, :PREFIX].astype(np.int32)


def _shard(pivots: np.ndarray):
    def build(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        vectors = np.array(pdf["vec"].tolist(), np.float64)
        top = prefixes(vectors, pivots)
        n, k = top.shape
        pivot = top.ravel()
        order = np.argsort(pivot, kind="stable")
        starts = np.searchsorted(pivot[order], np.arange(len(pivots) + 1)).astype(np.int64)
        rows = np.repeat(np.arange(n, dtype=np.int32), k)[order]
        ranks = np.tile(np.arange(k, dtype=np.int16), n)[order]
        return pd.DataFrame({"shard": [key[0]], "ids": [pdf["id"].to_numpy(np.int64).tobytes()],
                             "vectors": [vectors.tobytes()], "starts": [starts.tobytes()],
                             "rows": [rows.tobytes()], "ranks": [ranks.tobytes()]})
    return build


def build_index(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """One written row per shard: its vectors and its pivot inverted files."""
    n = rows.count()
    shards = max(1, -(-n // SHARD_ROWS))
    # the row's own number inside the hash spreads repeated ids as well
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(shards)).cast("int"))
    return write_table(dealt.groupBy("shard").applyInPandas(
        _shard(pivots), "shard int, ids binary, vectors binary, starts binary, rows binary, ranks binary"), "ann-index")


def candidates(top: np.ndarray, starts: np.ndarray, rows: np.ndarray, ranks: np.ndarray, n: int) -> np.ndarray:
    """Rows of a shard by footrule: those at least as near as the last of the wanted number."""
    want = max(LEAST, int(np.ceil(SHARE * n)))
    if want >= n:
        return np.arange(n)
    saved = np.zeros(n, np.int32)
    for rank, p in enumerate(top):
        s, e = starts[p], starts[p + 1]
        # |rank - r| against PREFIX - rank + PREFIX - r if one of both lacked the pivot
        saved[rows[s:e]] += PREFIX - np.maximum(rank, ranks[s:e])
    return np.flatnonzero(saved >= np.partition(saved, n - want)[n - want])


def _search(pivots: np.ndarray, k: int):
    def run(key, shard: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out_q, out_v, out_s = [], [], []
        if len(shard) and len(queries):
            s = shard.iloc[0]
            ids = np.frombuffer(s["ids"], np.int64)
            vectors = np.frombuffer(s["vectors"], np.float64).reshape(len(ids), -1)
            starts, rows, ranks = (np.frombuffer(s[c], t) for c, t in
                                   (("starts", np.int64), ("rows", np.int32), ("ranks", np.int16)))
            asked = np.array(queries["vec"].tolist(), np.float64)
            top = prefixes(asked, pivots)
            for i, q in enumerate(queries["id"]):
                near = candidates(top[i], starts, rows, ranks, len(ids))
                near = near[ids[near] != q]
                if not len(near):
                    continue
                rough = vectors[near] @ asked[i]
                if len(near) > k:
                    last = np.partition(rough, len(near) - k)[len(near) - k]
                    near = near[rough >= last - 1e-9 * max(1.0, abs(last))]
                exact = (vectors[near] * asked[i]).sum(axis=1)      # the same sum for equal vectors
                best = np.lexsort((ids[near], -exact))[:k]
                out_q += [int(q)] * len(best)
                out_v.append(ids[near[best]])
                out_s.append(exact[best])
        return pd.DataFrame({"query_id": np.array(out_q, np.int64), "vec_id": np.concatenate([np.zeros(0, np.int64), *out_v]),
                             "score": np.concatenate([np.zeros(0), *out_s])})
    return run


def search(index: DataFrame, queries: DataFrame, pivots: np.ndarray, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every shard, merged per query."""
    n = queries.count()
    groups = max(1, -(-n // GROUP_QUERIES))
    shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    asked = queries.withColumn("grp", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int")) \
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    held = index.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    found = held.groupBy("grp", "shard").cogroup(asked.groupBy("grp", "shard")) \
        .applyInPandas(_search(pivots, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, is_query: F.Column, k: int = 20, id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """The k nearest found of every usable row for which ``is_query`` (over ``id``) holds."""
    rows = write_table(usable(vectors, id_col, vec_col), "ann-vectors")
    pivots = choose_pivots(rows)
    if not len(pivots):
        return rows.limit(0).select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"),
                                    F.lit(0.0).alias("score"))
    queries = rows.where(is_query).dropDuplicates(["id"])
    return search(build_index(rows, pivots), queries, pivots, k)
