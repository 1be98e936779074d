"""Exact k-nearest-neighbour regression (G11) without emitting all query x train pairs.

0. Duplicates.  Among train points with identical feature vectors only the k smallest ids
   can ever be chosen (equal distances, ties broken by id), so each vector keeps <= k rows
   (WindowGroupLimit partial before the shuffle: a vector holding a third of the table
   costs k rows per partition).
1. Train rows get an ascending number by id, so that ties go to the smaller number.
2. Queries of equal features have the same neighbours: one of them asks for all.
3. ``neighbours.nearest_rows``: a query searches its nearest box of train points, whose k-th distance
   bounds the true one, and then the boxes within that bound.
4. ``row_number <= k`` per query (ties -> train id), weighted average (uniform or
   1/distance; zero distances take over).

Nothing is capped.  Collected to the driver: the boxes' sampled rows and bounds, and k rows for queries
without features.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .clean import apply_scaler, fit_scaler
from .neighbours import PART_ROWS, first_of_equals, nearest_rows


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def knn_predict(train: DataFrame, queries: DataFrame, features: Sequence[str], target: str, k: int = 5,
                weights: str = "uniform", train_id: Sequence[str] = (), query_id: Sequence[str] = (),
                scale: bool = True, rank_block: int | None = None) -> DataFrame:
    """Returns query_id columns + ``prediction`` + ``n_neighbors``; ``rank_block``: train rows of a box."""
    if weights not in ("uniform", "distance"):
        raise ValueError("weights must be 'uniform' or 'distance'")
    p, feats, tid, qid = len(features), list(features), list(train_id), list(query_id)
    fcols = [f"f{j}" for j in range(p)]
    train = train.where(_q(target).isNotNull())
    if scale:
        stats = {r["column"]: r.asDict() for r in fit_scaler(train, feats, "standard").collect()}   # p rows
        train, queries = apply_scaler(train, stats), apply_scaler(queries, stats)

    def whole(cols):
        return F.lit(True) if not cols else whole(cols[1:]) & F.col(cols[0]).isNotNull()

    T = train.select(F.struct(*[_q(c) for c in tid] or [F.lit(0).alias("_")]).alias("tid"), _q(target).cast("double").alias("y"),
                     *[_q(c).cast("double").alias(f) for c, f in zip(feats, fcols)]).where(whole(fcols))
    # 0. at most k rows per distinct feature vector
    T = T.withColumn("_v", F.row_number().over(Window.partitionBy(*fcols).orderBy("tid"))).where(F.col("_v") <= k).drop("_v")
    # 1. numbered by id
    T = T.repartitionByRange("tid").sortWithinPartitions("tid").select(*fcols, "y", F.lit(1).alias("trains"), F.monotonically_increasing_id().alias("key"))
    T = stage(T, "knn_train")
    # rows of the same query id are one query
    Q = queries.select(F.struct(*[_q(c) for c in qid]).alias("qid"), *[_q(c).cast("double").alias(f) for c, f in zip(feats, fcols)],
                       F.monotonically_increasing_id().alias("_id"))
    same = Window.partitionBy("qid")
    Q = stage(Q.withColumn("query", F.min("_id").over(same)).withColumn("own", F.when(F.count(F.lit(1)).over(same) > 1, F.col("query")).otherwise(-1)).drop("_id"),
              "knn_queries")

    geo = T.agg(F.count(F.lit(1)).alias("n"), *[F.stddev_pop(f).alias(f) for f in fcols]).first()   # one row
    if not geo["n"]:
        return Q.select(*[F.col(f"qid.`{c}`").alias(c) for c in qid], F.lit(None).cast("double").alias("prediction"),
                        F.lit(0).cast("long").alias("n_neighbors"))
    unit = np.array([geo[f] or 1.0 for f in fcols])
    # 2. one of the queries of equal features asks; a query of several rows asks for itself
    Q = first_of_equals(Q.where(whole(fcols)), [*fcols, "own"]).unionByName(Q.where(~whole(fcols)).withColumn("first", F.col("query")))
    found = nearest_rows(T, Q.where(whole(fcols) & (F.col("query") == F.col("first"))).select(*fcols, "query", F.lit(0).alias("fold")), np.ones((1, p)), unit,
                         geo["n"], k, part_rows=rank_block or PART_ROWS).select("query", "key", "y", "distance")
    # a query without all features has no distances: the first k ids
    firsts = F.array(*[F.struct(F.lit(r["key"]).cast("long").alias("key"), F.lit(r["y"]).alias("y"))
                       for r in T.select("key", "y").orderBy("key").limit(k).collect()])     # k rows
    found = found.union(Q.where(~whole(fcols)).select("query", F.explode(firsts).alias("_t"))
                        .select("query", "_t.key", "_t.y", F.lit(None).cast("double")))

    top = found.withColumn("_rn", F.row_number().over(Window.partitionBy("query").orderBy("distance", "key"))).where(F.col("_rn") <= k)
    if weights == "uniform":
        pred = F.avg("y")
    else:
        zero = F.col("distance") == 0
        pred = F.when(F.max(zero.cast("int")) == 1, F.avg(F.when(zero, F.col("y")))) \
                .otherwise(F.sum(F.try_divide(F.col("y"), F.col("distance"))) / F.sum(F.try_divide(F.lit(1.0), F.col("distance"))))
    out = top.groupBy(F.col("query").alias("first")).agg(pred.alias("prediction"), F.count(F.lit(1)).alias("n_neighbors"))
    alone = F.col("own") == -1
    named = Q.where(alone).select("first", "qid").union(Q.where(~alone).select("first", "qid").dropDuplicates(["first"]))
    return named.join(out, "first").select(*[F.col(f"qid.`{c}`").alias(c) for c in qid], "prediction", "n_neighbors")
