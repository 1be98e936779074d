"""Connected components by alternating star contraction, with reliable checkpoints.

Every round replaces the edges by (large star, small star) edges; the number of rounds grows
with the logarithm of the number of nodes.  Edges are written to the shared folder per round,
so a lost executor costs one round at most.  Only counts reach the driver.

A node with very many neighbours never becomes one task's group: minima are aggregates
(pre-aggregated in each task), joined back by a broadcast if the edges are few, else on salted
keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import write_table

SALTS = 8
#: edges up to which a round's minima (16 bytes a node) are broadcast
FEW_EDGES = 500_000


def _with_minimum(pairs: DataFrame, few: bool) -> DataFrame:
    """(u, v) plus m = the least node among u and all its v.  Minima of few pairs are broadcast;
    else both sides of the join are salted by v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))       # each task sends one row per node
    if few:
        joined = pairs.join(F.broadcast(least), "u")
    else:
        least = least.withColumn("_s", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
        salt = F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")
        joined = pairs.withColumn("_s", salt).join(least, ["u", "_s"])
    return joined.select("u", "v", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame, few: bool) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_minimum(both, few).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .where("u != v").distinct()


def _small_star(edges: DataFrame, few: bool) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    m = _with_minimum(down, few)
    return m.select(F.col("v").alias("u"), F.col("m").alias("v")).union(m.select("u", F.col("m").alias("v"))) \
        .where("u != v").distinct()


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, component (its least node) for every node that an edge (u, v) of longs names.

    Self loops and repeated edges do no harm; no edges give an empty table.
    """
    now = write_table(edges.where("u != v").select("u", "v").distinct(), "edges")
    mark = None
    for _ in range(rounds):
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if seen == mark or not seen[0]:
            break
        mark, few = seen, seen[0] <= FEW_EDGES
        now = write_table(_small_star(_large_star(now, few), few), "edges")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .union(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
