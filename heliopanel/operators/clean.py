"""Outlier handling and scaling with a fit/apply split.

``fit_*`` returns a small per-column statistics table (one row per column: bounded by the
schema width, so collecting it is safe); ``apply_*`` inlines the statistics as literals,
keeping the apply step a codegen'd projection with no join and no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) rows for the non-null values of ``columns`` (one generator pass)."""
    arr = F.array(*[F.struct(F.lit(c).alias("column"), _q(c).cast("double").alias("value")) for c in columns])
    return df.select(F.explode(arr).alias("_p")).select("_p.column", "_p.value").where(F.col("value").isNotNull())


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    range_partitions: int | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles (pandas/numpy default) as a distributed job.

    1. value counts per (column, value) — map-side combine collapses hot values, so a
       value holding a third of the rows costs one row, not a skewed task;
    2. range-partition the distinct values and take running counts inside each range
       partition, plus per-partition offsets from a tiny (partitions x columns) table;
    3. pick the values at ranks floor/ceil((n-1)p) with a join against the tiny target
       table (columns x probs x 2 rows) and interpolate.
    No group, task or driver ever holds all values of a column.
    Returns (column, p, quantile).
    """
    spark = df.sparkSession
    parts = range_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = _long(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("_c"))
    # written once: every later use must see the same range partitions, whose bounds are sampled
    ranged = stage(counts.repartitionByRange(parts, "column", "value").withColumn("_pid", F.spark_partition_id()),
                   "ranged_counts")
    w_in = Window.partitionBy("_pid", "column").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranged = ranged.withColumn("_cum", F.sum("_c").over(w_in))
    per_part = ranged.groupBy("_pid", "column").agg(F.sum("_c").alias("_pc"))
    w_off = Window.partitionBy("column").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = per_part.select("_pid", "column", F.coalesce(F.sum("_pc").over(w_off), F.lit(0)).alias("_off"),
                           F.sum("_pc").over(Window.partitionBy("column")).alias("_n"))
    # offs and targets have (range partitions x columns) and (columns x probs x 2) rows:
    # size-bounded by parameters, so they are broadcast explicitly.
    ranked = (ranged.join(F.broadcast(offs), ["_pid", "column"])
                    .select("column", "value", "_n",
                            (F.col("_off") + F.col("_cum") - F.col("_c")).alias("_start"),   # first rank (0-based)
                            (F.col("_off") + F.col("_cum")).alias("_end")))                   # exclusive
    p_arr = F.array(*[F.lit(float(p)) for p in probs])
    targets = (offs.select("column", "_n").distinct()
                     .select("column", "_n", F.explode(p_arr).alias("p"))
                     .withColumn("_pos", (F.col("_n") - 1).cast("double") * F.col("p"))
                     .withColumn("_r", F.explode(F.array(F.floor("_pos"), F.ceil("_pos")))))
    targets = F.broadcast(targets)
    hit = targets.join(ranked.drop("_n"),
                       (targets["column"] == ranked["column"]) & (targets["_r"] >= ranked["_start"])
                       & (targets["_r"] < ranked["_end"])).select(targets["column"], "p", "_pos", "_r", "value")
    return (hit.groupBy("column", "p", "_pos")
               .agg(F.min_by("value", "_r").alias("_lo"), F.max_by("value", "_r").alias("_hi"))
               .select("column", "p",
                       (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_pos") - F.floor("_pos"))).alias("quantile")))


def approx_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                     accuracy: int = 10000) -> DataFrame:
    """Sketch-based alternative (bounded memory, one pass); returns (column, p, quantile)."""
    aggs = [F.percentile_approx(_q(c).cast("double"), list(probs), accuracy).alias(f"_q{i}")
            for i, c in enumerate(columns)]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_q{i}").alias("qs")) for i, c in enumerate(columns)])
    return (wide.select(F.explode(rows).alias("r"))
                .select("r.column", F.posexplode("r.qs").alias("_k", "quantile"))
                .select("column", F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("_k") + 1).alias("p"),
                        "quantile"))


def fit_iqr_bounds(df: DataFrame, columns: Sequence[str], k: float = 1.5, exact: bool = True) -> DataFrame:
    """D5 fit: (column, q1, q3, lower, upper) with lower/upper = q1 -/+ k * IQR."""
    qs = exact_quantiles(df, columns, [0.25, 0.75]) if exact else approx_quantiles(df, columns, [0.25, 0.75])
    wide = qs.groupBy("column").agg(F.max(F.when(F.col("p") == 0.25, F.col("quantile"))).alias("q1"),
                                    F.max(F.when(F.col("p") == 0.75, F.col("quantile"))).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return wide.select("column", "q1", "q3", (F.col("q1") - k * iqr).alias("lower"),
                       (F.col("q3") + k * iqr).alias("upper"))


def _stats(bounds: DataFrame) -> dict[str, dict]:
    return {r["column"]: r.asDict() for r in bounds.collect()}   # one row per column


def apply_clip(df: DataFrame, bounds: DataFrame | dict) -> DataFrame:
    """D5 apply: values below/above the bounds become the bound; NULL stays NULL
    (``least/greatest`` would turn a NULL into a bound, so ``when`` is used)."""
    b = _stats(bounds) if isinstance(bounds, DataFrame) else bounds
    out = []
    for c in df.columns:
        if c in b:
            lo, hi = F.lit(b[c]["lower"]), F.lit(b[c]["upper"])
            out.append(F.when(_q(c) < lo, lo).when(_q(c) > hi, hi).otherwise(_q(c).cast("double")).alias(c))
        else:
            out.append(_q(c))
    return df.select(*out)


def outlier_counts(df: DataFrame, bounds: DataFrame | dict) -> DataFrame:
    b = _stats(bounds) if isinstance(bounds, DataFrame) else bounds
    aggs = [F.sum(F.when((_q(c) < F.lit(s["lower"])) | (_q(c) > F.lit(s["upper"])), 1).otherwise(0)).cast("long").alias(c)
            for c, s in b.items()]
    return df.agg(*aggs)


def fit_zscore(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """D6 fit: mean and sample std per column (one pass)."""
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.avg(_q(c)).alias(f"m{i}"), F.stddev_samp(_q(c)).alias(f"s{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"))
            for i, c in enumerate(columns)]
    return wide.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def apply_zscore(df: DataFrame, stats: DataFrame | dict, threshold: float = 3.0) -> DataFrame:
    """D6 apply: |x - mean| / std > threshold -> mean. std 0 or NULL -> no outliers."""
    st = _stats(stats) if isinstance(stats, DataFrame) else stats
    out = []
    for c in df.columns:
        if c in st and st[c]["std"] not in (None, 0.0):
            m, s = F.lit(st[c]["mean"]), F.lit(st[c]["std"])
            out.append(F.when(F.abs((_q(c) - m) / s) > threshold, m).otherwise(_q(c).cast("double")).alias(c))
        else:
            out.append(_q(c))
    return df.select(*out)


def fit_scaler(df: DataFrame, columns: Sequence[str], method: str = "standard") -> DataFrame:
    """F7 fit on non-null values: standard -> (mean, population std), minmax -> (min, range).
    A zero spread scales by 1.  Returns (column, center, scale)."""
    if method not in ("standard", "minmax", "none"):
        raise ValueError(f"unknown scaling method {method}")
    aggs = []
    for i, c in enumerate(columns):
        x = _q(c).cast("double")
        if method == "standard":
            center, spread = F.avg(x), F.stddev_pop(x)
        else:
            center, spread = F.min(x), F.max(x) - F.min(x)
        if method == "none":
            center, spread = F.lit(0.0), F.lit(1.0)
        aggs += [center.alias(f"c{i}"), F.when(spread == 0, F.lit(1.0)).otherwise(spread).alias(f"s{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"c{i}").cast("double").alias("center"),
                     F.col(f"s{i}").cast("double").alias("scale")) for i, c in enumerate(columns)]
    return wide.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def apply_scaler(df: DataFrame, stats: DataFrame | dict) -> DataFrame:
    st = _stats(stats) if isinstance(stats, DataFrame) else stats
    out = []
    for c in df.columns:
        if c in st and st[c]["center"] is not None:
            out.append(((_q(c).cast("double") - F.lit(st[c]["center"])) / F.lit(st[c]["scale"])).alias(c))
        else:
            out.append(_q(c))
    return df.select(*out)
