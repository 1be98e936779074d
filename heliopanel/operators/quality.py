"""Data-quality tables (D1-D4, D15): one aggregation pass each, grouped by series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .panel import numeric_columns
from .series import positional


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def null_count(columns: Sequence[str]) -> Column:
    """Total NULL/NaN cells over the given columns, as one aggregate expression."""
    parts = [F.sum(F.when(_q(c).isNull(), 1).otherwise(0)) for c in columns]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total.cast("long")


def quality_report(df: DataFrame, keys: Sequence[str] = (), time_col: str = "time") -> DataFrame:
    """Rows, first/last time, total nulls, numeric column list — per series."""
    cols = [c for c in df.columns if c not in keys]
    nums = ",".join(c for c in numeric_columns(df) if c not in keys)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min(time_col).alias("min_time"), F.max(time_col).alias("max_time"),
        null_count(cols).alias("missing_values"),
        F.lit(nums).alias("numeric_columns"))


def day_profile(df: DataFrame, keys: Sequence[str] = (), time_col: str = "time") -> DataFrame:
    """Distinct days, points per day (mean/min/max), fully duplicated rows, nulls.

    Duplicates are counted by grouping on every column (map-side combine collapses the
    copies before the shuffle) — never by collecting a series."""
    keys = list(keys)
    cols = list(df.columns)
    if not keys:
        return day_profile(df.withColumn("_all", F.lit(0)), ["_all"], time_col).drop("_all")
    day = F.to_date(_q(time_col)).alias("_day")
    per_day = (df.groupBy(*keys, day).agg(F.count(_q(time_col)).alias("_pts"))
                 .groupBy(*keys).agg(F.count("_day").alias("n_days"),
                                     F.avg("_pts").alias("mean_points_per_day"),
                                     F.min("_pts").alias("min_points_per_day"),
                                     F.max("_pts").alias("max_points_per_day")))
    dups = (df.groupBy(*[_q(c) for c in cols]).agg(F.count(F.lit(1)).alias("_m"))
              .groupBy(*keys).agg(F.sum(F.col("_m") - 1).cast("long").alias("duplicate_rows"),
                                  F.sum("_m").cast("long").alias("total_records")))
    nulls = df.groupBy(*keys).agg(null_count([c for c in cols if c not in keys]).alias("missing_values"))
    return per_day.join(dups, keys).join(nulls, keys)


def feature_summary(df: DataFrame) -> DataFrame:
    """D3: column counts by kind (from the schema), rows and total nulls (one pass)."""
    from pyspark.sql import types as T
    nums = numeric_columns(df)
    cats = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.agg(
        F.lit(len(df.columns)).cast("long").alias("total_features"),
        F.lit(len(nums)).cast("long").alias("numeric_features"),
        F.lit(len(cats)).cast("long").alias("categorical_features"),
        F.count(F.lit(1)).alias("rows"),
        null_count(df.columns).alias("missing_values"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, max per column, in long format from one aggregation."""
    aggs = []
    for i, c in enumerate(columns):
        x = _q(c)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).cast("double").alias(f"lo{i}"), F.max(x).cast("double").alias(f"hi{i}")]
    wide = df.agg(*aggs)
    names = ("count", "mean", "std", "min", "max")
    rows = [F.struct(F.lit(c).alias("column"), *[F.col(f"{a}{i}").alias(b) for a, b in zip(("n", "m", "s", "lo", "hi"), names)])
            for i, c in enumerate(columns)]
    return wide.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def gaps(df: DataFrame, keys: Sequence[str] = (), time_col: str = "time",
         expected_seconds: int = 3600, bucket: str = "day") -> DataFrame:
    """Consecutive rows of a series further apart than the expected step."""
    out = positional(df.select(*keys, time_col),
                     lambda w: [F.lag(_q(time_col), 1).over(w).alias("prev_time")], 1, keys, time_col,
                     bucket=bucket)
    secs = F.unix_seconds(_q(time_col).cast("timestamp")) - F.unix_seconds(F.col("prev_time").cast("timestamp"))
    return (out.withColumn("gap_hours", secs.cast("double") / 3600.0)
               .where(secs > expected_seconds))


def split_validation(df: DataFrame, keys: Sequence[str] = (), time_col: str = "time",
                     split_col: str = "split", train: str = "train", test: str = "test",
                     value_cols: Sequence[str] = ()) -> DataFrame:
    """Rows of (check, split, n_bad, ok).

    * order: test rows not strictly after the last train row of their series
    * overlap: (series, time) present in both splits
    * duplicates: extra rows per (series, time) inside a split
    * nulls: rows with a NULL in ``value_cols``
    All four come from aggregations over small per-key or per-(key, time) tables.
    """
    keys = list(keys)
    keyless = not keys
    if keyless:
        df, keys = df.withColumn("_all", F.lit(0)), ["_all"]
    last_train = df.where(F.col(split_col) == train).groupBy(*keys).agg(F.max(time_col).alias("_lt"))
    tst = df.where(F.col(split_col) == test)
    # keyless: last_train is one row (proven size) -> broadcast, never a constant-key shuffle
    order_bad = tst.join(F.broadcast(last_train) if keyless else last_train, keys, "left")
    order_bad = order_bad.agg(F.sum(F.when(F.col(time_col) <= F.col("_lt"), 1).otherwise(0)).cast("long").alias("n_bad"))
    per_time = df.groupBy(*keys, time_col).agg(
        F.sum(F.when(F.col(split_col) == train, 1).otherwise(0)).alias("_tr"),
        F.sum(F.when(F.col(split_col) == test, 1).otherwise(0)).alias("_te"))
    overlap = per_time.agg(F.sum(F.when((F.col("_tr") > 0) & (F.col("_te") > 0), 1).otherwise(0)).cast("long").alias("n_bad"))
    dup = per_time.agg(F.sum(F.greatest(F.col("_tr") - 1, F.lit(0))).cast("long").alias("tr"),
                       F.sum(F.greatest(F.col("_te") - 1, F.lit(0))).cast("long").alias("te"))
    anynull = F.lit(False)
    for c in value_cols:
        anynull = anynull | _q(c).isNull()
    nulls = df.groupBy(split_col).agg(F.sum(F.when(anynull, 1).otherwise(0)).cast("long").alias("n_bad"))
    rows = (order_bad.select(F.lit("order").alias("check"), F.lit("test").alias("split"), "n_bad")
            .unionByName(overlap.select(F.lit("overlap").alias("check"), F.lit("all").alias("split"), "n_bad"))
            .unionByName(dup.select(F.lit("duplicates").alias("check"), F.lit(train).alias("split"), F.col("tr").alias("n_bad")))
            .unionByName(dup.select(F.lit("duplicates").alias("check"), F.lit(test).alias("split"), F.col("te").alias("n_bad")))
            .unionByName(nulls.select(F.lit("nulls").alias("check"), F.col(split_col).alias("split"), "n_bad")))
    return rows.withColumn("ok", F.col("n_bad") == 0)
