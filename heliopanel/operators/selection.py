"""Correlation-based feature selection (B6, B7, D7-D10, E9), fitted on training rows only.

All p target correlations come from ONE aggregation over the data; everything after that
works on a p-row table (p = number of numeric columns), so collecting the chosen names to
the driver is bounded by the schema width, never by the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .panel import numeric_columns


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def pearson(a: Column, b: Column) -> Column:
    """Pairwise-complete Pearson r; NULL (not an error, not NaN) for a constant column."""
    both = a.isNotNull() & b.isNotNull()
    aa, bb = F.when(both, a.cast("double")), F.when(both, b.cast("double"))
    return F.try_divide(F.covar_pop(aa, bb), F.stddev_pop(aa) * F.stddev_pop(bb))


def _unpivot(wide: DataFrame, names: Sequence[str], prefix: str, value: str) -> DataFrame:
    """One row per name from the columns <prefix>0, <prefix>1, ...; names are literals, so any text is allowed."""
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"{prefix}{i}").alias(value)) for i, c in enumerate(names)]
    return wide.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


@dataclass
class SelectorParams:
    target: str = "pv_production"
    threshold: float = 0.5
    top_k: int = 30
    must_include: list[str] = field(default_factory=list)
    exclude_columns: list[str] = field(default_factory=list)
    exclude_patterns: list[str] = field(default_factory=list)

    def excluded(self, feature: str) -> bool:
        """Target, an explicitly excluded name, or any excluded substring."""
        return (feature == self.target or feature in self.exclude_columns
                or any(p in feature for p in self.exclude_patterns))


def target_correlation(df: DataFrame, params: SelectorParams, keys: Sequence[str] = ()) -> DataFrame:
    """(feature, correlation, abs_correlation, rank) for every numeric, non-excluded
    column with a defined correlation; rank 1 = largest |r| (ties by name)."""
    if params.target not in df.columns:
        raise ValueError(f"target column '{params.target}' not in data")
    nums = [c for c in numeric_columns(df) if c not in keys]
    if params.target not in nums:
        raise ValueError(f"target column '{params.target}' must be numeric")
    feats = [c for c in nums if not params.excluded(c)]
    y = _q(params.target)
    wide = df.agg(*[pearson(_q(c), y).alias(f"r{i}") for i, c in enumerate(feats)])
    long = _unpivot(wide, feats, "r", "correlation").where("correlation IS NOT NULL")
    w = Window.orderBy(F.abs("correlation").desc(), "feature")   # p rows: a tiny table
    return long.select("feature", "correlation", F.abs("correlation").alias("abs_correlation"),
                       F.row_number().over(w).alias("rank"))


def _partial_products(names: Sequence[str], shift: Sequence[float]):
    """Per task: for every pair of columns the counts, sums and products of rows that have both."""
    p = len(names)

    def run(batches):
        total = np.zeros((4, p, p))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]) - shift
            here = ~np.isnan(x)
            x = np.where(here, x, 0.0)
            m = here.astype(float)
            total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        i, j = np.indices((p, p))
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()),
                                          *[pa.array(t.ravel()) for t in total]], ["i", "j", "n", "s", "ss", "sp"])
    return run


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long (feature_a, feature_b, corr) for all ordered pairs, pairwise complete.

    One pass of matrix products per task (p x p partial sums, whatever the rows), summed up
    per pair; values are shifted by the column's minimum first, so that sums stay small."""
    columns = list(columns)
    low = df.agg(*[F.min(_q(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    shift = np.array([0.0 if v is None else v for v in low])
    wide = df.select(*[F.nanvl(_q(c).cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, c in enumerate(columns)])
    parts = wide.mapInArrow(_partial_products(columns, shift), "i int, j int, n double, s double, ss double, sp double")
    sums = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "s", "ss", "sp")])
    # s and ss are of column i over rows with both; those of column j stand in row (j, i)
    turned = sums.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("s").alias("t"), F.col("ss").alias("tt"))
    both = sums.join(turned, ["i", "j"])

    def spread(s, ss):
        """n * variance, 0 where only rounding is left of a constant."""
        v = F.col(ss) - F.col(s) * F.col(s) / F.col("n")
        return F.when(v <= F.col(ss) * 1e-13, 0.0).otherwise(v)

    r = F.when(F.col("n") > 0, F.try_divide(F.col("sp") - F.col("s") * F.col("t") / F.col("n"),
                                            F.sqrt(spread("s", "ss")) * F.sqrt(spread("t", "tt"))))
    name = lambda c: F.element_at(F.array(*[F.lit(x) for x in columns]), F.col(c) + 1)
    return both.select(name("i").alias("feature_a"), name("j").alias("feature_b"),
                       F.when(F.col("i") == F.col("j"), 1.0).otherwise(r).alias("corr"))


def fit_selection(corr: DataFrame, params: SelectorParams, columns: Sequence[str]) -> DataFrame:
    """Threshold -> first top_k by |r| -> append must_include names that exist, are not
    the target, not excluded and not already chosen.  Returns (feature, position,
    correlation, must_include); position is 1-based selection order."""
    cand = corr.where(F.col("abs_correlation") >= params.threshold)
    cand = cand.withColumn("position", F.row_number().over(Window.orderBy("rank"))).where(F.col("position") <= params.top_k)
    chosen = cand.select("feature", "position", "correlation")
    extra = [m for m in params.must_include if m in columns and not params.excluded(m)]
    spark = corr.sparkSession
    must = spark.createDataFrame([(m, i) for i, m in enumerate(extra)], "feature STRING, _mi INT")
    add = (must.join(chosen, "feature", "left_anti")
               .join(corr.select("feature", "correlation"), "feature", "left")
               .select("feature", F.lit(1).alias("_grp"), F.col("_mi").cast("long").alias("_ord"), "correlation"))
    both = chosen.select("feature", F.lit(0).alias("_grp"), F.col("position").cast("long").alias("_ord"),
                         "correlation").unionByName(add)
    both = both.withColumn("position", F.row_number().over(Window.orderBy("_grp", "_ord")).cast("int"))
    return (both.drop("_grp", "_ord")
                .withColumn("must_include", F.col("feature").isin(list(params.must_include)) if params.must_include
                            else F.lit(False)))


def selected_names(selection: DataFrame) -> list[str]:
    """Names in selection order (the selection table has at most top_k + |must_include| rows)."""
    return [r["feature"] for r in selection.orderBy("position").select("feature").collect()]


def feature_report(df: DataFrame, corr: DataFrame, selection: DataFrame, params: SelectorParams) -> DataFrame:
    """Per correlated, non-excluded feature: r, |r|, missing rate, selected, must_include."""
    feats = [r["feature"] for r in corr.select("feature").collect()]   # p rows
    if not feats:
        return corr.select("feature", "correlation", "abs_correlation").withColumn("missing_rate", F.lit(None))
    miss = df.agg(*[F.avg(_q(c).isNull().cast("double")).alias(f"m{i}") for i, c in enumerate(feats)])
    miss = _unpivot(miss, feats, "m", "missing_rate")
    sel = selection.select("feature", F.lit(True).alias("selected"))
    return (corr.join(miss, "feature").join(sel, "feature", "left")
                .select("feature", "correlation", "abs_correlation", "missing_rate",
                        F.coalesce("selected", F.lit(False)).alias("selected"),
                        F.col("feature").isin(list(params.must_include) or [""]).alias("must_include")))


def apply_selection(df: DataFrame, names: Sequence[str], target: str | None = None,
                    keep: Sequence[str] = ()) -> DataFrame:
    """The same ordered columns for any split; missing names raise; empty selection raises."""
    if not names:
        raise ValueError("no selected features: fit the selector first")
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"selected features missing from data: {missing}")
    cols = list(keep) + list(names) + ([target] if target and target in df.columns else [])
    return df.select(*[_q(c) for c in cols])
