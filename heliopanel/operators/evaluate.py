"""Evaluation tables (D11-D16, G3, G4, G12, G15, G16) as plain aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def metric_exprs(y: Column, yhat: Column, explained_variance: bool = False) -> list[Column]:
    """Rmse, mae, r2, mape (% over non-zero actuals; NULL when none) in one pass.

    r2 follows the usual finite convention: constant actuals give 1 when the fit is exact,
    else 0.  Rows with a NULL actual or prediction are ignored.
    """
    both = y.isNotNull() & yhat.isNotNull()
    yy = F.when(both, y)
    e = F.when(both, yhat - y)
    mse = F.avg(e * e)
    vy = F.var_pop(yy)
    r2 = (F.when(vy == 0, F.when(mse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
           .otherwise(F.lit(1.0) - mse / vy))
    out = [
        F.count(e).alias("n"),
        F.sqrt(mse).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        r2.alias("r2"),
        (F.avg(F.when(yy != 0, F.abs(e / yy))) * 100.0).alias("mape"),
    ]
    if explained_variance:
        ve = F.var_pop(e)
        out.append(F.when(vy == 0, F.when(ve == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
                    .otherwise(F.lit(1.0) - ve / vy).alias("explained_variance"))
    return out


def regression_metrics(df: DataFrame, y: str, yhat: str, group: Sequence[str] = (),
                       explained_variance: bool = False) -> DataFrame:
    """Metrics per group (model, split, site, ...): partial aggregation, one shuffle of
    one row per group and partition."""
    return df.groupBy(*group).agg(*metric_exprs(_q(y), _q(yhat), explained_variance))


def error_breakdown(df: DataFrame, y: str, yhat: str, segments: dict[str, Column]) -> DataFrame:
    """Metrics per segment for several segmentations in ONE pass: every row is
    emitted once per segmentation (stack via explode of a fixed-size array), then one
    grouped aggregation.  Returns (segmentation, segment, n, rmse, mae, bias)."""
    arr = F.array(*[F.struct(F.lit(name).alias("segmentation"), expr.cast("string").alias("segment"))
                    for name, expr in segments.items()])
    long = df.select(_q(y).alias("_y"), _q(yhat).alias("_p"), F.explode(arr).alias("_s"))
    e = F.col("_p") - F.col("_y")
    return (long.groupBy(F.col("_s.segmentation").alias("segmentation"), F.col("_s.segment").alias("segment"))
                .agg(F.count(e).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"),
                     F.avg(F.abs(e)).alias("mae"), F.avg(e).alias("bias")))


def cv_summary(cv: DataFrame, model_col: str = "model", score_col: str = "rmse") -> DataFrame:
    """Mean and POPULATION std of fold scores per model; rank 1 = lowest mean."""
    s = cv.groupBy(model_col).agg(F.avg(score_col).alias("mean_cv_rmse"),
                                  F.stddev_pop(score_col).alias("std_cv_rmse"),
                                  F.count(score_col).alias("n_folds"))
    return s.withColumn("rank", F.row_number().over(Window.orderBy("mean_cv_rmse", model_col)))


def paired_ttest(cv: DataFrame, model_col: str = "model", fold_col: str = "fold",
                 score_col: str = "rmse", symmetric: bool = False) -> DataFrame:
    """One-sided paired t-test on per-fold scores for every ordered pair (a, b).

    p_value = P(T_{n-1} <= t) for d = score_a - score_b, i.e. small when a is better.
    Directional by default (p(b, a) = 1 - p(a, b)); ``symmetric=True`` writes the
    (a < b) value into both cells.  Zero variance of d gives NULL t and p.
    The self-join is on the fold key: models x models x folds rows — a small table.
    """
    from ..functions.stats import student_t_cdf
    a = cv.select(F.col(model_col).alias("model_a"), F.col(fold_col).alias("_f"), F.col(score_col).alias("_sa"))
    b = cv.select(F.col(model_col).alias("model_b"), F.col(fold_col).alias("_f"), F.col(score_col).alias("_sb"))
    d = a.join(b, "_f").where(F.col("model_a") != F.col("model_b")).withColumn("_d", F.col("_sa") - F.col("_sb"))
    g = d.groupBy("model_a", "model_b").agg(F.avg("_d").alias("mean_diff"), F.stddev_samp("_d").alias("_sd"),
                                            F.count("_d").alias("n"))
    t = F.try_divide(F.col("mean_diff"), F.col("_sd") / F.sqrt(F.col("n").cast("double")))
    g = g.withColumn("t_stat", F.when(F.col("_sd") > 0, t))
    g = g.withColumn("p_value", student_t_cdf(F.col("t_stat"), F.col("n") - 1)).drop("_sd")
    if symmetric:
        lo = F.least("model_a", "model_b")
        w = Window.partitionBy(lo, F.greatest("model_a", "model_b"))
        g = g.withColumn("p_value", F.max(F.when(F.col("model_a") == lo, F.col("p_value"))).over(w))
    return g
