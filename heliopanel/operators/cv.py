"""Cross-validated scoring of closed-form models from sufficient statistics.

Models whose fit is a handful of aggregates — naive lags, the training mean, one-feature
OLS and ridge on a standardised feature — are fitted for every fold (and every grid value)
in ONE grouped aggregation over the (fold, role) expansion of the training rows; the fits
table has folds x grid rows, so it is broadcast (size bounded by the parameters).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .splits import fold_pairs, ts_folds

BASELINES = ["naive_lag1", "naive_lag24"]
TRAINED = ["train_mean", "ols_rad"]


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def fit_stats(train: DataFrame, y: str, x: str, group: Sequence[str] = ()) -> DataFrame:
    """Sufficient statistics per group: n, means, population covariance and variance."""
    return train.groupBy(*group).agg(
        F.count(_q(y)).alias("n_fit"), F.avg(_q(y)).alias("my"), F.avg(_q(x)).alias("mx"),
        F.covar_pop(_q(x), _q(y)).alias("cxy"), F.var_pop(_q(x)).alias("vx"))


def predictions(rows: DataFrame, fits: DataFrame, y: str, x: str, lag1: str, lag24: str,
                group: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Long (model, y, pred) rows for the closed-form model set.

    ols: my + cxy / vx * (x - mx) (the least-squares line through the means)."""
    group = list(group)
    if group:
        j = rows.join(F.broadcast(fits), group)
    else:   # one fitted row (a handful of numbers): inline it as literals, no join at all
        f = fits.first()
        j = rows.select("*", *[F.lit(f[c]).cast("double").alias(c) for c in ("my", "mx", "cxy", "vx")])
    preds = F.array(
        F.struct(F.lit("naive_lag1").alias("model"), _q(lag1).alias("pred")),
        F.struct(F.lit("naive_lag24").alias("model"), _q(lag24).alias("pred")),
        F.struct(F.lit("train_mean").alias("model"), F.col("my").alias("pred")),
        F.struct(F.lit("ols_rad").alias("model"),
                 (F.col("my") + F.col("cxy") / F.col("vx") * (_q(x) - F.col("mx"))).alias("pred")))
    return j.select(*group, *[_q(c) for c in keep], _q(y).alias("y"), F.explode(preds).alias("_m")) \
            .select(*group, *keep, "y", "_m.model", "_m.pred")


def cv_scores(train: DataFrame, y: str, x: str, lag1: str, lag24: str, n_splits: int = 5,
              keys: Sequence[str] = (), time_col: str = "time") -> DataFrame:
    """G3 + per-fold RMSE of every closed-form model: (model, fold, rmse, n)."""
    folds = fold_pairs(ts_folds(train, n_splits, keys, time_col), n_splits)
    fits = fit_stats(folds.where(F.col("role") == "train"), y, x, ["fold"])
    test = folds.where(F.col("role") == "test")
    p = predictions(test, fits, y, x, lag1, lag24, ["fold"])
    e = F.col("pred") - F.col("y")
    return p.groupBy("model", "fold").agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.count(e).alias("n"))


def ridge_grid_scores(train: DataFrame, y: str, x: str, alphas: Sequence[float], n_splits: int = 5,
                      keys: Sequence[str] = (), time_col: str = "time") -> DataFrame:
    """G5 for one-feature ridge inside a standardise-then-regress pipeline.

    With z = (x - mean) / std_pop fitted on the fold's training rows, the ridge solution is
    intercept = mean(y), slope_z = n cov(x, y) / ((n + alpha) std(x)); so
    pred = my + n cxy / ((n + alpha) vx) * (x - mx).  Scores: mean negative MSE over folds;
    rank 1 = best, ties -> earlier grid entry (like GridSearchCV).
    Returns (grid_idx, alpha, mean_test_score, std_test_score, rank_test_score)."""
    folds = fold_pairs(ts_folds(train, n_splits, keys, time_col), n_splits)
    fits = fit_stats(folds.where(F.col("role") == "train"), y, x, ["fold"])
    grid = F.array(*[F.struct(F.lit(i).alias("grid_idx"), F.lit(float(a)).alias("alpha")) for i, a in enumerate(alphas)])
    fits = fits.select("*", F.explode(grid).alias("_g")).select("*", "_g.grid_idx", "_g.alpha").drop("_g")
    test = folds.where(F.col("role") == "test")
    j = test.join(F.broadcast(fits), "fold")
    n = F.col("n_fit").cast("double")
    pred = F.col("my") + n * F.col("cxy") / ((n + F.col("alpha")) * F.col("vx")) * (_q(x) - F.col("mx"))
    e = pred - _q(y)
    per_fold = j.groupBy("grid_idx", "alpha", "fold").agg((-F.avg(e * e)).alias("score"))
    from pyspark.sql import Window
    s = per_fold.groupBy("grid_idx", "alpha").agg(F.avg("score").alias("mean_test_score"),
                                                 F.stddev_pop("score").alias("std_test_score"))
    return s.withColumn("rank_test_score",
                        F.row_number().over(Window.orderBy(F.col("mean_test_score").desc(), "grid_idx")))
