"""Linear models from sufficient statistics: one aggregation pass gives per
group (e.g. per fold) the means and the population covariance matrix of [features, y];
the p x p solves happen on the driver (p = number of features, never the data size).

Covariances use Spark's numerically stable covar_pop rather than raw power sums.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def gram_stats(df: DataFrame, features: Sequence[str], target: str, group: Sequence[str] = ()) -> DataFrame:
    """One row per group: n, mean_j, mean_y, cov_jk (j <= k), cov_jy, var_y (population)."""
    feats = list(features)
    both = F.lit(True)
    for c in feats + [target]:
        both = both & _q(c).isNotNull()
    d = df.where(both)
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(_q(target)).alias("my"), F.var_pop(_q(target)).alias("vy")]
    aggs += [F.avg(_q(c)).alias(f"m{j}") for j, c in enumerate(feats)]
    aggs += [F.covar_pop(_q(a), _q(b)).alias(f"c{j}_{k}") for j, a in enumerate(feats) for k, b in enumerate(feats) if j <= k]
    aggs += [F.covar_pop(_q(c), _q(target)).alias(f"cy{j}") for j, c in enumerate(feats)]
    return d.groupBy(*group).agg(*aggs)


def lasso_cd(C: np.ndarray, c: np.ndarray, alpha: float, tol: float = 1e-12, max_iter: int = 100000,
             start: np.ndarray | None = None) -> np.ndarray:
    """Coordinate descent for min_w 1/2 w'Cw - c'w + alpha |w|_1 (the lasso objective
    (1/2n)||y - b - Zw||^2 + alpha |w|_1 written with centred moments)."""
    w = np.zeros(len(c)) if start is None else start.copy()
    for _ in range(max_iter):
        delta = 0.0
        for j in range(len(c)):
            if C[j, j] <= 0:
                continue
            rho = c[j] - C[j] @ w + C[j, j] * w[j]
            new = np.sign(rho) * max(abs(rho) - alpha, 0.0) / C[j, j]
            delta = max(delta, abs(new - w[j]))
            w[j] = new
        if delta < tol:
            return w
    raise RuntimeError(f"lasso (alpha {alpha:g}) did not settle in {max_iter} passes: last change {delta:.3g}")


def solve(row, p: int, alpha: float = 0.0, standardize: bool = False) -> tuple[float, np.ndarray]:
    """(intercept, coefficients) of OLS / ridge from one gram_stats row.

    ``standardize``: ridge on z = (x - mean) / std_pop (coefficients returned in z units),
    minimising ||y - b - Z w||^2 + alpha ||w||^2."""
    n = float(row["n"])
    C = np.empty((p, p))
    for j in range(p):
        for k in range(j, p):
            C[j, k] = C[k, j] = row[f"c{j}_{k}"]
    cy = np.array([row[f"cy{j}"] for j in range(p)])
    m = np.array([row[f"m{j}"] for j in range(p)])
    if standardize:
        sd = np.sqrt(np.diag(C))
        sd[sd == 0] = 1.0
        C = C / np.outer(sd, sd)
        cy = cy / sd
        m = np.zeros(p)
    w = np.linalg.solve(n * C + alpha * np.eye(p), n * cy)
    return float(row["my"] - m @ w), w


def fit_gram(df: DataFrame, features: Sequence[str], target: str, alpha: float = 0.0,
             standardize: bool = False) -> DataFrame:
    """(term, value) coefficients of OLS / ridge computed from one aggregation pass."""
    row = gram_stats(df, features, target).first()      # one row: the statistics, not the data
    b0, w = solve(row, len(features), alpha, standardize)
    rows = [("intercept", b0)] + [(c, float(v)) for c, v in zip(features, w)]
    return df.sparkSession.createDataFrame(rows, "term STRING, value DOUBLE")


def _cv_gram(kind: str, train: DataFrame, features: Sequence[str], target: str, alphas: Sequence[float],
             n_splits: int, keys: Sequence[str], time_col: str, cv_strategy: str) -> DataFrame:
    from .moments import linear_grid, segment_moments
    from .splits import fold_marks
    cols = list(dict.fromkeys([*keys, time_col, *features, target]))
    marks = fold_marks(train.select(*[_q(c) for c in cols]), n_splits, cv_strategy, keys, time_col)
    scores = linear_grid(segment_moments(marks, features, target), n_splits, kind, alphas)
    return train.sparkSession.createDataFrame([row[:4] for row in scores], "grid_idx INT, alpha DOUBLE, fold INT, mse DOUBLE")


def ridge_cv_gram(train: DataFrame, features: Sequence[str], target: str, alphas: Sequence[float], n_splits: int = 5,
                  keys: Sequence[str] = (), time_col: str = "time", cv_strategy: str = "timeseries") -> DataFrame:
    """G5 for multi-feature ridge inside standardise-then-regress, for the WHOLE alpha grid from one scan of
    marked rows (operators.moments).  Returns (grid_idx, alpha, fold, mse)."""
    return _cv_gram("ridge", train, features, target, alphas, n_splits, keys, time_col, cv_strategy)


def lasso_cv_gram(train: DataFrame, features: Sequence[str], target: str, alphas: Sequence[float], n_splits: int = 5,
                  keys: Sequence[str] = (), time_col: str = "time", cv_strategy: str = "timeseries") -> DataFrame:
    """The same for lasso, by coordinate descent on p x p matrices."""
    return _cv_gram("lasso", train, features, target, alphas, n_splits, keys, time_col, cv_strategy)
