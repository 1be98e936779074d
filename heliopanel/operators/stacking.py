"""Stacked models: a non-negative combination of several models, weighed on out-of-fold predictions.

The out-of-fold table has a row per test row of a fold and a column per model, each predicted by the
model that the row's fold did not train.  The weights minimise the squared error plus
``alpha * |w|^2`` over w >= 0, which needs the products of the columns alone: one aggregation, a
models x models matrix on the driver.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import models as M


def _q(c: str):
    return F.col(f"`{c}`")


def fold_predictions(marks: DataFrame, features: Sequence[str], target: str, name: str, params: dict, n_folds: int) -> DataFrame:
    """(row_key, p) of one model for the test rows of every fold."""
    if name in M.GRAM_ESTIMATORS:
        from .moments import fit, fold_moments, segment_moments
        alpha = float(params.get("alpha", M.DEFAULT_ALPHA))
        p = F.lit(None).cast("double")
        for f, (train, _) in fold_moments(segment_moments(marks, features, target), n_folds).items():
            b, w, mean, sd = fit(train, M.GRAM_ESTIMATORS[name], alpha)
            line = F.lit(b)
            for c, v, m, s in zip(features, w, mean, sd):
                line = line + float(v) * ((_q(c) - float(m)) / float(s))
            p = F.when(F.col("test_fold") == f, line).otherwise(p)
        return marks.where("test_fold is not null").select("row_key", p.alias("p"))
    one = {c: [v] for c, v in params.items()}
    if name == "binned_forest":
        from .trees import forest_predictions
        out, sets, _ = forest_predictions(marks, features, target, one, n_folds)
        return out.select(F.col("key").alias("row_key"), F.col(sets[0][1].split(":")[1]).alias("p"))
    if name == "boosted_trees":
        from .boosting import boost_predictions
        out, _ = boost_predictions(marks, features, target, one, n_folds)
        return out.select(F.col("key").alias("row_key"), F.col("p")[0].alias("p"))
    if name == "knn":
        from .neighbours import neighbour_values, weighted
        k = int(params.get("n_neighbors", 5))
        return neighbour_values(marks, features, target, k, n_folds, [weighted(k, params.get("weights", "uniform")).alias("p")]) \
            .select(F.col("query").alias("row_key"), "p")
    out = None
    for f in range(n_folds):
        fm = M.fit(marks.where(F.col("trains").bitwiseAND(F.lit(1 << f)) != 0), features, target, name, params)
        part = fm.transform(marks.where(F.col("test_fold") == f)).select("row_key", F.col(M.PRED_COL).alias("p"))
        out = part if out is None else out.union(part)
    return out


def out_of_fold(marks: DataFrame, features: Sequence[str], target: str, models: dict[str, tuple[str, dict]], n_folds: int) -> DataFrame:
    """(row_key, y, p0, p1, ...) of the rows that every model predicts; ``marks`` by ``models.cv_marks``."""
    out = marks.where("test_fold is not null").select("row_key", _q(target).cast("double").alias("y"))
    for i, (name, params) in enumerate(models.values()):
        out = out.join(fold_predictions(marks, features, target, name, params, n_folds).withColumnRenamed("p", f"p{i}"), "row_key")
    return stage(out.dropna(), "out_of_fold")


def nonnegative(gram: np.ndarray, right: np.ndarray) -> np.ndarray:
    """w >= 0 that minimises w'Gw - 2 r'w (active sets; G positive definite)."""
    n = len(right)
    w, free = np.zeros(n), np.zeros(n, bool)
    for _ in range(50 * n):
        slope = right - gram @ w
        wanted = ~free & (slope > 1e-12 * max(1.0, np.abs(right).max()))
        if not wanted.any():
            break
        free[np.where(wanted, slope, -np.inf).argmax()] = True
        while True:
            s = np.zeros(n)
            s[free] = np.linalg.solve(gram[np.ix_(free, free)], right[free])
            if (s[free] > 0).all():
                break
            low = free & (s <= 0)
            step = np.min(w[low] / np.maximum(w[low] - s[low], 1e-300))
            w = w + step * (s - w)
            free &= w > 1e-15
            w[~free] = 0.0
        w = s
    return w


def weights(table: DataFrame, n_models: int, alpha: float = 0.0) -> list[float]:
    """The combination's weights from an out-of-fold table."""
    ps = [F.col(f"p{i}") for i in range(n_models)]
    row = table.agg(*[F.avg(a * b).alias(f"g{i}_{j}") for i, a in enumerate(ps) for j, b in enumerate(ps) if i <= j],
                    *[F.avg(a * F.col("y")).alias(f"r{i}") for i, a in enumerate(ps)], F.count(F.lit(1)).alias("n")).first()    # one row
    if not row["n"]:
        raise ValueError("no out-of-fold predictions")
    gram = np.array([[row[f"g{min(i, j)}_{max(i, j)}"] for j in range(n_models)] for i in range(n_models)])
    gram = gram + (alpha / row["n"] + 1e-12 * max(gram.trace(), 1e-300)) * np.eye(n_models)
    return nonnegative(gram, np.array([row[f"r{i}"] for i in range(n_models)])).tolist()


@dataclass
class Stack:
    """Fitted models by name, and what each weighs."""
    models: dict[str, M.FittedModel]
    weights: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``; models of weight zero are not asked."""
        cols, total = df.columns, F.lit(0.0)
        for i, (name, fm) in enumerate((n, m) for n, m in self.models.items() if self.weights[n] > 0):
            df = fm.transform(df).withColumnRenamed(M.PRED_COL, f"__p{i}")
            total = total + self.weights[name] * F.col(f"__p{i}")
        return df.select(*[_q(c) for c in cols], total.alias(M.PRED_COL))


def fit_stack(train: DataFrame, features: Sequence[str], target: str, models: dict[str, tuple[str, dict]], n_splits: int = 5,
              keys: Sequence[str] = (), time_col: str = "time", cv_strategy: str = "timeseries", alpha: float = 0.0) -> Stack:
    """Weigh the models (name -> (estimator, parameters)) on out-of-fold rows, then fit each on all rows."""
    marks = M.cv_marks(train, features, target, n_splits, keys, time_col, cv_strategy)
    table = out_of_fold(marks, features, target, models, n_splits)
    w = dict(zip(models, weights(table, len(models), alpha)))
    return Stack({n: M.fit(train, features, target, est, json.loads(json.dumps(p))) for n, (est, p) in models.items()}, w)
