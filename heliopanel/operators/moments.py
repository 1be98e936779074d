"""Linear models of all folds from mergeable moment blocks (G3-G8; one scan, no copied row).

Rows carry fold marks (``splits.fold_marks``).  Rows with the same marks form a segment; a task
adds up the moments of each segment it meets (count, sums and the p x p products, about a common
centre so that sums stay small), blocks of rows at a time.  Moments of a segment add up, and a
fold's training moments are the sum of the segments that train it: expanding folds are prefix
sums, k-folds everything but one.  Segments number at most folds + 1, so what reaches the driver
is a few p x p matrices; solves and validation errors follow from them without the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linear import lasso_cd

SALTS = 16


@dataclass
class Moments:
    """Of columns (features..., target) about ``centre``: rows, sums, products."""
    n: float
    s: np.ndarray
    q: np.ndarray
    centre: np.ndarray

    def __add__(self, other: "Moments") -> "Moments":
        return Moments(self.n + other.n, self.s + other.s, self.q + other.q, self.centre)

    @property
    def mean(self) -> np.ndarray:
        return self.centre + self.s / self.n

    @property
    def cov(self) -> np.ndarray:
        """Population covariances."""
        m = self.s / self.n
        return self.q / self.n - np.outer(m, m)


def _partials(batches, width: int, centre: np.ndarray):
    """(trains, test, sums) per segment of a task; batches hold the columns, then trains, test."""
    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        x = np.stack([batch.column(j).to_numpy(zero_copy_only=False) for j in range(width)], axis=1) - centre
        marks = np.stack([batch.column(width).to_numpy(), batch.column(width + 1).to_numpy()], axis=1)
        for a, b in np.unique(marks, axis=0).tolist():
            part = x[(marks[:, 0] == a) & (marks[:, 1] == b)]
            sums = np.concatenate([[len(part)], part.sum(axis=0), (part.T @ part).ravel()])
            total[a, b] = total.get((a, b), 0.0) + sums
    yield _sums([(a, b, s) for (a, b), s in total.items()])


def _sums(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                                       pa.array([r[2].tolist() for r in rows], pa.list_(pa.float64()))], ["trains", "test", "sums"])


def _added(batches):
    """Sums of the rows of each segment."""
    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for a, b, s in zip(*(c.to_pylist() for c in batch.columns)):
            total[a, b] = total.get((a, b), 0.0) + np.array(s)
    yield _sums([(a, b, s) for (a, b), s in total.items()])


def segment_moments(rows: DataFrame, features: Sequence[str], target: str) -> dict[tuple[int, int], Moments]:
    """{(trains, test fold or -1): moments} of rows with fold marks; rows with a null column take no part."""
    names = [*features, target]
    data = rows.select(*[F.col(f"`{c}`").cast("double").alias(f"c{j}") for j, c in enumerate(names)],
                       F.col("trains").cast("int").alias("trains"), F.coalesce("test_fold", F.lit(-1)).cast("int").alias("test"))
    data = data.dropna(subset=[f"c{j}" for j in range(len(names))])
    first = data.limit(1).collect()             # any row: products are taken about it
    if not first:
        return {}
    centre, width = np.array([first[0][f"c{j}"] for j in range(len(names))]), len(names)
    schema = "trains int, test int, sums array<double>"
    parts = data.mapInArrow(lambda it: _partials(it, width, centre), schema)
    # one row a task and segment: added up by salted groups, then once more
    parts = parts.repartition(SALTS).mapInArrow(_added, schema)
    out: dict[tuple[int, int], Moments] = {}
    for r in parts.collect():                   # SALTS rows a segment
        s = np.array(r["sums"])
        m = Moments(s[0], s[1:width + 1], s[width + 1:].reshape(width, width), centre)
        key = (r["trains"], r["test"])
        out[key] = out[key] + m if key in out else m
    return out


def fold_moments(segments: dict[tuple[int, int], Moments], n_splits: int) -> dict[int, tuple[Moments, Moments]]:
    """{fold: (training moments, test moments)} of the folds that have both."""
    out = {}
    for f in range(n_splits):
        train = [m for (trains, _), m in sorted(segments.items()) if trains >> f & 1]
        test = [m for (_, t), m in sorted(segments.items()) if t == f]
        if train and test:
            out[f] = (sum(train[1:], train[0]), sum(test[1:], test[0]))
    return out


def fit(m: Moments, kind: str, alpha: float = 0.0, start: np.ndarray | None = None,
        standardise: bool = True) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """(intercept, coefficients) of the standardised (or only centred) features, with the features' means
    and scales.

    ``kind``: 'linear', 'ridge' (sum of squared errors + alpha |w|^2) or 'lasso' (half the mean squared
    error + alpha |w|)."""
    cov, mean = m.cov, m.mean
    p = len(mean) - 1
    sd = np.sqrt(np.maximum(np.diag(cov)[:p], 0.0))
    sd = np.where((sd > 1e-12 * np.maximum(np.abs(mean[:p]), 1e-300)) & standardise, sd, 1.0)
    c, cy = cov[:p, :p] / np.outer(sd, sd), cov[:p, p] / sd
    if kind == "lasso":
        w = lasso_cd(c, cy, alpha, start=start)
    elif kind == "ridge":
        w = np.linalg.solve(m.n * c + alpha * np.eye(p), m.n * cy)
    else:
        w = np.linalg.lstsq(c, cy, rcond=None)[0]
    return float(mean[p]), w, mean[:p], sd


def mse(test: Moments, intercept: float, w: np.ndarray, mean: np.ndarray, sd: np.ndarray) -> float:
    """Mean squared error of intercept + w . (x - mean) / sd over the rows behind the test moments."""
    p = len(mean)
    u = w / sd
    off = test.mean[p] - intercept - (test.mean[:p] - mean) @ u
    return float(test.cov[p, p] - 2 * u @ test.cov[:p, p] + u @ test.cov[:p, :p] @ u + off ** 2)


def linear_grid(segments: dict, n_splits: int, kind: str, alphas: Sequence[float]) -> list[tuple[int, float, int, float, int]]:
    """(grid_idx, alpha, fold, mse, n_test) of every alpha in every fold."""
    out = []
    for f, (train, test) in fold_moments(segments, n_splits).items():
        start = None
        for gi, a in sorted(enumerate(alphas), key=lambda t: -t[1]):        # lasso starts from the next larger alpha
            b, w, mean, sd = fit(train, kind, float(a), start)
            start = w if kind == "lasso" else None
            out.append((gi, float(a), f, mse(test, b, w, mean, sd), int(test.n)))
    return sorted(out)


def _swept(a: np.ndarray, k: int, back: bool = False) -> np.ndarray:
    """The matrix swept on pivot k, or swept back."""
    d, sign = a[k, k], -1.0 if back else 1.0
    out = a - np.outer(a[:, k], a[k, :]) / d
    out[:, k] = sign * a[:, k] / d
    out[k, :] = sign * a[k, :] / d
    out[k, k] = -1.0 / d
    return out


def recursive_elimination(m: Moments, features: Sequence[str], keep: float | int = 0.8) -> list[tuple[str, int, bool]]:
    """(feature, rank, selected): least squares on standardised features, dropping at every step the
    feature of the least absolute coefficient (ties: the later one) until ``keep`` are left (a share of
    them, or a number).  Rank 1: kept; else the later a feature went, the smaller.

    All steps work on the moments: the matrix is swept on every feature once, and a feature is
    swept out again when it goes.  A feature without spread, or one that those before it determine,
    is never swept in and goes first."""
    p = len(features)
    wanted = max(1, int(p * keep)) if isinstance(keep, float) else max(1, min(int(keep), p))
    cov = m.cov
    sd = np.sqrt(np.maximum(np.diag(cov), 0.0))
    scale = np.where(sd > 0, sd, 1.0)
    a = cov / np.outer(scale, scale)
    inside = []
    for k in range(p):
        if a[k, k] > 1e-9:
            a = _swept(a, k)
            inside.append(k)
    gone = [k for k in range(p) if k not in inside][::-1]
    while len(gone) < p - wanted:
        k = min(inside, key=lambda j: (abs(a[j, p]), -j))
        a = _swept(a, k, back=True)
        inside.remove(k)
        gone.append(k)
    gone = gone[:p - wanted]
    rank = {k: len(gone) + 1 - i for i, k in enumerate(gone)}
    return [(f, rank.get(j, 1), j not in rank) for j, f in enumerate(features)]
