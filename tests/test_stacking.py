"""Stack weights in closed form, and against a search."""

import numpy as np

from heliopanel.operators import models as M, stacking as ST
from tests.test_grid_models import data, frame


def test_nonnegative_weights():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a = rng.normal(size=(40, 4))
        y = a @ rng.normal(size=4) + rng.normal(size=40)
        w = ST.nonnegative(a.T @ a, a.T @ y)
        slope = a.T @ (y - a @ w)
        assert (w >= 0).all() and np.abs(slope[w > 0]).max(initial=0) < 1e-8 and (slope[w == 0] <= 1e-8).all()


def test_two_models_in_closed_form(spark):
    x, y = data(240, 3, 4)
    df, names, trains, test = frame(spark, x, y)
    models = {"ols": ("linear_gram", {}), "knn": ("knn", {"n_neighbors": 4})}
    marks = M.cv_marks(df.drop("trains", "test_fold", "row_key"), names, "y", 4)
    table = ST.out_of_fold(marks, names, "y", models, 4)
    t = table.toPandas()
    assert len(t) == (test >= 0).sum()
    p = t[["p0", "p1"]].to_numpy()
    w = np.linalg.solve(p.T @ p, p.T @ t["y"].to_numpy())
    if w.min() < 0:
        w = np.array([max(0, p[:, i] @ t["y"] / (p[:, i] @ p[:, i])) if i == w.argmax() else 0 for i in range(2)])
    assert np.abs(np.array(ST.weights(table, 2)) - w).max() < 1e-6
    first = np.sqrt(((t["p0"] - t["y"]) ** 2).mean())
    tr, te = trains >> 1 & 1 == 1, test == 1
    z = np.column_stack([np.ones(tr.sum()), x[tr]])
    b = np.linalg.lstsq(z, y[tr], rcond=None)[0]
    keys = {r["y"]: r["p0"] for r in table.collect()}
    assert max(abs(keys[float(v)] - np.concatenate([[1], u]) @ b) for u, v in zip(x[te], y[te])) < 1e-6 and first > 0


def test_stack_scores_like_its_parts(spark):
    x, y = data(200, 2, 6)
    df, names, *_ = frame(spark, x, y)
    df = df.drop("trains", "test_fold", "row_key")
    stack = ST.fit_stack(df, names, "y", {"ols": ("linear_gram", {}), "ridge": ("ridge_gram", {"alpha": 1e6}), "knn": ("knn", {"n_neighbors": 3})}, 4)
    out = stack.transform(df).toPandas()
    assert list(out.columns) == [*df.columns, "prediction"] and len(out) == 200
    want = sum(stack.weights[n] * stack.models[n].transform(df).toPandas().sort_values("time")["prediction"].to_numpy() for n in stack.models)
    assert np.abs(out.sort_values("time")["prediction"].to_numpy() - want).max() < 1e-9
    assert stack.weights["ols"] > 0.5 and all(w >= 0 for w in stack.weights.values())
