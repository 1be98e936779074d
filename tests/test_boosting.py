"""Boosting against a plain numpy booster; whole folds in tasks against levels over blocks."""

import json

import numpy as np
import pytest

from heliopanel.operators import boosting as B, trees as T
from tests.test_trees import FEATURES, data, frame


def plain_tree(codes, g, b, depth=0):
    """A tree of (feature, code, left, right) or (leaf value,)."""
    lam = b.reg_lambda
    leaf = (-b.learning_rate * g.sum() / (len(g) + lam),)
    if depth >= b.max_depth or len(g) < b.min_samples_split:
        return leaf
    best = None
    for f in range(codes.shape[1]):
        for c in range(int(codes[:, f].max())):
            left = codes[:, f] <= c
            n = left.sum()
            if n < b.min_child_weight or len(g) - n < b.min_child_weight:
                continue
            gain = 0.5 * (g[left].sum() ** 2 / (n + lam) + g[~left].sum() ** 2 / (len(g) - n + lam) - g.sum() ** 2 / (len(g) + lam)) - b.gamma
            if gain > (1e-9 if best is None else best[0] + 1e-9):
                best = (gain, f, c)
    if best is None:
        return leaf
    _, f, c = best
    left = codes[:, f] <= c
    return (f, c, plain_tree(codes[left], g[left], b, depth + 1), plain_tree(codes[~left], g[~left], b, depth + 1))


def read(tree, codes):
    if len(tree) == 1:
        return np.full(len(codes), tree[0])
    left = codes[:, tree[0]] <= tree[1]
    out = np.zeros(len(codes))
    out[left], out[~left] = read(tree[2], codes[left]), read(tree[3], codes[~left])
    return out


def plain(codes, y, train, b, rounds):
    p = np.full(len(y), y[train].mean())
    for _ in range(rounds):
        p = p + read(plain_tree(codes[train], (p - y)[train], b), codes)
    return p


GRID = {"n_estimators": [1, 6], "learning_rate": [0.3], "max_depth": [1, 3], "gamma": [0.0, 0.5], "reg_lambda": [1.0], "min_samples_split": [2, 30]}


@pytest.mark.parametrize("local_rows", [10**6, 50])
def test_against_a_plain_booster(spark, local_rows):
    x, y = data(260, 6)
    folds = [(3 - (1 << (i % 2)), i % 2) for i in range(len(y))]
    df = frame(spark, x, y, folds).repartition(3)
    grid = GRID if local_rows > 1000 else GRID | {"n_estimators": [1, 3], "gamma": [0.5], "min_samples_split": [2]}
    edges = T.bin_edges(df, FEATURES)
    codes = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    out, places = B.boost_predictions(df, FEATURES, "y", grid, 2, local_rows=local_rows)
    got = {(r["model"], r["key"]): r["p"] for r in out.collect()}
    assert len(got) == len({m for _, m, _ in places}) * len(y)
    for params, model, place in places:
        for fold in (0, 1):
            test = np.array([f == fold for _, f in folds])
            want = plain(codes, y, ~test, B.Booster.of(params), params["n_estimators"])
            assert max(abs(got[model, i][place] - want[i]) for i in np.flatnonzero(test)) < 1e-6, params


def test_levels_equal_tasks_with_draws(spark):
    x, y = data(300, 7)
    df = frame(spark, x, y, [(1 if i % 3 else 0, None if i % 3 else 0) for i in range(len(y))]).repartition(2)
    grid = {"n_estimators": [4], "subsample": [0.7], "colsample_bytree": [0.5], "max_depth": [3]}
    one, _ = B.boost_predictions(df, FEATURES, "y", grid, 1)
    two, _ = B.boost_predictions(df, FEATURES, "y", grid, 1, local_rows=10)
    a, b = ({r["key"]: r["p"] for r in d.collect()} for d in (one, two))
    assert a.keys() == b.keys() and len(a) == 100
    assert max(abs(a[k][0] - b[k][0]) for k in a) < 1e-9


def test_grid_scores_and_shared_rounds(spark):
    x, y = data(300, 8)
    df = frame(spark, x, y, [(3 - (1 << (i % 2)), i % 2) for i in range(len(y))])
    grid = {"n_estimators": [5, 40], "learning_rate": [0.05, 0.2], "subsample": [0.8]}
    rows = B.boost_grid_scores(df, FEATURES, "y", grid, 2).collect()
    assert len(rows) == 8 and all(r["n_test"] == 150 for r in rows)
    score = {(json.loads(r["params"])["n_estimators"], json.loads(r["params"])["learning_rate"]): r["mse"] for r in rows if r["fold"] == 0}
    assert score[40, 0.2] < score[5, 0.05] < y.var() * 1.2
    alone = B.boost_grid_scores(df, FEATURES, "y", {"n_estimators": [5], "learning_rate": [0.2], "subsample": [0.8]}, 2).where("fold = 0").first()
    assert abs(alone["mse"] - score[5, 0.2]) < 1e-9


@pytest.mark.parametrize("task_rows", [10**6, 0])
def test_large_folds_in_tasks_over_code_vectors(spark, task_rows):
    x, y = data(300, 9)
    x[100:200] = x[0:100]                           # equal codes, other targets
    df = frame(spark, x, y, [(1 if i % 3 else 0, None if i % 3 else 0) for i in range(len(y))]).repartition(2)
    grid = {"n_estimators": [2, 4], "subsample": [0.7, 1.0], "max_depth": [1, 3], "colsample_bytree": [0.7], "min_child_weight": [15.0]}   # no ties of tiny nodes
    one, places = B.boost_predictions(df, FEATURES, "y", grid, 1)
    two, _ = B.boost_predictions(df, FEATURES, "y", grid, 1, local_rows=10, task_rows=task_rows)
    a, b = ({(r["model"], r["key"]): r["p"] for r in d.collect()} for d in (one, two))
    assert a.keys() == b.keys() and len(a) == 400
    assert max(np.abs(np.array(a[k]) - np.array(b[k])).max() for k in a) < 1e-9
    scores = {(r["model"], i): m for r in B.boost_predictions(df, FEATURES, "y", grid, 1, local_rows=10, task_rows=task_rows, scores=True)[0].collect()
              for i, m in enumerate(r["mse"])}
    for _, m, i in places:
        assert abs(scores[m, i] - np.mean([(p[i] - y[k]) ** 2 for (model, k), p in a.items() if model == m])) < 1e-9


def test_one_job_boosts_folds_above_the_row_limit(spark, monkeypatch):
    x, y = data(300, 9)
    df = frame(spark, x, y, [(1 if i % 3 else 0, None if i % 3 else 0) for i in range(len(y))])
    staged, plain_stage = [], B.stage
    monkeypatch.setattr(B, "stage", lambda d, name="stage": staged.append(name) or plain_stage(d, name))
    B.boost_grid_scores(df, FEATURES, "y", {"n_estimators": [5], "max_depth": [2]}, 1, local_rows=10).collect()
    assert staged == ["boosted"]                    # no margins written a round


def test_models_that_differ_in_min_samples_split_are_one_until_they_part(monkeypatch):
    x, y = data(400, 5)
    codes = np.stack([np.searchsorted(np.quantile(c, np.arange(1, 8) / 8), c) for c in x.T], axis=1).astype(np.uint8)
    rows = T.Rows(codes, y, np.arange(400), np.where(np.arange(400) % 4, 1, 0).astype(np.int32), np.where(np.arange(400) % 4, -1, 0).astype(np.int8))
    cells = T.Cells.of(rows, 0, 32)

    def run(min_leaf, *splits):
        boosters = [B.Booster.of({"max_depth": 3, "min_samples_split": m, "min_child_weight": min_leaf, "subsample": 0.8}) for m in splits]
        return B.boost_together(cells, boosters, (3, 9), 32)

    grown, plain_one = [], B._tree
    monkeypatch.setattr(B, "_tree", lambda *a: grown.append(1) or plain_one(*a))
    same = run(10.0, 2, 5)                          # no node of less than 20 rows is split
    assert len(grown) == 9 and (same[0] == same[1]).all()
    apart = run(1.0, 150, 2, 5)
    for found, m in zip(apart, (150, 2, 5)):
        alone = B.boost(rows, y, 0, B.Booster.of({"max_depth": 3, "min_samples_split": m, "min_child_weight": 1.0, "subsample": 0.8}), (3, 9), 32)
        assert np.abs(found - alone).max() < 1e-9
    assert np.abs(apart[0] - apart[1]).max() > 1e-3
