"""Forests against a plain recursive tree, and the shared grid against sets grown one by one."""

import numpy as np
import pytest

from heliopanel.operators import trees as T
from heliopanel.operators.splits import fold_marks

FEATURES = ["a", "b c", "d"]


def data(n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 2)
    y = np.round(2 * (x[:, 0] > 0.3) + x[:, 1] * (x[:, 2] < 0) + 0.1 * rng.normal(size=n), 3)
    return x, y


def frame(spark, x, y, folds):
    """Rows; ``folds``: per row (mask of folds trained, fold tested or None)."""
    rows = [(*map(float, v), float(t), i, m, f) for i, (v, t, (m, f)) in enumerate(zip(x, y, folds))]
    return spark.createDataFrame(rows, "a double, `b c` double, d double, y double, row_key long, trains int, test_fold int")


def plain(x, y, codes, depth, max_depth, min_split, min_leaf):
    """A tree as nested tuples: (mean, feature, code, left, right) or (mean,)."""
    mean = y.mean()
    if depth >= max_depth or len(y) < max(min_split, 2 * min_leaf) or np.ptp(y) == 0:
        return (mean,)
    best = None
    for f in range(codes.shape[1]):
        for b in range(int(codes[:, f].max())):
            left = codes[:, f] <= b
            if min(left.sum(), (~left).sum()) < min_leaf:
                continue
            gain = y[left].sum() ** 2 / left.sum() + y[~left].sum() ** 2 / (~left).sum() - y.sum() ** 2 / len(y)
            if gain > (1e-9 if best is None else best[0] + 1e-9):
                best = (gain, f, b)
    if best is None:
        return (mean,)
    _, f, b = best
    left = codes[:, f] <= b
    args = (depth + 1, max_depth, min_split, min_leaf)
    return (mean, f, b, plain(x[left], y[left], codes[left], *args), plain(x[~left], y[~left], codes[~left], *args))


def read(tree, code):
    while len(tree) > 1:
        tree = tree[3] if code[tree[1]] <= tree[2] else tree[4]
    return tree[0]


def table(df, column):
    return {(r["fold"], r["key"]): r[column] for r in df.collect()}


@pytest.mark.parametrize("local_rows", [10**6, 60])
def test_one_tree_equals_the_plain_tree(spark, local_rows):
    x, y = data()
    folds = [(1 if i % 4 else 0, None if i % 4 else 0) for i in range(len(y))]
    df = frame(spark, x, y, folds)
    grid = {"n_estimators": [1], "max_depth": [2, 6], "min_samples_split": [2, 12], "min_samples_leaf": [1, 4]}
    out, sets, _ = T.forest_predictions(df.repartition(3), FEATURES, "y", grid, 1, bootstrap=False, local_rows=local_rows)
    out = out.collect()
    edges = T.bin_edges(df, FEATURES)
    codes = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    train = np.array([m == 1 for m, _ in folds])
    assert len(sets) == 8
    for params, place in sets:
        family, column = place.split(":")
        tree = plain(x[train], y[train], codes[train], 0, params["max_depth"], params["min_samples_split"], params["min_samples_leaf"])
        got = {r["key"]: r[column] for r in out if r["family"] == int(family)}
        assert sorted(got) == np.flatnonzero(~train).tolist()
        assert max(abs(got[i] - read(tree, codes[i])) for i in got) < 1e-6


def test_large_nodes_by_levels_equal_small_ones_in_tasks(spark):
    x, y = data(600, 2)
    folds = [(7 - (1 << (i % 3)), i % 3) for i in range(len(y))]
    df = frame(spark, x, y, folds).repartition(4)
    grid = {"n_estimators": [2, 5], "max_depth": [3, 7], "min_samples_split": [2, 9], "max_features": [0.7, 1.0]}
    one, sets, _ = T.forest_predictions(df, FEATURES, "y", grid, 3)
    two, _, _ = T.forest_predictions(df, FEATURES, "y", grid, 3, local_rows=40)
    a, b = ({(r["family"], r["fold"], r["key"]): list(r)[4:] for r in d.collect()} for d in (one, two))
    assert a.keys() == b.keys() and len(a) == 2 * 600
    assert max(np.abs(np.array(a[k]) - np.array(b[k])).max() for k in a) < 1e-9


def test_sets_read_off_equal_sets_grown_alone(spark):
    x, y = data(300, 3)
    df = frame(spark, x, y, [(3 - (1 << (i % 2)), i % 2) for i in range(len(y))])
    grid = {"n_estimators": [3, 30], "max_depth": [2, 5], "min_samples_split": [2, 10], "min_samples_leaf": [1, 3], "max_features": [0.4]}
    scores = {r["params"]: r for r in T.forest_grid_scores(df, FEATURES, "y", grid, 2).collect() if r["fold"] == 1}
    assert len(scores) == 16
    for n, d, s, m in ((3, 5, 10, 1), (30, 2, 2, 3), (30, 5, 2, 1)):
        alone = T.forest_grid_scores(df, FEATURES, "y", {"n_estimators": [n], "max_depth": [d], "min_samples_split": [s],
                                                         "min_samples_leaf": [m], "max_features": [0.4]}, 2).where("fold = 1").first()
        assert abs(scores[alone["params"]]["mse"] - alone["mse"]) < 1e-9 and alone["n_test"] == 150


def test_bootstrap_and_feature_draws():
    key = np.arange(20000, dtype=np.int64)
    w = T.weights(key, 5, True)
    assert abs(w.mean() - 1) < 0.03 and abs((w == 0).mean() - np.exp(-1)) < 0.02
    assert (T.weights(key[::-1], 5, True)[::-1] == w).all() and (T.weights(key, 6, True) != w).any()
    flags = T.features_of(7, np.arange(1, 500), 6, 3)
    assert (flags.sum(axis=1) == 3).all() and abs(flags.mean(axis=0) - 0.5).max() < 0.1


def test_nulls_and_empty_folds(spark):
    x, y = data(60, 4)
    df = frame(spark, x, y, [(1, 0 if i % 5 == 0 else None) if i % 5 else (0, 0) for i in range(60)])
    df = df.selectExpr("*", "1 as fold").selectExpr("*", "2 as part").withColumn("a", __import__("pyspark").sql.functions.expr("CASE WHEN row_key = 5 THEN NULL ELSE a END"))
    out, _, _ = T.forest_predictions(df, FEATURES, "y", {"n_estimators": [4], "max_depth": [3]}, 2)
    got = out.collect()
    assert {r["key"] for r in got} == {i for i in range(0, 60, 5)} - {5} and {r["fold"] for r in got} == {0}


@pytest.mark.parametrize("strategy", ["timeseries", "kfold"])
def test_fold_marks(spark, strategy):
    df = spark.range(100).selectExpr("id", "timestamp'2024-01-01' + make_interval(0,0,0,0,cast(id as int)) as time")
    rows = fold_marks(df, 4, strategy).collect()
    for f in range(4):
        test = {r["id"] for r in rows if r["test_fold"] == f}
        train = {r["id"] for r in rows if r["trains"] >> f & 1}
        assert not test & train
        if strategy == "kfold":
            assert len(test) == 25 and len(train) == 75
        else:
            assert test == set(range(20 + 20 * f, 40 + 20 * f)) and train == set(range(20 + 20 * f))


def test_a_grid_writes_no_predictions_and_sends_a_fold_once_a_family(spark, monkeypatch):
    x, y = data(300, 3)
    x[100:200] = x[0:100]                           # equal codes, other targets
    df = frame(spark, x, y, [(3 - (1 << (i % 2)), i % 2) for i in range(len(y))])
    grid = {"n_estimators": [3, 30], "max_depth": [2, 5], "min_samples_split": [2, 10], "min_samples_leaf": [1, 3]}
    staged, plain_stage = [], T.stage
    monkeypatch.setattr(T, "stage", lambda d, name="stage": staged.append((name, plain_stage(d, name))) or staged[-1][1])
    scores = {(r["params"], r["fold"]): r["mse"] for r in T.forest_grid_scores(df, FEATURES, "y", grid, 2).collect()}
    assert [name for name, _ in staged] == ["tree_blocks", "tree_errors"] and staged[1][1].count() == 4
    out, sets, _ = T.forest_predictions(df, FEATURES, "y", grid, 2, local_rows=40)
    rows = out.collect()
    for params, place in sets:
        family, column = place.split(":")
        for fold in (0, 1):
            want = np.mean([(r[column] - r["y"]) ** 2 for r in rows if r["family"] == int(family) and r["fold"] == fold])
            assert abs(scores[__import__("json").dumps(params, sort_keys=True), fold] - want) < 1e-9


def test_sums_over_features_together_are_those_of_each():
    rng = np.random.default_rng(2)
    x, node, v = rng.integers(0, 32, (500, 5)).astype(np.uint8), rng.integers(0, 3, 500), rng.integers(-9, 9, 500) + 1j * rng.integers(0, 5, 500)
    codes = T.Codes(x, 32)
    for nodes in (3, 3 + T.JOINT_CELLS // 32 ** 2):     # pairs, then features alone; three nodes have rows
        sums = codes.empty(nodes)
        codes.add(sums, 0, 200, node[:200], v)
        codes.add(sums, 200, 500, node[200:], v)
        hist = codes.histograms(sums, 3)
        assert len(sums[1]) == (3 if nodes == 3 else 5)
        for f in range(5):
            want = np.zeros((3, 32), complex)
            np.add.at(want, (node, x[:, f]), v)
            assert (hist[f] == want).all()


def test_trees_of_few_families_are_dealt_over_the_cores(spark, monkeypatch):
    x, y = data(300, 3)
    df = frame(spark, x, y, [(3 - (1 << (i % 2)), i % 2) for i in range(len(y))])
    grid = {"n_estimators": [3, 30], "max_depth": [2, 5], "min_samples_split": [2, 10]}
    whole = {(r["params"], r["fold"]): (r["mse"], r["n_test"]) for r in T.forest_grid_scores(df, FEATURES, "y", grid, 2).collect()}
    staged, dealt, plain_stage, plain_units = [], [], T.stage, T._units
    monkeypatch.setattr(T, "stage", lambda d, name="stage": staged.append(name) or plain_stage(d, name))
    monkeypatch.setattr(T, "_units", lambda b, t, groups, *a: dealt.append(groups) or plain_units(b, t, groups, *a))
    monkeypatch.setattr(T, "SPLIT_ROWS", 10)
    monkeypatch.setattr(T, "PIECE", 40)             # several pieces a fold
    found = {(r["params"], r["fold"]): (r["mse"], r["n_test"]) for r in T.forest_grid_scores(df, FEATURES, "y", grid, 2).collect()}
    assert dealt == [[(0, 3), (3, 18), (18, 30)]] and staged == ["tree_blocks", "tree_errors"]
    assert found.keys() == whole.keys() and all(abs(found[k][0] - whole[k][0]) < 1e-9 and found[k][1] == whole[k][1] for k in whole)
