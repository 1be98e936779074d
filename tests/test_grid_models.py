"""Linear grids from moments and neighbour lists against plain numpy over every fold."""

import json

import numpy as np
import pytest

from heliopanel.operators import moments as MO, neighbours as NB
from heliopanel.operators.splits import fold_marks

NAMES = [f"x {j}" for j in range(8)]


def data(n=240, p=8, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, p)) * 10.0 ** rng.integers(-1, 3, p) + 50, 3)
    y = np.round(x @ rng.normal(size=p) + rng.normal(size=n), 3)
    return x, y


def frame(spark, x, y, strategy="timeseries"):
    names = NAMES[:x.shape[1]]
    schema = ", ".join(f"`{c}` double" for c in names) + ", y double, row_key long, time timestamp"
    import datetime as dt
    rows = [(*map(float, v), float(t), i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)) for i, (v, t) in enumerate(zip(x, y))]
    df = fold_marks(spark.createDataFrame(rows, schema).repartition(3), 4, strategy)
    marks = {r["row_key"]: (r["trains"], r["test_fold"]) for r in df.select("row_key", "trains", "test_fold").collect()}
    return df, names, np.array([marks[i][0] for i in range(len(y))]), np.array([-1 if marks[i][1] is None else marks[i][1] for i in range(len(y))])


def scaled(x, train):
    sd = x[train].std(axis=0)
    return (x - x[train].mean(axis=0)) / np.where(sd == 0, 1, sd)


@pytest.mark.parametrize("strategy", ["timeseries", "kfold"])
def test_linear_grids_equal_fits_of_every_fold(spark, strategy):
    x, y = data()
    df, names, trains, test = frame(spark, x, y, strategy)
    segments = MO.segment_moments(df, names, "y")
    assert len(segments) == (5 if strategy == "timeseries" else 4)
    for kind, alphas in (("linear", [0.0]), ("ridge", [0.1, 10.0]), ("lasso", [0.01, 1.0])):
        got = {(g, f): (m, n) for g, _, f, m, n in MO.linear_grid(segments, 4, kind, alphas)}
        assert len(got) == 4 * len(alphas)
        for f in range(4):
            tr, te = trains >> f & 1 == 1, test == f
            z = scaled(x, tr)
            yc = y[tr] - y[tr].mean()
            for g, a in enumerate(alphas):
                if kind == "lasso":
                    w = np.zeros(8)
                    for _ in range(5000):
                        for j in range(8):
                            rest = yc - z[tr] @ w + z[tr][:, j] * w[j]
                            rho = z[tr][:, j] @ rest / tr.sum()
                            w[j] = np.sign(rho) * max(abs(rho) - a, 0)
                else:
                    w = np.linalg.solve(z[tr].T @ z[tr] + a * np.eye(8), z[tr].T @ yc)
                want = np.mean((y[te] - y[tr].mean() - z[te] @ w) ** 2)
                assert got[g, f][1] == te.sum()
                assert abs(got[g, f][0] - want) < 1e-6 * max(want, 1), (kind, a, f)


def test_one_scan_without_copied_rows(spark):
    x, y = data(60)
    df, names, *_ = frame(spark, x, y)
    m = MO.segment_moments(df.where("false"), names, "y")
    assert m == {}


def test_elimination_order_equals_refitting():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 6))
    x[:, 4] = 7.0                                   # no spread
    y = x @ np.array([3, 0.2, -1.5, 0.7, 0, 0.05]) + 0.1 * rng.normal(size=300)
    a = np.column_stack([x, y])
    m = MO.Moments(300.0, a.sum(axis=0), a.T @ a, np.zeros(7))
    left, order = [0, 1, 2, 3, 5], [4]
    z = (x - x.mean(axis=0)) / np.where(x.std(axis=0) == 0, 1, x.std(axis=0))
    while len(left) > 2:
        w = np.linalg.lstsq(z[:, left], y - y.mean(), rcond=None)[0]
        order.append(left.pop(int(np.abs(w).argmin())))
    got = MO.recursive_elimination(m, list("abcdef"), 2)
    assert [f for f, r, s in sorted(got, key=lambda t: -t[1]) if not s] == ["abcdef"[i] for i in order]
    assert {f for f, _, s in got if s} == {"abcdef"[i] for i in left}
    assert sum(s for *_, s in MO.recursive_elimination(m, list("abcdef"), 0.8)) == 4


GRID = {"n_neighbors": [3, 5, 7, 10], "weights": ["uniform", "distance"]}


def plain_knn(x, y, trains, test, folds, k, weights):
    out = {}
    for f in range(folds):
        tr = np.flatnonzero(trains >> f & 1 == 1)
        te = np.flatnonzero(test == f)
        sd = x[tr].std(axis=0)
        sd = np.where(sd == 0, 1, sd)
        errors = []
        for i in te:
            d = np.sqrt((((x[tr] - x[i]) / sd) ** 2).sum(axis=1))
            o = np.lexsort((tr, d))[:k]
            v, dd = y[tr[o]], d[o]
            if weights == "uniform":
                p = v.mean()
            else:
                p = v[dd == 0].mean() if (dd == 0).any() else (v / dd).sum() / (1 / dd).sum()
            errors.append((p - y[i]) ** 2)
        out[f] = (np.mean(errors), len(te))
    return out


@pytest.mark.parametrize("strategy,sizes", [("timeseries", {}), ("kfold", {"pivots": 6, "part_rows": 17, "query_rows": 13}),
                                            ("timeseries", {"pivots": 3, "part_rows": 1000, "query_rows": 1000})])
def test_all_neighbour_sets_from_one_search(spark, strategy, sizes):
    x, y = data(260, 8, 3)
    x[40:120] = x[40]                               # a third of the rows are equal
    df, names, trains, test = frame(spark, x, y, strategy)
    got = {(r["params"], r["fold"]): (r["mse"], r["n_test"]) for r in NB.knn_grid_scores(df, names, "y", GRID, 4, **sizes).collect()}
    assert len(got) == 8 * 4
    for k in GRID["n_neighbors"]:
        for w in GRID["weights"]:
            for f, (want, n) in plain_knn(x, y, trains, test, 4, k, w).items():
                mse, count = got[json.dumps({"n_neighbors": k, "weights": w}, sort_keys=True), f]
                assert count == n and abs(mse - want) < 1e-9 * max(1, want), (k, w, f)


def test_fewer_rows_than_neighbours_and_none(spark):
    x, y = data(12, 2, 5)
    df, names, trains, test = frame(spark, x, y)
    lists = NB.neighbour_lists(df, names, "y", 10, 4).collect()
    for f in range(4):
        for q in np.flatnonzero(test == f):
            assert sum(r["fold"] == f and r["query"] == q for r in lists) == min(10, int((trains >> f & 1).sum()))
    assert NB.neighbour_lists(df.where("false"), names, "y", 3, 4).count() == 0


def test_a_cell_is_searched_without_all_distances(monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(20_000, 3))
    x[:200] = x[0]
    key, ask = rng.permutation(len(x)), np.vstack([rng.normal(size=(300, 3)), x[:1], [[50.0, 0, 0]]])
    done, plain = [], NB.distances
    monkeypatch.setattr(NB, "distances", lambda a, b: done.append(len(a) * len(b)) or plain(a, b))
    q, r, d = NB.nearest(x, key, ask, np.full(len(ask), np.inf), 10)
    assert sum(done) < 0.2 * len(ask) * len(x)
    for i in range(len(ask)):
        dist = plain(ask[i:i + 1], x)[0]
        assert r[q == i].tolist() == np.lexsort((key, dist))[:10].tolist() and (d[q == i] == dist[r[q == i]]).all()


def test_visits_of_a_query_do_not_grow_with_the_rows(spark, monkeypatch):
    visits, staged = [], NB.stage

    def counted(df, name="stage"):
        out = staged(df, name)
        if name == "knn_visits":
            visits.append(out.count())
        return out

    monkeypatch.setattr(NB, "stage", counted)
    for n in (3000, 12_000):                        # 6 and 24 cells
        x, y = data(n, 3, 6)
        df, names, trains, test = frame(spark, x, y)
        lists = NB.neighbour_lists(df, names, "y", 5, 4, part_rows=500)
        assert lists.count() == 5 * (test >= 0).sum()
    assert visits[0] + visits[1] < 4 * 2400 and (visits[2] + visits[3]) / 9600 < 1.3 * (visits[0] + visits[1]) / 2400


def test_equal_queries_of_a_fold_ask_once(spark, monkeypatch):
    visits, staged = [], NB.stage

    def counted(df, name="stage"):
        out = staged(df, name)
        if name == "knn_visits":
            visits.append(out.count())
        return out

    monkeypatch.setattr(NB, "stage", counted)
    x, y = data(240, 3, 7)
    x = x[np.arange(240) % 10]
    df, names, trains, test = frame(spark, x, y)
    got = {(r["params"], r["fold"]): (r["mse"], r["n_test"]) for r in NB.knn_grid_scores(df, names, "y", GRID, 4).collect()}
    assert visits[0] <= 4 * 10
    for k in GRID["n_neighbors"]:
        for f, (want, n) in plain_knn(x, y, trains, test, 4, k, "uniform").items():
            mse, count = got[json.dumps({"n_neighbors": k, "weights": "uniform"}, sort_keys=True), f]
            assert count == n and abs(mse - want) < 1e-9 * max(1, want)
    lists = NB.neighbour_lists(df, names, "y", 5, 4).groupBy("query").count().collect()
    assert {r["query"]: r["count"] for r in lists} == {int(q): min(5, int((trains >> test[q] & 1).sum())) for q in np.flatnonzero(test >= 0)}
