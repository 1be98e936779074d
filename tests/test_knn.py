"""Exact KNN (pruned) equals brute force, also with a hot duplicated point and tiny blocks."""

import numpy as np

from heliopanel.operators.knn import knn_predict


def _brute(tr, qs, k, weights):
    out = []
    for qi, qv in enumerate(qs):
        d = np.sqrt(((tr[:, :2] - qv) ** 2).sum(1))
        order = sorted(range(len(tr)), key=lambda i: (d[i], i))[:k]
        dd, yy = d[order], tr[order, 2]
        if weights == "uniform":
            out.append(yy.mean())
        elif (dd == 0).any():
            out.append(yy[dd == 0].mean())
        else:
            out.append((yy / dd).sum() / (1 / dd).sum())
    return np.array(out)


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    n = 400
    tr = np.column_stack([rng.normal(size=n), rng.normal(size=n) * 3, rng.normal(size=n)])
    tr[:130, :2] = [0.5, 0.5]                     # a third of the rows share one point
    qs = np.vstack([rng.normal(size=(60, 2)), [[0.5, 0.5], [50.0, -40.0]]])   # incl. exact hit and far outlier
    tdf = spark.createDataFrame([(i, float(a), float(b), float(y)) for i, (a, b, y) in enumerate(tr)],
                                "id LONG, a DOUBLE, b DOUBLE, y DOUBLE")
    qdf = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(qs)], "qid LONG, a DOUBLE, b DOUBLE")
    for weights in ("uniform", "distance"):
        got = knn_predict(tdf, qdf, ["a", "b"], "y", 7, weights, ["id"], ["qid"], scale=False, rank_block=16)
        got = np.array([r.prediction for r in got.orderBy("qid").collect()])
        assert np.allclose(got, _brute(tr, qs, 7, weights), rtol=1e-12, atol=1e-12)


def test_knn_fewer_rows_than_k(spark):
    tdf = spark.createDataFrame([(1, 0.0, 1.0), (2, 1.0, 3.0)], "id LONG, a DOUBLE, y DOUBLE")
    qdf = spark.createDataFrame([(1, 0.2)], "qid LONG, a DOUBLE")
    r = knn_predict(tdf, qdf, ["a"], "y", 5, "uniform", ["id"], ["qid"], scale=False).first()
    assert r.prediction == 2.0 and r.n_neighbors == 2


def test_knn_grid_path_three_dims(spark):
    rng = np.random.default_rng(3)
    tr = rng.normal(size=(3000, 4))
    qs = np.vstack([rng.normal(size=(150, 3)), [[9.0, 9.0, 9.0]]])
    tdf = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(tr)], "id LONG, a DOUBLE, b DOUBLE, c DOUBLE, y DOUBLE")
    qdf = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(qs)], "qid LONG, a DOUBLE, b DOUBLE, c DOUBLE")
    got = knn_predict(tdf, qdf, ["a", "b", "c"], "y", 5, "distance", ["id"], ["qid"], scale=False)
    got = np.array([r.prediction for r in got.orderBy("qid").collect()])
    exp = []
    for q in qs:
        d = np.sqrt(((tr[:, :3] - q) ** 2).sum(1))
        idx = np.lexsort((np.arange(len(tr)), d))[:5]
        exp.append((tr[idx, 3] / d[idx]).sum() / (1 / d[idx]).sum())
    assert np.allclose(got, exp, rtol=1e-12, atol=1e-12)


def test_one_far_point_does_not_slow_the_join(spark):
    import time
    rng = np.random.default_rng(1)
    took = {}
    for far in (False, True, False):      # the first run only warms up
        x = rng.normal(size=(20_000, 2))
        if far:
            x[7] = [1e6, 1e6]
        tr = np.column_stack([x, x[:, 0]])
        qs = rng.normal(size=(1000, 2))
        tdf = spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(tr)], "id LONG, a DOUBLE, b DOUBLE, y DOUBLE")
        qdf = spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(qs)], "qid LONG, a DOUBLE, b DOUBLE")
        at = time.perf_counter()
        got = knn_predict(tdf, qdf, ["a", "b"], "y", 5, "uniform", ["id"], ["qid"], scale=False).orderBy("qid").collect()
        took[far] = time.perf_counter() - at
        some = list(range(0, 1000, 25))
        assert np.allclose([got[i].prediction for i in some], _brute(tr, qs[some], 5, "uniform"), rtol=1e-12, atol=1e-12)
    assert took[True] < 2 * took[False] + 5


def test_candidates_grow_with_the_queries_alone(spark, monkeypatch):
    from heliopanel.operators import neighbours as NB
    visits, staged = [], NB.stage

    def counted(df, name="stage"):
        out = staged(df, name)
        if name == "knn_visits":
            visits.append(out.count())
        return out

    monkeypatch.setattr(NB, "stage", counted)
    rng = np.random.default_rng(2)
    tr, qs = np.round(rng.normal(size=(8000, 3)), 2), np.round(rng.normal(size=(3000, 2)), 2)
    tdf = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(tr)], "id LONG, a DOUBLE, b DOUBLE, y DOUBLE")
    qdf = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(qs)] + [(5, 0.0, 0.0), (9000, None, 0.0)], "qid LONG, a DOUBLE, b DOUBLE")
    got = {r["qid"]: r for r in knn_predict(tdf, qdf, ["a", "b"], "y", 5, "uniform", ["id"], ["qid"], scale=False, rank_block=400).collect()}
    assert len(visits) == 2 and sum(visits) < 2 * 3000
    assert len(got) == 3001 and {r["n_neighbors"] for r in got.values()} == {5}
    some = [i for i in range(0, 3000, 30)]
    assert np.allclose([got[i]["prediction"] for i in some], _brute(tr, qs[some], 5, "uniform"), rtol=1e-12, atol=1e-12)
    assert abs(got[9000]["prediction"] - tr[:5, 2].mean()) < 1e-12      # without distances: the first ids


def test_rows_of_one_query_id_are_one_query(spark):
    tdf = spark.createDataFrame([(i, float(i), float(i)) for i in range(50)], "id LONG, a DOUBLE, y DOUBLE")
    qdf = spark.createDataFrame([(None, 3.0), (None, 30.0), (2, 10.0)], "qid LONG, a DOUBLE")
    got = {r["qid"]: r for r in knn_predict(tdf, qdf, ["a"], "y", 2, "uniform", ["id"], ["qid"], scale=False).collect()}
    assert len(got) == 2 and got[None]["prediction"] == 16.5 and got[2]["n_neighbors"] == 2


def test_queries_of_equal_features_ask_once(spark, monkeypatch):
    from heliopanel.operators import neighbours as NB
    visits, staged = [], NB.stage

    def counted(df, name="stage"):
        out = staged(df, name)
        if name == "knn_visits":
            visits.append(out.count())
        return out

    monkeypatch.setattr(NB, "stage", counted)
    rng = np.random.default_rng(9)
    tr = np.round(rng.normal(size=(500, 3)), 1)
    qs = np.round(rng.normal(size=(12, 2)), 1)[np.arange(600) % 12]
    rows = [(i, *map(float, r)) for i, r in enumerate(qs)] + [(3, *map(float, qs[3])), (4, *map(float, qs[9])), (700, None, 0.0), (701, None, 1.0)]
    tdf = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(tr)], "id LONG, a DOUBLE, b DOUBLE, y DOUBLE")
    qdf = spark.createDataFrame(rows, "qid LONG, a DOUBLE, b DOUBLE")
    got = {r["qid"]: r for r in knn_predict(tdf, qdf, ["a", "b"], "y", 5, "uniform", ["id"], ["qid"], scale=False).collect()}
    assert visits[0] <= 12 + 4                      # the rows of ids 3 and 4 ask for themselves
    assert len(got) == 602 and {r["n_neighbors"] for r in got.values()} == {5}
    single = [i for i in range(600) if i not in (3, 4)]
    assert np.allclose([got[i]["prediction"] for i in single], _brute(tr, qs, 5, "uniform")[single], rtol=1e-12, atol=1e-12)
    assert all(abs(got[i]["prediction"] - tr[:5, 2].mean()) < 1e-12 for i in (700, 701))
    d = [sorted((float(np.sqrt(((t[:2] - q) ** 2).sum())), i) for i, t in enumerate(tr)) for q in (qs[3], qs[4], qs[9])]
    for i, near in ((3, d[0] + d[0]), (4, d[1] + d[2])):        # both rows of an id are one query
        assert abs(got[i]["prediction"] - np.mean([tr[j, 2] for _, j in sorted(near)[:5]])) < 1e-12


def test_model_frame_writes_its_columns_alone(spark, monkeypatch):
    from heliopanel.plans import fixtures as FX
    from conftest import SF_SMALL
    written, plain = {}, FX.materialize
    monkeypatch.setattr(FX, "materialize", lambda df, name, *a, **k: written.update({name: df.columns}) or plain(df, name, *a, **k))
    got = FX.model_frame(spark, SF_SMALL)
    assert set(written) == {"panel", "model_frame"}
    assert written["model_frame"] == ["site_id", "time", *FX.MODEL_COLS, "sun_elevation_prev", "split"] == got.columns
