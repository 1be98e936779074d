"""Request scoring from text times with zones, failing models, correlations, convergence."""

import datetime as dt
import math

import numpy as np
import pytest

from heliopanel import api
from heliopanel.operators import models as M, scoring as SC, selection as SEL
from heliopanel.operators.linear import lasso_cd


def test_text_times_with_zones(spark):
    rows = [("2024-06-01T12:30:00+02:00",), ("2024-06-01 12:30:00Z",), ("2024-06-01T12:30",), ("2024-06-01 12:30:00 -0530",),
            ("2024-06-05",), ("soon",), (None,)]
    got = SC.with_local_and_utc(spark.createDataFrame(rows, "target_time string")).collect()
    half = dt.datetime(2024, 6, 1, 12, 30)
    assert [(g["_local"], g["_utc"]) for g in got] == [
        (half, half - dt.timedelta(hours=2)), (half, half), (half, half), (half, half + dt.timedelta(hours=5, minutes=30)),
        (dt.datetime(2024, 6, 5), dt.datetime(2024, 6, 5)), (None, None), (None, None)]


def test_score_requests(spark):
    names = ["hour", "sun_elevation:d", "temp", "pv_production_lag_1"]
    fitted = M.FittedModel("linear_gram", {}, names, "y", {}, M.GramLinear(1.0, [1.0, 0.0, 10.0, 100.0]))
    rows = [(1, "2024-06-21T12:00:00+02:00", 52.5, 13.4, {"lag_1": 2.0}, {"temp": 3.0}),
            (2, "2024-06-21T12:00:00", 52.5, 13.4, {"lag_1": 2.0}, {"temp": 3.0}),
            (3, "2024-06-21T12:00:00", 52.5, 13.4, {}, {"temp": 3.0}), (4, "never", 52.5, 13.4, {"lag_1": 2.0}, {"temp": 3.0})]
    df = spark.createDataFrame(rows, "request_id int, target_time string, latitude double, longitude double, "
                                     "recent_pv map<string,double>, weather_forecast map<string,double>")
    got = {r["request_id"]: r for r in api.score_requests(df, fitted).collect()}
    assert got[1]["prediction"] == got[2]["prediction"] == 1 + 12 + 30 + 200
    assert got[1]["sun_elevation:d"] < got[2]["sun_elevation:d"]       # ten o'clock UTC against noon
    assert got[3]["prediction"] is None and got[3]["missing"] == "pv_production_lag_1"
    assert not got[4]["valid"] and got[4]["prediction"] is None and "hour" in got[4]["missing"]


def test_failing_model_is_left_out_and_tail_is_held_out(spark):
    r = np.random.default_rng(1)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(hours=i), float(x), float(2 * x + r.normal())) for i, x in enumerate(r.normal(size=120))]
    df = spark.createDataFrame(rows, "time timestamp_ntz, x double, y double")
    models = {"good": ("linear_gram", {}), "bad": ("no_such_estimator", {})}
    comparison, cv, _, fitted = api.compare_models(df, None, ["x"], "y", models, 3)
    assert list(fitted) == ["good"] and [c["model"] for c in comparison.collect()] == ["good"] and cv.count() == 3
    with pytest.raises(Exception):
        api.compare_models(df, None, ["x"], "y", {"bad": ("no_such_estimator", {})}, 3)


def test_correlation_matrix_equals_numpy(spark):
    r = np.random.default_rng(2)
    x = r.normal(1e6, 3, (500, 12))
    x[:, 3] = 2 * x[:, 2] + 5
    x[:, 4] = 7.25
    rows = [tuple(float(v) if r.random() > 0.1 else None for v in row) for row in x]
    names = [f"it's {i}" for i in range(12)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names)).repartition(3)
    got = {(g["feature_a"], g["feature_b"]): g["corr"] for g in SEL.correlation_matrix(df, names).collect()}
    assert len(got) == 144
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            both = [(p[i], p[j]) for p in rows if p[i] is not None and p[j] is not None]
            u, v = np.array(both).T
            want = 1.0 if i == j else None if 4 in (i, j) else np.corrcoef(u, v)[0, 1]
            assert got[a, b] is None if want is None else math.isclose(got[a, b], want, abs_tol=1e-7), (a, b)


def test_lasso_says_when_it_does_not_settle():
    c = np.array([[1.0, 0.999], [0.999, 1.0]])
    with pytest.raises(RuntimeError):
        lasso_cd(c, np.array([1.0, 0.2]), 0.001, max_iter=3)
    assert len(lasso_cd(c, np.array([1.0, 0.2]), 0.001)) == 2


def test_lag_table_against_plain_lookup(spark):
    import datetime as dt
    import random
    from heliopanel.operators.scoring import lag_table
    rng = random.Random(3)
    hours = [dt.datetime(2024, 1, 1) + dt.timedelta(hours=h) for h in rng.sample(range(140), 90)]
    rows = [(s, t + dt.timedelta(minutes=m), float(i) if i % 7 else None) for s, m in (("a", 0), ("b", 30), (None, 0)) for i, t in enumerate(hours)]
    df = spark.createDataFrame(rows + [("a", None, 1.0)], "site string, time timestamp_ntz, y double")
    for n in (3, 24, 30):
        got = {(r[0], r[1]): tuple(r)[2:] for r in lag_table(df, n, ["site"], "y", "time").collect()}
        value = {(s, t): v for s, t, v in rows}
        times = {(s, t + dt.timedelta(hours=k)) for s, t, v in rows if v is not None for k in range(1, n + 1)}
        assert got == {(s, t): tuple(value.get((s, t - dt.timedelta(hours=k))) for k in range(1, n + 1)) for s, t in times}


def test_models_are_searched_side_by_side(spark, monkeypatch):
    import threading
    from heliopanel import api
    both, plain = threading.Barrier(2, timeout=60), api.M.grid_search_cv
    monkeypatch.setattr(api.M, "grid_search_cv", lambda *a, **k: both.wait() >= 0 and plain(*a, **k))
    import datetime as dt
    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(start + dt.timedelta(hours=i), float(i % 7), 2.0 * (i % 7) + 1) for i in range(60)], "time TIMESTAMP_NTZ, x DOUBLE, y DOUBLE")
    comparison, cv, _, fitted = api.compare_models(df, None, ["x"], "y", {"ridge": ("ridge_gram", {"alpha": [1.0]}), "linear": ("linear_gram", {})}, 3)
    assert list(fitted) == ["ridge", "linear"] and comparison.count() == 2 and cv.count() == 6
