"""Hand-computed frames (FIXTURES.md §3)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from heliopanel.functions.calendar import calendar_columns, is_daylight
from heliopanel.functions.stats import student_t_cdf
from heliopanel.operators import clean as C, evaluate as EV, panel as P, selection as SEL, series as S
from heliopanel.operators.splits import fold_pairs, kfold, tail_split, ts_folds


def _series(spark, values, key="a", start=dt.datetime(2024, 1, 1)):
    rows = [(key, start + dt.timedelta(hours=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "site_id STRING, time TIMESTAMP_NTZ, x DOUBLE")


def _col(df, c="x", order="time"):
    return [r[c] for r in df.orderBy(order).collect()]


def test_interpolate_and_fill(spark):
    df = _series(spark, [None, 1.0, None, None, 4.0, None])
    assert _col(S.interpolate_linear(df, ["x"], ["site_id"])) == [None, 1.0, 2.0, 3.0, 4.0, 4.0]
    assert _col(S.fill_forward_backward(df, ["x"], ["site_id"])) == [1.0, 1.0, 1.0, 1.0, 4.0, 4.0]
    assert _col(S.fill_forward_backward(df, ["x"], ["site_id"], backward=False)) == [None, 1.0, 1.0, 1.0, 4.0, 4.0]


def test_fill_across_days_and_unkeyed(spark):
    vals = [None] * 30 + [5.0] + [None] * 40 + [7.0] + [None] * 3
    df = _series(spark, vals)
    got = _col(S.fill_forward_backward(df.drop("site_id"), ["x"], []))
    assert got == [5.0] * 71 + [7.0] * 4
    got = _col(S.interpolate_linear(df.drop("site_id"), ["x"], []))
    assert got[30] == 5.0 and got[71] == 7.0 and abs(got[50] - (5.0 + 2.0 * 20 / 41)) < 1e-12
    assert got[:30] == [None] * 30 and got[72:] == [7.0] * 3


def test_iqr_bounds_and_clip(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (4.0,), (10.0,), (50.0,)], "x DOUBLE")
    b = {r["column"]: r for r in C.fit_iqr_bounds(df, ["x"]).collect()}["x"]
    assert (b["q1"], b["q3"], b["lower"], b["upper"]) == (2.0, 10.0, -10.0, 22.0)
    clipped = sorted(C.apply_clip(df, C.fit_iqr_bounds(df, ["x"])).collect(), key=lambda r: (r.x is not None, r.x))
    assert [r.x for r in clipped] == [None, 1.0, 2.0, 4.0, 10.0, 22.0]


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.normal(size=997), np.zeros(500)])   # a hot value holding a third
    df = spark.createDataFrame([(float(v), float(v) * 2) for v in vals], "a DOUBLE, b DOUBLE")
    got = {(r["column"], r["p"]): r["quantile"] for r in C.exact_quantiles(df, ["a", "b"], [0.1, 0.25, 0.5, 0.9]).collect()}
    for p in (0.1, 0.25, 0.5, 0.9):
        assert abs(got[("a", p)] - np.quantile(vals, p)) < 1e-12
        assert abs(got[("b", p)] - np.quantile(vals * 2, p)) < 1e-12


def test_constant_column(spark):
    df = spark.createDataFrame([(float(i), 3.0, float(i) * 2) for i in range(10)], "x DOUBLE, c DOUBLE, y DOUBLE")
    params = SEL.SelectorParams(target="y", threshold=0.0)
    corr = {r["feature"]: r["correlation"] for r in SEL.target_correlation(df, params).collect()}
    assert "c" not in corr and abs(corr["x"] - 1.0) < 1e-12
    st = C.fit_scaler(df, ["c", "x"], "standard")
    assert [r.c for r in C.apply_scaler(df, st).collect()] == [0.0] * 10
    m = df.agg(SEL.pearson(F.col("c"), F.col("y")).alias("r")).first()["r"]
    assert m is None


def test_daylight(spark):
    df = spark.createDataFrame([(None,), (1.9,), (2.0,)], "e DOUBLE")
    assert [r.d for r in df.select(is_daylight("e").alias("d")).collect()] == [0, 0, 1]


def test_lags_never_cross_sites(spark):
    a = _series(spark, [1.0, 2.0, 3.0], "a")
    b = _series(spark, [10.0, 20.0, 30.0], "b")
    out = S.add_lags(a.unionByName(b), ["x"], 2, ["site_id"])
    rows = {(r.site_id, r.x): (r.x_lag_1, r.x_lag_2) for r in out.collect()}
    assert rows[("a", 1.0)] == (None, None) and rows[("b", 10.0)] == (None, None)
    assert rows[("b", 30.0)] == (20.0, 10.0) and rows[("a", 3.0)] == (2.0, 1.0)


def test_duplicate_timestamps_count_as_complete(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [("a", base + dt.timedelta(hours=min(i, 22)), 1.0) for i in range(24)]       # 24 rows, 23 hours
    rows += [("a", dt.datetime(2024, 1, 2) + dt.timedelta(hours=i), 1.0) for i in range(5)]
    df = spark.createDataFrame(rows, "site_id STRING, time TIMESTAMP_NTZ, x DOUBLE")
    assert P.complete_days(df, ["site_id"]).count() == 24
    none = spark.createDataFrame(rows[24:], "site_id STRING, time TIMESTAMP_NTZ, x DOUBLE")
    assert P.complete_days(none, ["site_id"]).count() == 5          # no complete day: keep all


def test_mape_null_when_all_zero(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 2.0)], "y DOUBLE, p DOUBLE")
    m = EV.regression_metrics(df, "y", "p").first()
    assert m["mape"] is None and abs(m["rmse"] - math.sqrt(2.5)) < 1e-12 and m["r2"] == 0.0


def test_equal_fold_scores_give_null_p(spark):
    cv = spark.createDataFrame([(m, f, 1.0 + f) for m in ("a", "b") for f in range(5)], "model STRING, fold INT, rmse DOUBLE")
    t = EV.paired_ttest(cv).collect()
    assert all(r["p_value"] is None and r["t_stat"] is None for r in t)


def test_t_cdf_against_reference_values(spark):
    from math import atan, pi, sqrt
    # exact: nu=1 Cauchy; nu=2 closed form
    rows = spark.createDataFrame([(1.5, 1), (-0.7, 2), (2.1, 4), (0.3, 5), (-1.2, 9)], "t DOUBLE, nu INT")
    got = [r.p for r in rows.select(student_t_cdf(F.col("t"), F.col("nu")).alias("p")).collect()]
    assert abs(got[0] - (0.5 + atan(1.5) / pi)) < 1e-14
    assert abs(got[1] - (0.5 + -0.7 / (2 * sqrt(2 + 0.49)))) < 1e-14
    import numpy as np
    from math import gamma

    def cdf(t, nu):   # numeric integration of the density from 0 to t, plus 1/2
        x = np.linspace(0.0, t, 200001)
        pdf = gamma((nu + 1) / 2) / (sqrt(nu * pi) * gamma(nu / 2)) * (1 + x * x / nu) ** (-(nu + 1) / 2)
        return 0.5 + float(np.trapezoid(pdf, x))
    for (t, nu), p in zip([(2.1, 4), (0.3, 5), (-1.2, 9)], got[2:]):
        assert abs(p - cdf(t, nu)) < 1e-9


def test_pv_change(spark):
    df = _series(spark, [39.0, 42.0, 0.0]).withColumnRenamed("x", "pv_production")
    out = S.radiation_features(df, ["site_id"])
    assert _col(out, "pv_change_1h") == [None, None, 4.0]


def test_calendar(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5),), (dt.datetime(2024, 12, 31, 23),)], "time TIMESTAMP_NTZ")
    rows = df.select(*calendar_columns("time")).collect()
    assert (rows[0].day_of_week, rows[0].hour, rows[0].day_of_year) == (0, 5, 1)
    assert rows[1].day_of_year == 366


def test_time_series_folds(spark):
    df = _series(spark, [float(i) for i in range(12)])
    f = ts_folds(df, 5, ["site_id"]).orderBy("time").collect()
    starts = sorted({r.row_idx for r in f if r.test_fold is not None and (r.row_idx - 2) % 2 == 0})
    assert starts == [2, 4, 6, 8, 10] and [r.test_fold for r in f][:2] == [None, None]
    pairs = fold_pairs(ts_folds(df, 5, ["site_id"]), 5)
    tr = {r.fold: r.n for r in pairs.where("role = 'train'").groupBy("fold").agg(F.count("*").alias("n")).collect()}
    assert tr == {0: 2, 1: 4, 2: 6, 3: 8, 4: 10}


def test_tail_split_and_kfold(spark):
    df = _series(spark, [float(i) for i in range(10)])
    sp = tail_split(df, 0.2, ["site_id"]).orderBy("time").collect()
    assert [r.split for r in sp] == ["train"] * 8 + ["test"] * 2
    k = kfold(df, 3, 42, ["site_id"], ["time"])
    sizes = sorted(r["count"] for r in k.groupBy("fold").count().collect())
    assert sizes == [3, 3, 4]


def test_unknown_strategy_raises(spark):
    with pytest.raises(ValueError):
        S.handle_missing(_series(spark, [1.0]), "median")


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x DOUBLE, k INT")
    out = P.nans_to_nulls(df).orderBy("k").collect()
    assert out[0].x is None and out[1].x == 2.0 and out[0].k == 1


def test_time_mode_lags_respect_gaps(spark):
    rows = [("a", dt.datetime(2024, 1, 1, h), float(h)) for h in (0, 1, 3)] + [("a", dt.datetime(2024, 1, 2, 1), 25.0)]
    df = spark.createDataFrame(rows, "site_id STRING, time TIMESTAMP_NTZ, x DOUBLE")
    t = S.add_lags(df, ["x"], 24, ["site_id"], mode="time").orderBy("time").collect()
    assert [r.x_lag_1 for r in t] == [None, 0.0, None, None]
    assert t[3].x_lag_24 == 1.0 and t[2].x_lag_2 == 1.0
    r = S.add_lags(df, ["x"], 1, ["site_id"]).orderBy("time").collect()
    assert [x.x_lag_1 for x in r] == [None, 0.0, 1.0, 3.0]


def test_history_only_report(spark):
    cols = "site_id STRING, time TIMESTAMP_NTZ, pv_production DOUBLE, `global_rad:W` DOUBLE, pv_production_lag_1 DOUBLE, hour INT, pv_change_1h DOUBLE"
    df = spark.createDataFrame([], cols)
    out, rep = P.apply_availability(df, "history_only", keys=["site_id"])
    assert rep["removed_columns"] == ["global_rad:W"] and "pv_production" in rep["kept_columns"]
    r = P.availability_report(spark, rep).first()
    assert r["mode"] == "history_only" and r["removed_columns"] == ["global_rad:W"]
    import pytest
    with pytest.raises(ValueError):
        P.apply_availability(df, "oracle_mode")


def test_rounding_of_large_values(spark):
    from heliopanel.functions.numeric import r6
    df = spark.createDataFrame([(1.23456789,), (-0.0000004,), (5e15,), (-1e300,), (None,)], "x double")
    assert [r[0] for r in df.select(r6("x")).collect()] == [1.234568, 0.0, 5e15, -1e300, None]
