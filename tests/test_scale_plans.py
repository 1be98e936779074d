"""Blocked windows equal plain windows; plans have no single-partition windows, no Python
UDFs, pushed-down scans; leakage property of lag features."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF
from heliopanel.operators import series as S
from heliopanel.plans import fixtures as FX


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_blocked_lags_equal_plain_window(spark):
    s = FX.one_series(spark, SF)
    w = Window.orderBy("time")
    plain = s.select("time", *[F.lag("pv_production", k).over(w).alias(f"l{k}") for k in (1, 7, 24)])
    for block in (24, 50, 333):
        got = S.positional(s, lambda ww: [F.lag("pv_production", k).over(ww).alias(f"l{k}") for k in (1, 7, 24)],
                           24, [], "time", block_rows=block).select("time", "l1", "l7", "l24")
        assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0


def test_blocked_keyed_lags_equal_plain_window(spark):
    p = FX.panel(spark, SF).select("site_id", "time", "pv_production")
    w = Window.partitionBy("site_id").orderBy("time")
    plain = p.select("site_id", "time", F.lag("pv_production", 24).over(w).alias("l24"))
    got = S.positional(p, lambda ww: [F.lag("pv_production", 24).over(ww).alias("l24")], 24, ["site_id"],
                       block_rows=40).select("site_id", "time", "l24")
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0


def test_fill_and_interpolation_equal_pandas(spark):
    s = FX.one_series(spark, SF).select("time", "temp")
    pdf = s.orderBy("time").toPandas()
    ff = S.fill_forward_backward(s, ["temp"], []).orderBy("time").toPandas()["temp"]
    assert ff.equals(pdf["temp"].ffill().bfill())
    ip = S.interpolate_linear(s, ["temp"], []).orderBy("time").toPandas()["temp"]
    exp = pdf["temp"].interpolate(method="linear")
    assert ((ip - exp).abs().max() < 1e-9) and (ip.isna() == exp.isna()).all()


def _window_of_one_task(df) -> bool:
    """True if some window of the whole plan (before anything is written) has no partition key."""
    import re
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    windows = re.findall(r"^.*Window \[(.*)$", plan, re.M)
    return any(not re.search(r"windowspecdefinition\([^,()]+#\d+L?, ", w) for w in windows)


def test_no_single_partition_window_in_feature_job(spark, monkeypatch):
    monkeypatch.setattr(FX, "materialize", lambda df, *a, **k: df)
    e = FX.engineered(spark, SF)
    plan = e._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [" in plan and not _window_of_one_task(e)
    assert "Python" not in _plan(e)
    reads = e._jdf.queryExecution().sparkPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>" in reads
    # the check itself notices a window without a key
    assert _window_of_one_task(FX.panel(spark, SF).withColumn("n", F.row_number().over(Window.orderBy("time"))))


def test_scan_column_pruning_and_pushdown(spark, monkeypatch):
    monkeypatch.setattr(FX, "materialize", lambda df, *a, **k: df)
    plan = FX.panel(spark, SF).where("site_id = 'click-0'")._jdf.queryExecution().sparkPlan().toString()
    assert "event_id" not in plan
    plan = FX.requests(spark, SF).where("request_id = 7")._jdf.queryExecution().sparkPlan().toString()
    assert "EqualTo(event_id,7)" in plan and "props" not in plan


def test_layer_merge_evaluates_the_solar_layer_once(spark):
    from heliopanel.plans.queries_scoring import merge_precedence
    plan = merge_precedence(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("ASIN(") <= 2


def test_quantiles_without_exchange_reuse(spark):
    import numpy as np
    from heliopanel.operators.clean import exact_quantiles
    values = np.random.default_rng(1).permutation(400_000) * 0.0025
    df = spark.range(400_000).withColumn("x", F.pmod(F.col("id") * 179_424_673, F.lit(400_000)) * 0.0025)
    keep = spark.conf.get("spark.sql.exchange.reuse", "true")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = {r["p"]: r["quantile"] for r in exact_quantiles(df, ["x"], [0.25, 0.5, 0.75]).collect()}
    finally:
        spark.conf.set("spark.sql.exchange.reuse", keep)
    assert all(abs(got[p] - np.quantile(values, p)) < 1e-9 for p in (0.25, 0.5, 0.75)) and len(got) == 3


def test_materialised_tables_see_appended_files(spark, tmpdir_path):
    from heliopanel.session import materialize
    path = tmpdir_path + "/t"
    spark.range(3).write.parquet(path)
    assert materialize(spark.read.parquet(path), "memo_test", path).count() == 3
    assert materialize(spark.read.parquet(path), "memo_test", path).count() == 3
    spark.range(2).write.mode("append").parquet(path)
    assert materialize(spark.read.parquet(path), "memo_test", path).count() == 5


def test_quoted_column_names(spark):
    from heliopanel.operators.clean import fit_scaler, fit_zscore
    df = spark.createDataFrame([(1.0,), (3.0,)], "`it's` double")
    assert fit_zscore(df, ["it's"]).first()["column"] == "it's" and fit_scaler(df, ["it's"]).first()["center"] == 2.0


def test_lags_are_leak_free(spark):
    """Changing rows at time >= t never changes lag features of rows before t."""
    rows = [("a", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "site_id STRING, time TIMESTAMP_NTZ, pv_production DOUBLE")
    cut = dt.datetime(2024, 1, 2, 6)
    changed = df.withColumn("pv_production", F.when(F.col("time") >= F.lit(cut), F.lit(-99.0))
                            .otherwise(F.col("pv_production")))
    f1 = S.radiation_features(df, ["site_id"], n_lags=24).where(F.col("time") <= F.lit(cut))
    f2 = S.radiation_features(changed, ["site_id"], n_lags=24).where(F.col("time") <= F.lit(cut))
    cols = [c for c in f1.columns if c != "pv_production"]
    assert f1.select(cols).exceptAll(f2.select(cols)).count() == 0


def test_merge_layers_later_wins(spark):
    from heliopanel.functions.maps import merge_layers
    df = spark.createDataFrame([(1,)], "id INT").select(
        F.create_map(F.lit("a"), F.lit(1.0), F.lit("b"), F.lit(1.0), F.lit("c"), F.lit(1.0)).alias("w"),
        F.create_map(F.lit("b"), F.lit(2.0), F.lit("d"), F.lit(2.0)).alias("d"),
        F.create_map(F.lit("c"), F.lit(3.0), F.lit("d"), F.lit(3.0)).alias("h"))
    m = df.select(merge_layers(F.col("w"), F.col("d"), F.col("h")).alias("m")).first()["m"]
    assert m == {"a": 1.0, "b": 2.0, "c": 3.0, "d": 3.0}


def test_request_features_do_not_repeat_solar_maths(spark):
    from heliopanel.plans.queries_scoring import _built
    plan = _built(spark, SF).where("valid")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("DEGREES") <= 2          # sun_elevation and is_daylight, nothing re-inlined


def test_representative_plans_have_no_cartesian_or_nested_loop(spark):
    import __spark_entry__ as E
    q = E.queries()
    for name in ("naive_day_ahead", "lag_features", "ffill_bfill", "interpolate", "iqr_bounds", "target_corr",
                 "cv_summary", "metrics", "error_by_phase", "request_lags", "build_features", "knn_uniform"):
        plan = q[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in plan, (name, bad)
