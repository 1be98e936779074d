"""The store's plans: lags without an exchange, date ranges as partition filters."""

import datetime as dt

from heliopanel.operators import series as S
from heliopanel.sources.store import read_store, save_store, store_lags


def rows(spark):
    data = [(f"s{k}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), float(k * 1000 + h)) for k in range(9) for h in range(100)]
    return spark.createDataFrame(data + [("s0", None, 1.0)], "site_id string, time timestamp_ntz, x double")


def test_lags_of_a_store_are_not_shuffled(spark, tmpdir_path):
    df = rows(spark).where("time is not null")
    table = save_store(df, f"{tmpdir_path}/s", ["site_id"], buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = store_lags(read_store(spark, table), ["x"], [1, 24], ["site_id"])
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        both = read_store(spark, table).alias("a").join(spark.table(table).alias("b"), "site_id")
        assert "Exchange hash" not in both._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = S.add_lags(df, ["x"], 24, ["site_id"]).select("site_id", "time", "x_lag_1", "x_lag_24")
    assert sorted(map(str, out.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_dates_are_partitions(spark, tmpdir_path):
    table = save_store(rows(spark), f"{tmpdir_path}/d", ["site_id"], buckets=2)
    some = read_store(spark, table, "2024-01-02", "2024-01-04")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and some.count() == 9 * 48
    assert len(some.inputFiles()) <= 2 * 2
    assert read_store(spark, table).count() == 901 and read_store(spark, table, "2025-01-01").count() == 0
