"""Positions, fills and folds by even ranges: against pandas, on one dense day with a third of the times unknown."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from heliopanel.operators import series as S
from heliopanel.operators.splits import kfold


@pytest.fixture(autouse=True)
def small_ranges(spark):
    """Ranges of small tables are not put together again."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def dense(spark, n=60_000):
    """One series in one day; a third of the times are missing, some values too."""
    at = F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.pmod(F.col("id") * 7919, F.lit(n)) * 1000)
    return spark.range(n).select("id", F.when(F.col("id") % 3 != 0, at).alias("time"),
                                 F.when(F.col("id") % 4 != 1, F.col("id").cast("double")).alias("x"))


def plain(n=60_000):
    i = np.arange(n)
    t = pd.DataFrame({"id": i, "at": np.where(i % 3 != 0, i * 7919 % n, n), "x": np.where(i % 4 != 1, i.astype(float), np.nan)})
    return t.sort_values(["at", "id"]).reset_index(drop=True)


def test_positions_and_even_ranges(spark):
    got = S.row_index(dense(spark), [], "time", "pos", ["id"], keep_bucket=True, bucket="range")
    rows = got.select("id", "pos", "_bkt").toPandas()
    want = plain()
    assert (rows.sort_values("pos")["id"].to_numpy() == want["id"].to_numpy()).all()
    assert (np.sort(rows["pos"].to_numpy()) == np.arange(len(want))).all()
    sizes = rows.groupby("_bkt").size()
    assert len(sizes) > 3 and sizes.max() <= 2 * sizes.median()


def test_equal_rows_are_divided_too(spark):
    df = spark.range(40_000).select(F.lit(1).alias("k"), F.lit(None).cast("timestamp").alias("time"))
    rows = S.row_index(df, ["k"], "time", "pos", keep_bucket=True, bucket="range").groupBy("_bkt").agg(F.count("*").alias("n")).collect()
    sizes = [r["n"] for r in rows]
    assert len(sizes) > 3 and max(sizes) <= 2 * np.median(sizes)


def test_fills_and_interpolation(spark):
    want = plain()
    ff = S.fill_forward_backward(dense(spark), ["x"], [], "time", bucket="range", tiebreak=["id"]).select("id", "x").toPandas().set_index("id")["x"]
    filled = pd.Series(want["x"].ffill().bfill().to_numpy(), index=want["id"])
    assert (ff.sort_index() == filled.sort_index()).all()
    ip = S.interpolate_linear(dense(spark), ["x"], [], "time", bucket="range", tiebreak=["id"]).select("id", "x").toPandas().set_index("id")["x"].sort_index()
    line = pd.Series(want["x"].interpolate(limit_direction="forward").to_numpy(), index=want["id"]).sort_index()
    assert (ip.isna() == line.isna()).all() and np.nanmax(np.abs(ip - line)) < 1e-6


def test_keys_do_not_mix(spark):
    rows = [(k, dt.datetime(2024, 1, 1, 0, 0, i), float(i) if i % 3 == k else None) for k in (0, 1, 2) for i in range(20)]
    rows += [(None, dt.datetime(2024, 1, 1), 5.0), (None, None, None)]
    df = spark.createDataFrame(rows, "k int, time timestamp, x double")
    got = S.fill_forward_backward(df, ["x"], ["k"], "time", bucket="range").toPandas()
    pos = S.row_index(df, ["k"], "time", "pos", bucket="range").toPandas()
    for k in (0, 1, 2):
        one = got[got.k == k].sort_values("time")["x"].to_numpy()
        want = pd.Series([float(i) if i % 3 == k else np.nan for i in range(20)]).ffill().bfill().to_numpy()
        assert (one == want).all()
        assert pos[pos.k == k].sort_values("time")["pos"].tolist() == list(range(20))
    assert got[got.k.isna()]["x"].tolist() == [5.0, 5.0]


@pytest.mark.parametrize("n,k", [(1000, 7), (13, 5), (3, 5)])
def test_folds_differ_by_one_at_most(spark, n, k):
    df = spark.range(n).select("id", (F.col("id") % 2).alias("site"))
    sizes = kfold(df, k, keys=["site"]).groupBy("site", "fold").agg(F.count("*").alias("n")).collect()
    for s in (0, 1):
        mine = [r["n"] for r in sizes if r["site"] == s]
        mine += [0] * (k - len(mine))
        assert max(mine) - min(mine) <= 1 and sum(mine) == (n + 1 - s) // 2
    again = {r["id"]: r["fold"] for r in kfold(df.repartition(3), k, keys=["site"]).collect()}
    assert again == {r["id"]: r["fold"] for r in kfold(df, k, keys=["site"]).collect()}
    if n == 1000:
        other = {r["id"]: r["fold"] for r in kfold(df, k, seed=1, keys=["site"]).collect()}
        assert other != again
