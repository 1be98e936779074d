"""Stand-in inputs derived by Spark from the driver's tables (FIXTURES.md §2).

Each builder has a twin SQL fragment in ``fixture_sql`` so the DuckDB oracle starts
from the same rows.  All builders are lazy DataFrames whose work grows with the tables.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.tables import read_table

TRAIN_END = "2024-01-24 00:00:00"   # `splits`: train rows are strictly before this hour
REQUEST_LAT = 52.52                 # request location (README example)
REQUEST_LON = 13.41


def _hour(col: str) -> F.Column:
    return F.date_trunc("hour", F.col(col)).cast("timestamp_ntz")


def _money(col: str) -> F.Column:
    # Sum money-like doubles as DECIMAL so the total does not depend on summation order.
    return F.col(col).cast("decimal(18,2)")


USERS_PER_SITE = 150                # users that share a site, so that sites grow with the users


def site() -> F.Column:
    """Site of an event: its type and its block of users."""
    return F.expr(f"event_type || '-' || (user_id div {USERS_PER_SITE})")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites (event type x block of users) x hours.  Partial aggregation happens before the shuffle."""
    ev = read_table(spark, sf_dir, "events")
    agg = (ev.groupBy(site().alias("site_id"), _hour("ts").alias("time"))
             .agg(F.sum(_money("value")).cast("double").alias("pv_production"),
                  F.count(F.lit(1)).alias("_n"),
                  F.max("value").alias("clear_sky_rad:W"),
                  F.min(F.get_json_object("props", "$.k").cast("double")).alias("_kmin")))
    h = F.hour("time")
    out = agg.select(
        "site_id", "time", "pv_production",
        (F.col("pv_production") / F.col("_n").cast("double")).alias("global_rad:W"),
        "clear_sky_rad:W",
        (F.lit(60.0) * F.sin(F.lit(math.pi) * (h.cast("double") - 6.0) / 12.0)).alias("sun_elevation:d"),
        F.when(h % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("_kmin") - 50.0).alias("temp"),
    )
    # aggregated once from the raw events, then re-read by every branch of later plans
    return materialize(out, "panel", sf_dir, cluster_by=("site_id", "time"))


def one_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sites summed: one long series (time, pv_production, temp)."""
    ev = read_table(spark, sf_dir, "events")
    agg = (ev.groupBy(_hour("ts").alias("time"))
             .agg(F.sum(_money("value")).cast("double").alias("pv_production"),
                  F.min(F.get_json_object("props", "$.k").cast("double")).alias("_kmin")))
    out = agg.select("time", "pv_production",
                     F.when(F.hour("time") % 7 == 0, F.lit(None).cast("double"))
                      .otherwise(F.col("_kmin") - 50.0).alias("temp"))
    return materialize(out, "one_series", sf_dir)


def line_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as a regression table: target l_extendedprice, four features + a constant."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate",
        "l_quantity", "l_discount", "l_tax",
        F.col("l_linenumber").cast("double").alias("line_no"),
        F.lit(1.0).alias("const_one"),
        "l_extendedprice",
    )


def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    out = (o.groupBy(F.col("o_orderpriority").alias("site_id"),
                     F.date_trunc("day", "o_orderdate").cast("timestamp_ntz").alias("time"))
            .agg(F.sum(_money("o_totalprice")).cast("double").alias("pv_production")))
    return materialize(out, "daily_orders", sf_dir)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("request_id"), site().alias("site_id"),
        (_hour("ts") + F.expr("INTERVAL 1 HOUR")).alias("target_time"),
        F.lit(REQUEST_LAT).alias("latitude"),
        F.lit(REQUEST_LON).alias("longitude"),
    )


def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider-style hourly forecast (eight raw fields), derived from the panel."""
    p = panel(spark, sf_dir)
    g = (p.groupBy("time")
          .agg(F.avg("temp").alias("_t"), F.max("clear_sky_rad:W").alias("_mx"),
               F.sum("pv_production").alias("_pv"), F.count(F.lit(1)).alias("_n")))
    out = g.select(
        F.col("time").alias("hour"),
        F.col("_t").alias("temperature_2m"),
        (F.lit(40.0) + F.col("_n").cast("double") * 10.0).alias("relative_humidity_2m"),
        (F.hour("time").cast("double") * 4.0).alias("cloud_cover"),
        F.col("_mx").alias("shortwave_radiation"),
        (F.col("_mx") * 0.5).alias("direct_radiation"),
        (F.col("_mx") * 0.25).alias("diffuse_radiation"),
        F.when(F.hour("time") % 5 == 0, F.lit(None).cast("double")).otherwise(F.col("_mx") * 2.0).alias("terrestrial_radiation"),
        (F.col("_n").cast("double") * 600.0).alias("sunshine_duration"),
    )
    return materialize(out, "forecast", sf_dir)


def splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = panel(spark, sf_dir)
    return p.withColumn("split", F.when(F.col("time") < F.lit(TRAIN_END).cast("timestamp_ntz"), "train")
                        .otherwise("test"))


N_LAGS = 24


def _engineered(spark: SparkSession, sf_dir: str, n_lags: int = N_LAGS, prev_elevation: bool = False) -> DataFrame:
    """Feature table: panel + calendar + radiation/PV-change/daylight + target lags.
    One shuffle for the (site, block) window, see operators.series."""
    from ..functions.calendar import calendar_columns
    from ..operators.series import radiation_features
    p = panel(spark, sf_dir)
    p = p.select("*", *calendar_columns("time"))
    extra = [("sun_elevation_prev", "sun_elevation:d", 1)] if prev_elevation else []
    return radiation_features(p, ["site_id"], "time", n_lags=n_lags, extra_lags=extra)


def engineered(spark: SparkSession, sf_dir: str, n_lags: int = N_LAGS) -> DataFrame:
    """The feature table, written once."""
    return materialize(_engineered(spark, sf_dir, n_lags), "engineered", (sf_dir, n_lags), cluster_by=("site_id", "time"))


MODEL_COLS = ["pv_production", "global_rad:W", "clear_sky_rad:W", "sun_elevation:d", "hour",
              "pv_production_lag_1", "pv_production_lag_24"]


def model_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows usable for modelling: engineered features without NULLs in the model columns,
    plus the previous hour's elevation (for ramp phases) and the split label."""
    # not written whole: only the model's columns are made and kept
    e = _engineered(spark, sf_dir, prev_elevation=True)
    e = e.select("site_id", "time", *[F.col(f"`{c}`") for c in MODEL_COLS], "sun_elevation_prev")
    e = e.na.drop("any", subset=MODEL_COLS)
    e = e.withColumn("split", F.when(F.col("time") < F.lit(TRAIN_END).cast("timestamp_ntz"), "train")
                     .otherwise("test"))
    return materialize(e, "model_frame", sf_dir, cluster_by=("site_id", "time"))
