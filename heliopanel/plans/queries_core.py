"""Registered queries: loading, projections, windows (A/B/C/E families)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import r6
from ..operators import evaluate, panel as P, series as S
from . import fixture_sql as FX
from .fixtures import panel
from .registry import query
from .sqlparts import complete_days_sql, metrics_sql


def naive_day_ahead(spark, sf_dir):
    """Flagship: how good is yesterday-same-hour as a forecast, per site?
    events -> hourly panel -> complete days -> lag 24 -> metrics per site."""
    p = P.complete_days(panel(spark, sf_dir).select("site_id", "time", "pv_production"), ["site_id"])
    f = S.positional(p, lambda w: [F.lag("pv_production", 24).over(w).alias("lag_24")], 24, ["site_id"])
    m = evaluate.regression_metrics(f, "pv_production", "lag_24", ["site_id"])
    return m.select("site_id", "n", *[r6(c).alias(c) for c in ("rmse", "mae", "r2", "mape")])


query("naive_day_ahead", f"""{FX.with_('panel')}, {complete_days_sql()},
lagged AS (SELECT site_id, pv_production, lag(pv_production, 24) OVER (PARTITION BY site_id ORDER BY time) AS lag_24 FROM cd)
{metrics_sql('lagged', 'pv_production', 'lag_24', ['site_id'])}""")(naive_day_ahead)


# ---------------------------------------------------------------- loading (A, B) ----
from ..functions.calendar import calendar_columns, is_daylight as daylight_expr  # noqa: E402
from .fixtures import N_LAGS, engineered, one_series  # noqa: E402
from .sqlparts import q as sq, r6 as sr6  # noqa: E402

PANEL_COLS = ["site_id", "time", "pv_production", "global_rad:W", "clear_sky_rad:W", "sun_elevation:d", "temp"]
PANEL_SQL_COLS = ", ".join(sq(c) for c in PANEL_COLS)


@query("schema_check", f"{FX.with_('panel')} SELECT * FROM panel")
def schema_check(spark, sf_dir):
    """A2: the time column must exist (raises otherwise), targets only warn; rows pass."""
    return P.check_columns(panel(spark, sf_dir), "time", ["pv_production"])


_REPORT_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{r}' AS role, count({sq(c)}) AS n_values, 'ok' AS outcome FROM panel"
    for c, r in [("time", "time"), ("pv_production", "target"), ("site_id", "other")] + [(c, "feature") for c in PANEL_COLS[3:]])


@query("column_report", f"{FX.with_('panel')} {_REPORT_SQL} UNION ALL SELECT 'pv_backup', 'target', 0, 'warning'"
       " UNION ALL SELECT 'timestamp', 'time', 0, 'error'")
def column_report(spark, sf_dir):
    """What the column check and the numeric discovery say of the panel: a missing target is a
    warning; a second check, by a time column that is not there, an error."""
    p = panel(spark, sf_dir)
    wrong = P.column_report(p, "timestamp", ["pv_production"]).where("outcome = 'error'")
    return P.column_report(p, "time", ["pv_production", "pv_backup"]).union(wrong)


@query("parse_time", """
SELECT event_id, CAST(strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS time,
       CAST(CAST(strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS DATE) AS VARCHAR) AS date
FROM events""")
def parse_time(spark, sf_dir):
    """A3: timestamps arriving as text are parsed (ANSI: a bad value raises) and `date` added."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time"))
    out = P.parse_time(ev, "time", "yyyy-MM-dd HH:mm:ss")
    return out.select("event_id", "time", F.col("date").cast("string").alias("date"))


@query("complete_days", f"{FX.with_('panel')}, {complete_days_sql()} SELECT * FROM cd")
def complete_days(spark, sf_dir):
    """B1: complete days per site; a site without any keeps all its rows."""
    return P.complete_days(panel(spark, sf_dir), ["site_id"], "time", 24)


@query("feature_target", f"""{FX.with_('panel')}
SELECT site_id, time, "global_rad:W", "sun_elevation:d", temp, pv_production FROM panel""")
def feature_target(spark, sf_dir):
    """Feature and target projections of the panel, stacked as (column, value) rows would
    be by a caller that needs both: here one select of the two column lists."""
    p = panel(spark, sf_dir)
    X, y = P.feature_target(p, ["site_id", "time", "global_rad:W", "sun_elevation:d", "temp"], ["pv_production"])
    return p.select(*[F.col(f"`{c}`") for c in X.columns + y.columns])


_HIST_COLS = (["site_id", "time", "pv_production", "sun_elevation:d", "hour", "day_of_week", "month",
               "day_of_year", "pv_change_1h"] + [f"pv_production_lag_{k}" for k in range(1, N_LAGS + 1)]
              + ["is_daylight"])


@query("history_only", f"{FX.with_('engineered')} SELECT {', '.join(sq(c) for c in _HIST_COLS)} FROM engineered")
def history_only(spark, sf_dir):
    """History-only availability — drops target-hour weather columns (catalog-only)."""
    out, _report = P.apply_availability(engineered(spark, sf_dir), "history_only", keys=["site_id"])
    return out


@query("tail_split", f"""{FX.with_('panel')}
SELECT site_id, time, _i AS row_idx,
       CASE WHEN _i < CAST(floor(_n * (1 - 0.2)) AS BIGINT) THEN 'train' ELSE 'test' END AS split
FROM (SELECT site_id, time, row_number() OVER (PARTITION BY site_id ORDER BY time) - 1 AS _i,
             count(*) OVER (PARTITION BY site_id) AS _n FROM panel) x""")
def tail_split(spark, sf_dir):
    """Chronological tail split by position, test_size 0.2, per site."""
    from ..operators.splits import tail_split as ts
    return ts(panel(spark, sf_dir).select("site_id", "time"), 0.2, ["site_id"])


DATE_BOUNDS = {"train": ("2024-01-01", "2024-01-20"), "val": ("2024-01-21", "2024-01-24"),
               "test": ("2024-01-25", "2024-01-31")}


@query("date_split", f"""{FX.with_('panel')}
SELECT site_id, time, CASE
  WHEN CAST(time AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-20' THEN 'train'
  WHEN CAST(time AS DATE) BETWEEN DATE '2024-01-21' AND DATE '2024-01-24' THEN 'val'
  WHEN CAST(time AS DATE) BETWEEN DATE '2024-01-25' AND DATE '2024-01-31' THEN 'test' END AS split
FROM panel""")
def date_split(spark, sf_dir):
    """train/val/test by inclusive date ranges."""
    return P.date_split(panel(spark, sf_dir).select("site_id", "time"), DATE_BOUNDS)


# ---------------------------------------------------------------- windows (E) -------
_LAGS_SQL = ", ".join(f"lag(pv_production, {k}) OVER w AS pv_production_lag_{k}" for k in range(1, N_LAGS + 1))


@query("lag_features", f"""{FX.with_('panel')}
SELECT site_id, time, pv_production, {_LAGS_SQL} FROM panel WINDOW w AS (PARTITION BY site_id ORDER BY time)""")
def lag_features(spark, sf_dir):
    """pv_production_lag_1..24 per site (bounded (site, block) windows)."""
    p = panel(spark, sf_dir).select("site_id", "time", "pv_production")
    return S.add_lags(p, ["pv_production"], N_LAGS, ["site_id"])


@query("rad_trend", f"""{FX.with_('engineered')} SELECT site_id, time, global_rad_trend_1h FROM engineered""")
def rad_trend(spark, sf_dir):
    """First difference of global radiation."""
    return engineered(spark, sf_dir, 0).select("site_id", "time", "global_rad_trend_1h")


@query("rad_accel", f"""{FX.with_('engineered')} SELECT site_id, time, global_rad_acceleration_1h FROM engineered""")
def rad_accel(spark, sf_dir):
    """Second difference of global radiation."""
    return engineered(spark, sf_dir, 0).select("site_id", "time", "global_rad_acceleration_1h")


@query("pv_change", f"""{FX.with_('engineered')} SELECT site_id, time, pv_change_1h FROM engineered""")
def pv_change(spark, sf_dir):
    """Leak-free change |y[-1] - y[-2]| + 1."""
    return engineered(spark, sf_dir, 0).select("site_id", "time", "pv_change_1h")


def _gappy(spark, sf_dir):
    """Panel with the columns that carry nulls: temp (every 7th hour) and two lags (leading)."""
    p = panel(spark, sf_dir).select("site_id", "time", "pv_production", "temp")
    return S.add_lags(p, ["pv_production"], 2, ["site_id"])


_GAPPY_SQL = f"""{FX.with_('panel')},
gappy AS (SELECT site_id, time, pv_production, temp,
                 lag(pv_production, 1) OVER w AS pv_production_lag_1,
                 lag(pv_production, 2) OVER w AS pv_production_lag_2
          FROM panel WINDOW w AS (PARTITION BY site_id ORDER BY time))"""
_FILL_COLS = ["temp", "pv_production_lag_1", "pv_production_lag_2"]


def _ffill_sql(c):
    return (f"coalesce(last_value({c} IGNORE NULLS) OVER (PARTITION BY site_id ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"first_value({c} IGNORE NULLS) OVER (PARTITION BY site_id ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}")


@query("ffill_bfill", f"""{_GAPPY_SQL}
SELECT site_id, time, pv_production, {', '.join(_ffill_sql(c) for c in _FILL_COLS)} FROM gappy""")
def ffill_bfill(spark, sf_dir):
    """E5: forward then backward fill per site."""
    return S.handle_missing(_gappy(spark, sf_dir), "forward_fill", _FILL_COLS, ["site_id"])


def _interp_sql(c):
    w_up = "OVER (PARTITION BY site_id ORDER BY _i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    w_on = "OVER (PARTITION BY site_id ORDER BY _i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    pi = f"last_value(CASE WHEN {c} IS NOT NULL THEN _i END IGNORE NULLS) {w_up}"
    pv = f"last_value({c} IGNORE NULLS) {w_up}"
    ni = f"first_value(CASE WHEN {c} IS NOT NULL THEN _i END IGNORE NULLS) {w_on}"
    nv = f"first_value({c} IGNORE NULLS) {w_on}"
    return (f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN {pi} IS NULL THEN NULL WHEN {ni} IS NULL THEN {pv} "
            f"ELSE ({nv} - {pv}) / CAST({ni} - {pi} AS DOUBLE) * CAST(_i - {pi} AS DOUBLE) + {pv} END AS {c}")


@query("interpolate", f"""{_GAPPY_SQL},
ix AS (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY time) - 1 AS _i FROM gappy)
SELECT site_id, time, pv_production, {', '.join(_interp_sql(c) for c in _FILL_COLS)} FROM ix""")
def interpolate(spark, sf_dir):
    """Positional linear interpolation per site."""
    return S.handle_missing(_gappy(spark, sf_dir), "interpolate", _FILL_COLS, ["site_id"])


@query("drop_nulls", f"""{FX.with_('engineered')} SELECT * FROM engineered WHERE {' AND '.join(
    f'{sq(c)} IS NOT NULL' for c in ['temp', 'global_rad_acceleration_1h', 'pv_change_1h', 'pv_production_lag_24'])}""")
def drop_nulls(spark, sf_dir):
    """Rows with any null dropped (after feature engineering)."""
    return S.handle_missing(engineered(spark, sf_dir), "drop")


@query("event_index", """
SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts END NULLS LAST, event_id) - 1 AS row_idx
FROM events""")
def event_index(spark, sf_dir):
    """E8 on dense data: place of every raw event in its type by time, a third of the times unknown, by even
    ranges instead of days."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", F.when(F.col("event_id") % 3 != 0, F.col("ts")).alias("ts"))
    return S.row_index(ev, ["event_type"], "ts", "row_idx", ["event_id"], bucket="range").select("event_id", "event_type", "row_idx")


@query("event_fill", f"""
WITH e AS (SELECT event_id, event_type, ts, CASE WHEN event_id % 5 < 3 THEN CAST(value AS DOUBLE) END AS value FROM events),
f AS (SELECT event_id, event_type, last_value(value IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS ff,
             first_value(value IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bf FROM e)
SELECT event_id, event_type, {sr6('coalesce(ff, bf)')} AS value FROM f""")
def event_fill(spark, sf_dir):
    """E5 on dense data: values of raw events filled forward, then backward, in their type, by even ranges."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "event_type", "ts", F.when(F.col("event_id") % 5 < 3, F.col("value").cast("double")).alias("value"))
    out = S.fill_forward_backward(ev, ["value"], ["event_type"], "ts", bucket="range", tiebreak=["event_id"])
    return out.select("event_id", "event_type", r6("value").alias("value"))


@query("row_index", f"""{FX.with_('one_series')}
SELECT time, pv_production, row_number() OVER (ORDER BY time) - 1 AS row_idx FROM one_series""")
def row_index(spark, sf_dir):
    """Position in one long series (no keys) without a single-partition window."""
    return S.row_index(one_series(spark, sf_dir).select("time", "pv_production"), [], "time", "row_idx")


@query("one_series_lags", f"""{FX.with_('one_series')}
SELECT time, pv_production, temp, lag(pv_production, 1) OVER w AS pv_production_lag_1,
       lag(pv_production, 24) OVER w AS pv_production_lag_24
FROM one_series WINDOW w AS (ORDER BY time)""")
def one_series_lags(spark, sf_dir):
    """E1 on one unkeyed series through (block + halo) windows; blocks of 100 rows so that
    halo copies are exercised at every scale."""
    s = one_series(spark, sf_dir)
    return S.positional(s, lambda w: [F.lag("pv_production", 1).over(w).alias("pv_production_lag_1"),
                                      F.lag("pv_production", 24).over(w).alias("pv_production_lag_24")],
                        24, [], "time")


@query("one_series_fill", f"""{FX.with_('one_series')}
SELECT time, pv_production, coalesce(last_value(temp IGNORE NULLS) OVER (ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(temp IGNORE NULLS) OVER (ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS temp FROM one_series""")
def one_series_fill(spark, sf_dir):
    """E5 on one unkeyed series (day windows + carried values)."""
    return S.fill_forward_backward(one_series(spark, sf_dir), ["temp"], [], "time")


# ---------------------------------------------------------------- scalars (F1, F2) --
@query("time_features", f"""{FX.with_('panel')}
SELECT site_id, time, CAST(hour(time) AS INTEGER) AS hour, CAST(isodow(time) - 1 AS INTEGER) AS day_of_week,
       CAST(month(time) AS INTEGER) AS month, CAST(dayofyear(time) AS INTEGER) AS day_of_year FROM panel""")
def time_features(spark, sf_dir):
    """hour, day_of_week (Monday = 0), month, day_of_year."""
    return panel(spark, sf_dir).select("site_id", "time", *calendar_columns("time"))


@query("is_daylight", f"""{FX.with_('panel')}
SELECT site_id, time, coalesce(CAST("sun_elevation:d" >= 2 AS INTEGER), 0) AS is_daylight FROM panel""")
def is_daylight(spark, sf_dir):
    """elevation >= 2 degrees, null elevation counts as night."""
    return panel(spark, sf_dir).select("site_id", "time", daylight_expr("sun_elevation:d").alias("is_daylight"))


# ---------------------------------------------------------------- set ops (C5) ------
@query("split_overlap", f"""{FX.with_('panel')},
sp AS (SELECT site_id, time, CASE WHEN _i < CAST(floor(_n * (1 - 0.2)) AS BIGINT) THEN 'train' ELSE 'test' END AS split
       FROM (SELECT site_id, time, row_number() OVER (PARTITION BY site_id ORDER BY time) - 1 AS _i,
                    count(*) OVER (PARTITION BY site_id) AS _n FROM panel) x)
SELECT time FROM sp WHERE split = 'train' INTERSECT SELECT time FROM sp WHERE split = 'test'""")
def split_overlap(spark, sf_dir):
    """Timestamps that are in a train split and a test split (per-site tail splits cut
    at different hours, so the union over sites overlaps)."""
    from ..operators.splits import tail_split as ts
    sp = ts(panel(spark, sf_dir).select("site_id", "time"), 0.2, ["site_id"])
    return (sp.where(F.col("split") == "train").select("time")
              .intersect(sp.where(F.col("split") == "test").select("time")))


# ---------------------------------------------------------------- daily series ------
from .fixtures import daily_orders  # noqa: E402


@query("daily_complete_days", f"""{FX.with_('daily_orders')}, {complete_days_sql('daily_orders', 'cd', 1)}
SELECT * FROM cd""")
def daily_complete_days(spark, sf_dir):
    """B1 with points_per_day = 1 on daily order totals per priority (every day present is
    complete): the filter keeps all rows."""
    return P.complete_days(daily_orders(spark, sf_dir), ["site_id"], "time", 1)


@query("daily_gaps", f"""{FX.with_('daily_orders')}
SELECT site_id, time, prev_time, CAST(epoch(time) - epoch(prev_time) AS DOUBLE) / 3600.0 AS gap_hours
FROM (SELECT site_id, time, lag(time) OVER (PARTITION BY site_id ORDER BY time) AS prev_time FROM daily_orders) x
WHERE epoch(time) - epoch(prev_time) > 86400""")
def daily_gaps(spark, sf_dir):
    """D15 on daily series: days without any order, per priority (month buckets)."""
    from ..operators.quality import gaps
    return gaps(daily_orders(spark, sf_dir), ["site_id"], "time", 86400, bucket="month")


@query("daily_lags", f"""{FX.with_('daily_orders')}
SELECT site_id, time, pv_production, lag(pv_production, 1) OVER w AS pv_production_lag_1,
       lag(pv_production, 7) OVER w AS pv_production_lag_7
FROM daily_orders WINDOW w AS (PARTITION BY site_id ORDER BY time)""")
def daily_lags(spark, sf_dir):
    """E1 on daily series (lag 1 and 7 days, positional), month buckets, small blocks so
    that halo rows are exercised."""
    d = daily_orders(spark, sf_dir)
    return S.positional(d, lambda w: [F.lag("pv_production", 1).over(w).alias("pv_production_lag_1"),
                                      F.lag("pv_production", 7).over(w).alias("pv_production_lag_7")],
                        7, ["site_id"], "time", bucket="month")


@query("lag_features_time", f"""{FX.with_('panel')}
SELECT p.site_id, p.time, p.pv_production, p1.pv_production AS pv_production_lag_1, p24.pv_production AS pv_production_lag_24
FROM panel p
LEFT JOIN panel p1 ON p1.site_id = p.site_id AND p1.time = p.time - INTERVAL 1 HOUR
LEFT JOIN panel p24 ON p24.site_id = p.site_id AND p24.time = p.time - INTERVAL 24 HOUR""")
def lag_features_time(spark, sf_dir):
    """E1 with mode='time': value exactly 1 and 24 hours earlier (NULL across missing
    hours), unlike the positional default."""
    p = panel(spark, sf_dir).select("site_id", "time", "pv_production")
    out = S.time_lags(p, ["pv_production"], [1, 24], ["site_id"], "time", 3600)
    return out.select("site_id", "time", "pv_production", "pv_production_lag_1", "pv_production_lag_24")
