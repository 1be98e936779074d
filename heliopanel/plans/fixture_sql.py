"""DuckDB twins of ``fixtures`` — CTE bodies to prepend to each oracle query."""

from __future__ import annotations

from .fixtures import REQUEST_LAT, REQUEST_LON, TRAIN_END, USERS_PER_SITE

SITE = f"event_type || '-' || (user_id // {USERS_PER_SITE})"

PANEL = f"""
panel AS (
  SELECT site_id, time, pv_production,
         pv_production / CAST(_n AS DOUBLE) AS "global_rad:W",
         "clear_sky_rad:W",
         60.0 * sin(pi() * (CAST(extract(hour FROM time) AS DOUBLE) - 6.0) / 12.0) AS "sun_elevation:d",
         CASE WHEN extract(hour FROM time) % 7 = 0 THEN NULL ELSE _kmin - 50.0 END AS temp
  FROM (SELECT {SITE} AS site_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS time,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS pv_production,
               count(*) AS _n, max(value) AS "clear_sky_rad:W",
               min(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS _kmin
        FROM events GROUP BY 1, 2) g
)"""

ONE_SERIES = """
one_series AS (
  SELECT time, pv_production,
         CASE WHEN extract(hour FROM time) % 7 = 0 THEN NULL ELSE _kmin - 50.0 END AS temp
  FROM (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS time,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS pv_production,
               min(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS _kmin
        FROM events GROUP BY 1) g
)"""

LINE_FEATURES = """
line_features AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_quantity, l_discount, l_tax,
         CAST(l_linenumber AS DOUBLE) AS line_no, 1.0::DOUBLE AS const_one, l_extendedprice
  FROM lineitem
)"""

DAILY_ORDERS = """
daily_orders AS (
  SELECT o_orderpriority AS site_id, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS time,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS pv_production
  FROM orders GROUP BY 1, 2
)"""

REQUESTS = f"""
requests AS (
  SELECT event_id AS request_id, {SITE} AS site_id,
         CAST(date_trunc('hour', ts) AS TIMESTAMP) + INTERVAL 1 HOUR AS target_time,
         {REQUEST_LAT}::DOUBLE AS latitude, {REQUEST_LON}::DOUBLE AS longitude
  FROM events
)"""

FORECAST = """
forecast AS (
  SELECT time AS hour, _t AS temperature_2m,
         40.0 + CAST(_n AS DOUBLE) * 10.0 AS relative_humidity_2m,
         CAST(extract(hour FROM time) AS DOUBLE) * 4.0 AS cloud_cover,
         _mx AS shortwave_radiation, _mx * 0.5 AS direct_radiation, _mx * 0.25 AS diffuse_radiation,
         CASE WHEN extract(hour FROM time) % 5 = 0 THEN NULL ELSE _mx * 2.0 END AS terrestrial_radiation,
         CAST(_n AS DOUBLE) * 600.0 AS sunshine_duration
  FROM (SELECT time, avg(temp) AS _t, max("clear_sky_rad:W") AS _mx,
               sum(pv_production) AS _pv, count(*) AS _n FROM panel GROUP BY time) g
)"""

SPLITS = f"""
splits AS (
  SELECT *, CASE WHEN time < TIMESTAMP '{TRAIN_END}' THEN 'train' ELSE 'test' END AS split FROM panel
)"""

_DEPS = {
    "panel": (PANEL, []),
    "one_series": (ONE_SERIES, []),
    "line_features": (LINE_FEATURES, []),
    "daily_orders": (DAILY_ORDERS, []),
    "requests": (REQUESTS, []),
    "forecast": (FORECAST, ["panel"]),
    "splits": (SPLITS, ["panel"]),
}


def with_(*names: str) -> str:
    """WITH clause holding the named fixtures (and what they depend on), in order."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in _DEPS[n][1]:
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(_DEPS[n][0].strip() for n in order)


def _engineered(n_lags: int = 24) -> str:
    lags = ",\n         ".join(
        f'lag(pv_production, {k}) OVER w AS pv_production_lag_{k}' for k in range(1, n_lags + 1))
    return f"""
engineered AS (
  SELECT *,
         CAST(hour(time) AS INTEGER) AS hour, CAST(isodow(time) - 1 AS INTEGER) AS day_of_week,
         CAST(month(time) AS INTEGER) AS month, CAST(dayofyear(time) AS INTEGER) AS day_of_year,
         "global_rad:W" - lag("global_rad:W", 1) OVER w AS global_rad_trend_1h,
         ("global_rad:W" - lag("global_rad:W", 1) OVER w)
           - (lag("global_rad:W", 1) OVER w - lag("global_rad:W", 2) OVER w) AS global_rad_acceleration_1h,
         abs(lag(pv_production, 1) OVER w - lag(pv_production, 2) OVER w) + 1 AS pv_change_1h,
         {lags},
         coalesce(CAST("sun_elevation:d" >= 2 AS INTEGER), 0) AS is_daylight
  FROM panel WINDOW w AS (PARTITION BY site_id ORDER BY time)
)"""


ENGINEERED = _engineered()
_DEPS["engineered"] = (ENGINEERED, ["panel"])


MODEL_FRAME = f"""
model_frame AS (
  SELECT site_id, time, pv_production, "global_rad:W", "clear_sky_rad:W", "sun_elevation:d", hour,
         pv_production_lag_1, pv_production_lag_24, sun_elevation_prev,
         CASE WHEN time < TIMESTAMP '{TRAIN_END}' THEN 'train' ELSE 'test' END AS split
  FROM (SELECT *, lag("sun_elevation:d", 1) OVER (PARTITION BY site_id ORDER BY time) AS sun_elevation_prev
        FROM engineered) e
  WHERE pv_production IS NOT NULL AND "global_rad:W" IS NOT NULL AND "clear_sky_rad:W" IS NOT NULL
    AND "sun_elevation:d" IS NOT NULL AND hour IS NOT NULL AND pv_production_lag_1 IS NOT NULL
    AND pv_production_lag_24 IS NOT NULL
)"""
_DEPS["model_frame"] = (MODEL_FRAME, ["engineered"])
