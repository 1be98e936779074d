"""Registered queries: weather mapping, payloads, request joins, feature building and
scoring (A9, C2-C4, F3-F6, H1-H3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.maps import PROVIDER_HOURLY_VARIABLES, PROVIDER_TO_PROJECT, normalise_lag_keys, weather_columns
from ..functions.maps import coerce_map as coerce_map_expr
from ..functions.numeric import r6
from ..functions.solar import solar_elevation as elevation_expr, solar_elevation_sql
from ..operators import scoring as SC
from ..session import materialize
from . import fixture_sql as FX
from .fixtures import forecast, panel, requests
from .registry import query
from .sqlparts import q, r6 as sr6

FEATURES = ["global_rad:W", "clear_sky_rad:W", "sun_elevation:d", "hour", "pv_production_lag_1", "pv_production_lag_24"]


def _mapped_sql(prefix=""):
    out = []
    for name, src, mult in PROVIDER_TO_PROJECT:
        v = f"CAST({prefix}{src} AS DOUBLE)"
        out.append(f"{v} AS {q(name)}" if mult == 1.0 else
                   (f"{v} * 3600 AS {q(name)}" if mult == 3600.0 else f"{v} / 60 AS {q(name)}"))
    return ", ".join(out)


@query("solar_elevation", f"""{FX.with_('requests')}
SELECT request_id, target_time, {sr6(solar_elevation_sql('target_time', 'latitude', 'longitude'))} AS elevation FROM requests""")
def solar_elevation(spark, sf_dir):
    """NOAA-style solar elevation of each request's target hour and location."""
    r = requests(spark, sf_dir)
    return r.select("request_id", "target_time", r6(elevation_expr("target_time", "latitude", "longitude")).alias("elevation"))


@query("weather_map", f"""{FX.with_('forecast')}
SELECT hour, {', '.join(f'{sr6(q(n))} AS {q(n)}' for n, _, _ in PROVIDER_TO_PROJECT)}
FROM (SELECT hour, {_mapped_sql()} FROM forecast) x""")
def weather_map(spark, sf_dir):
    """provider fields -> the 14 project weather/radiation columns."""
    f = forecast(spark, sf_dir).select("hour", *weather_columns())
    return f.select("hour", *[r6(F.col(f"`{n}`")).alias(n) for n, _, _ in PROVIDER_TO_PROJECT])


_ANY_NULL = " OR ".join(f"{v} IS NULL" for v in PROVIDER_HOURLY_VARIABLES)
_BAD_DOCS = {"2024-01-10": '{"hourly": {"temperature_2m": [1.0]}}', "2024-01-11": "no json",
             "2024-01-12": '{"hourly": {"time": ["2024-01-12T00:00", "2024-01-12T01:00"], "temperature_2m": [1.0]}}',
             "2024-01-13": '{"hourly": {"time": ["yesterday"], "temperature_2m": [1.0]}}'}
_BAD_REASONS = {"2024-01-10": "no hourly data", "2024-01-11": "no hourly data", "2024-01-12": "field shorter than time",
                "2024-01-13": "time not readable"}


@query("weather_explode", f"""{FX.with_('forecast')}, days AS (SELECT DISTINCT CAST(hour AS DATE) AS day FROM forecast),
bad AS (SELECT unnest({list(_BAD_REASONS)})::DATE AS day, unnest({list(_BAD_REASONS.values())}) AS reason)
SELECT hour, {', '.join(f'CASE WHEN {_ANY_NULL} THEN NULL ELSE {sr6(v)} END AS {v}' for v in PROVIDER_HOURLY_VARIABLES)},
       CASE WHEN {_ANY_NULL} THEN 'field without value' ELSE '' END AS reason
FROM forecast WHERE CAST(hour AS DATE) NOT IN (SELECT day FROM bad)
UNION ALL SELECT NULL, {', '.join('NULL' for _ in PROVIDER_HOURLY_VARIABLES)}, reason FROM bad JOIN days USING (day)""")
def weather_explode(spark, sf_dir):
    """Stored provider payloads (one JSON document per day, folded from the forecast)
    parsed back to one row per hour.  Four days' documents are spoilt; hours and documents
    that cannot be used come with the reason."""
    bad = F.lit(None).cast("string")
    for day, text in _BAD_DOCS.items():
        bad = F.when(F.col("day") == F.lit(day).cast("date"), F.lit(text)).otherwise(bad)
    docs = SC.fold_payloads(forecast(spark, sf_dir)).withColumn("payload", F.coalesce(bad, "payload"))
    rows, rejects = SC.explode_payloads(docs)
    values = [r6(v).alias(v) for v in PROVIDER_HOURLY_VARIABLES]
    none = [F.lit(None).cast("double").alias(v) for v in PROVIDER_HOURLY_VARIABLES]
    return rows.select("hour", *values, F.lit("").alias("reason")).union(rejects.select("hour", *none, "reason"))


@query("request_weather", f"""{FX.with_('requests', 'forecast')}
SELECT r.request_id, r.target_time, {', '.join(f'{sr6(q(n))} AS {q(n)}' for n, _, _ in PROVIDER_TO_PROJECT)}
FROM requests r LEFT JOIN (SELECT hour, {_mapped_sql()} FROM forecast) f
  ON f.hour = CAST(date_trunc('hour', r.target_time) AS TIMESTAMP)""")
def request_weather(spark, sf_dir):
    """Each request joined to the forecast of its floor hour (deduplicated forecast)."""
    fc = SC.latest_forecast(forecast(spark, sf_dir))
    j = SC.attach_weather(requests(spark, sf_dir), fc)
    return j.select("request_id", "target_time", *[r6(F.col(f"`{n}`")).alias(n) for n, _, _ in PROVIDER_TO_PROJECT])


def _history(spark, sf_dir, reqs=None):
    r = reqs if reqs is not None else requests(spark, sf_dir)
    return r, SC.history_lags(r, lag_table(spark, sf_dir), 24)


def lag_table(spark, sf_dir):
    """The 24 lags of every (site, hour) that has any, written once and read by every batch."""
    return materialize(SC.lag_table(panel(spark, sf_dir), 24), "lag_table", sf_dir, cluster_by=("site_id", "time"))


_LAGS_SQL = f"""
hl AS (SELECT r.request_id, {', '.join(f'max(CASE WHEN k = {k} THEN p.pv_production END) AS pv_production_lag_{k}' for k in range(1, 25))}
       FROM requests r JOIN (SELECT range AS k FROM range(1, 25)) t ON TRUE
       LEFT JOIN panel p ON p.site_id = r.site_id AND p.time = r.target_time - to_hours(t.k)
       GROUP BY r.request_id)"""


@query("request_lags", f"""{FX.with_('requests', 'panel')}, {_LAGS_SQL}
SELECT * FROM hl""")
def request_lags(spark, sf_dir):
    """C4: PV history at target_time - k hours (k = 1..24) looked up per request."""
    return _history(spark, sf_dir)[1]


def _recent_pv_map(lags):
    return F.create_map(F.lit("lag_1"), F.col("pv_production_lag_1"), F.lit("lag_2"), F.col("pv_production_lag_2"),
                        F.lit("pv_production_lag_24"), F.col("pv_production_lag_24"), F.lit("note"), F.lit(7.0))


_PVMAP_SQL = """
pvm AS (SELECT request_id, 'pv_production_lag_1' AS key, pv_production_lag_1 AS value FROM hl WHERE pv_production_lag_1 IS NOT NULL
        UNION ALL SELECT request_id, 'pv_production_lag_2', pv_production_lag_2 FROM hl WHERE pv_production_lag_2 IS NOT NULL
        UNION ALL SELECT request_id, 'pv_production_lag_24', pv_production_lag_24 FROM hl WHERE pv_production_lag_24 IS NOT NULL
        UNION ALL SELECT request_id, 'pv_change_1h', abs(pv_production_lag_1 - pv_production_lag_2) + 1 FROM hl
                  WHERE pv_production_lag_1 IS NOT NULL AND pv_production_lag_2 IS NOT NULL)"""


@query("lag_keys", f"""{FX.with_('requests', 'panel')}, {_LAGS_SQL}, {_PVMAP_SQL}
SELECT request_id, key, value FROM pvm""")
def lag_keys(spark, sf_dir):
    """request history map {lag_1, lag_2, pv_production_lag_24, note} normalised to model
    names, junk keys dropped, pv_change_1h derived."""
    _, hl = _history(spark, sf_dir)
    m = normalise_lag_keys(_recent_pv_map(hl))
    return hl.select("request_id", F.explode(m).alias("key", "value"))


@query("coerce_map", f"""{FX.with_('forecast')}
SELECT hour, key, value FROM (SELECT hour, {', '.join(f'CAST({v} AS DOUBLE) AS {v}' for v in PROVIDER_HOURLY_VARIABLES)} FROM forecast)
UNPIVOT (value FOR key IN ({', '.join(PROVIDER_HOURLY_VARIABLES)}))""")
def coerce_map(spark, sf_dir):
    """provider values arriving as text in a map, cast to double, NULL entries dropped."""
    f = forecast(spark, sf_dir)
    m = F.create_map(*[x for v in PROVIDER_HOURLY_VARIABLES for x in (F.lit(v), F.col(v).cast("string"))])
    return f.select("hour", F.explode(coerce_map_expr(m)).alias("key", "value"))


def _det_sql(alias="r"):
    t = f"{alias}.target_time"
    e = solar_elevation_sql(t, f"{alias}.latitude", f"{alias}.longitude")
    return f"""
det AS (SELECT request_id, 'hour' AS key, CAST(hour(target_time) AS DOUBLE) AS value FROM requests
        UNION ALL SELECT request_id, 'day_of_week', CAST(isodow(target_time) - 1 AS DOUBLE) FROM requests
        UNION ALL SELECT request_id, 'month', CAST(month(target_time) AS DOUBLE) FROM requests
        UNION ALL SELECT request_id, 'day_of_year', CAST(dayofyear(target_time) AS DOUBLE) FROM requests
        UNION ALL SELECT request_id, 'sun_elevation:d', {e} FROM requests {alias}
        UNION ALL SELECT request_id, 'is_daylight', CASE WHEN {e} >= 2 THEN 1.0 ELSE 0.0 END FROM requests {alias})"""


_WMAP_SQL = f"""
wx AS (SELECT r.request_id, f.* FROM requests r LEFT JOIN (SELECT hour, {_mapped_sql()} FROM forecast) f
         ON f.hour = CAST(date_trunc('hour', r.target_time) AS TIMESTAMP)),
wm AS (SELECT request_id, key, value FROM (SELECT request_id, {', '.join(q(n) for n, _, _ in PROVIDER_TO_PROJECT)} FROM wx)
       UNPIVOT (value FOR key IN ({', '.join(q(n) for n, _, _ in PROVIDER_TO_PROJECT)})))"""

_MERGED_SQL = f"""{FX.with_('requests', 'panel', 'forecast')}, {_LAGS_SQL}, {_PVMAP_SQL}, {_WMAP_SQL}, {_det_sql()},
bogus AS (SELECT request_id, 'hour' AS key, -1.0::DOUBLE AS value FROM requests
          UNION ALL SELECT request_id, 'pv_production_lag_1', -1.0::DOUBLE FROM requests),
layers AS (SELECT request_id, key, value, 0 AS prio FROM wm UNION ALL SELECT request_id, key, value, 0 FROM bogus
           UNION ALL SELECT request_id, key, value, 1 FROM det UNION ALL SELECT request_id, key, value, 2 FROM pvm),
merged AS (SELECT request_id, key, arg_max(value, prio) AS value FROM layers GROUP BY request_id, key)"""


def _layers(spark, sf_dir, reqs=None):
    """Requests with their weather map (plus two deliberately conflicting keys) and their
    history map, ready for merging."""
    r, hl = _history(spark, sf_dir, reqs)
    fc = SC.latest_forecast(forecast(spark, sf_dir))
    j = SC.attach_weather(r, fc).join(hl, "request_id", "left")
    wcols = [F.col(f"`{n}`") for n, _, _ in PROVIDER_TO_PROJECT]
    w = F.map_concat(
        coerce_map_expr(F.create_map(*[x for (n, _, _), c in zip(PROVIDER_TO_PROJECT, wcols) for x in (F.lit(n), c)])),
        F.create_map(F.lit("hour"), F.lit(-1.0), F.lit("pv_production_lag_1"), F.lit(-1.0)))
    j = j.select("request_id", "target_time", "latitude", "longitude", w.alias("_w"), _recent_pv_map(hl).alias("_pv"))
    return j, F.col("_w"), F.col("_pv")


@query("merge_precedence", f"""{_MERGED_SQL}
SELECT request_id, key, {sr6('value')} AS value FROM merged""")
def merge_precedence(spark, sf_dir):
    """Weather < calendar/solar < PV history, later layers win (weather carries
    deliberately conflicting 'hour' and 'pv_production_lag_1' keys)."""
    j, w, pv = _layers(spark, sf_dir)
    m = SC.merged_values(j, w, pv)
    # an inner explode would push size(map) > 0 below the projection and build the map again for it
    return m.select("request_id", F.explode_outer("_all").alias("key", "value")).where("key is not null") \
        .withColumn("value", r6("value"))


_BUILD_SQL = f"""{_MERGED_SQL},
bf AS (SELECT r.request_id, {', '.join(f"max(CASE WHEN m.key = '{c}' THEN m.value END) AS {q(c)}" for c in FEATURES)}
       FROM requests r LEFT JOIN merged m USING (request_id) GROUP BY r.request_id),
bfm AS (SELECT *, concat_ws(',', {', '.join(f"CASE WHEN {q(c)} IS NULL THEN '{c}' END" for c in FEATURES)}) AS missing FROM bf)"""


def _built(spark, sf_dir, reqs=None):
    j, w, pv = _layers(spark, sf_dir, reqs)
    return SC.build_features(j, FEATURES, weather=w, recent_pv=pv).drop("_w", "_pv")


@query("build_features", f"""{_BUILD_SQL}
SELECT request_id, {', '.join(f'{sr6(q(c))} AS {q(c)}' for c in FEATURES)}, missing, missing = '' AS valid FROM bfm""")
def build_features(spark, sf_dir):
    """H1/H2: model features per request in declared order; incomplete requests are kept
    with the list of missing names (valid = false) instead of failing the batch."""
    b = _built(spark, sf_dir)
    return b.select("request_id", *[r6(F.col(f"`{c}`")).alias(c) for c in FEATURES], "missing", "valid")


@query("score_requests", _BUILD_SQL.replace(FX.with_('requests', 'panel', 'forecast'),
                                             FX.with_('requests', 'panel', 'forecast', 'model_frame')) + """,
f AS (SELECT regr_intercept(pv_production, "global_rad:W") AS b0, regr_slope(pv_production, "global_rad:W") AS b1
      FROM model_frame WHERE split = 'train')
SELECT request_id, """ + sr6('b0 + b1 * "global_rad:W"') + """ AS prediction FROM bfm, f WHERE missing = ''""")
def score_requests(spark, sf_dir):
    """H3: valid requests scored by the OLS model fitted on the training split."""
    from ..operators import models as M
    from .fixtures import model_frame
    fm = M.fit(model_frame(spark, sf_dir).where(F.col("split") == "train"), ["global_rad:W"], "pv_production",
               "linear_gram", scaling="none")
    b = _built(spark, sf_dir).where("valid")
    return fm.transform(b).select("request_id", r6("prediction").alias("prediction"))


def _score_batch(spark, sf_dir, reqs, fitted):
    """Score one batch (or micro-batch) of requests with a fitted model."""
    return fitted.transform(_built(spark, sf_dir, reqs).where("valid")).select(
        "request_id", r6("prediction").alias("prediction"))
