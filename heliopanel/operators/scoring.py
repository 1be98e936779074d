"""Request-side feature building and scoring (A9, C2, C4, H1-H3), batch or streaming.

Every step is a per-row projection or an equi-join against a table keyed by (location,
hour) or (series, time), so the same functions run on a ``readStream`` DataFrame
(stream-static joins) and on a batch table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import is_daylight
from ..functions.maps import (PROVIDER_HOURLY_VARIABLES, coerce_map, merge_layers, normalise_lag_keys,
                              weather_columns)
from ..functions.solar import solar_elevation

PAYLOAD_SCHEMA = T.StructType([T.StructField("hourly", T.StructType(
    [T.StructField("time", T.ArrayType(T.StringType()))]
    + [T.StructField(v, T.ArrayType(T.DoubleType())) for v in PROVIDER_HOURLY_VARIABLES]))])
PAYLOAD_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"


def fold_payloads(forecast: DataFrame, hour_col: str = "hour", keys: Sequence[str] = ()) -> DataFrame:
    """Provider-style documents: one JSON payload per (keys, day) with parallel arrays.
    A day holds at most 24 hours, so each group is bounded."""
    day = F.to_date(hour_col).alias("day")
    item = F.struct(F.col(hour_col).alias("_h"), *[F.col(v) for v in PROVIDER_HOURLY_VARIABLES])
    g = forecast.groupBy(*keys, day).agg(F.array_sort(F.collect_list(item)).alias("_items"))
    def field(v):
        return F.transform("_items", lambda x: x[v]).alias(v)

    hourly = F.struct(F.transform("_items", lambda x: F.date_format(x["_h"], PAYLOAD_TIME_FORMAT)).alias("time"),
                      *[field(v) for v in PROVIDER_HOURLY_VARIABLES])
    return g.select(*keys, "day", F.to_json(F.struct(hourly.alias("hourly"))).alias("payload"))


def explode_payloads(payloads: DataFrame, payload_col: str = "payload", keys: Sequence[str] = ()):
    """Parse stored payloads into one row per forecast hour.

    Returns (rows, rejects).  A document without ``hourly.time``, with an array shorter than
    the time array or with a time that cannot be read is rejected as a whole (hour NULL); an
    hour at which a field that the document has holds no value is rejected alone."""
    p = payloads.withColumn("_doc", F.from_json(F.col(payload_col), PAYLOAD_SCHEMA))
    n = F.size("_doc.hourly.time")
    short, gap = F.lit(False), F.lit(False)
    for v in PROVIDER_HOURLY_VARIABLES:
        field = F.col(f"_doc.hourly.{v}")
        short = short | (field.isNotNull() & (F.size(field) < n))
        gap = gap | (F.col(f"_has.{v}") & F.col(f"_r.{v}").isNull())

    def hour(text):
        return F.try_to_timestamp(text, F.lit(PAYLOAD_TIME_FORMAT)).cast("timestamp_ntz")

    unread = F.exists("_doc.hourly.time", lambda t: hour(t).isNull())
    reason = (F.when(F.col("_doc.hourly").isNull() | F.col("_doc.hourly.time").isNull(), "no hourly data")
               .when(short, "field shorter than time").when(unread, "time not readable"))
    p = p.withColumn("_reason", reason)
    bad = p.where(F.col("_reason").isNotNull()).select(
        *keys, payload_col, F.lit(None).cast("timestamp_ntz").alias("hour"), F.col("_reason").alias("reason"))
    has = F.struct(*[F.col(f"_doc.hourly.{v}").isNotNull().alias(v) for v in PROVIDER_HOURLY_VARIABLES])
    zipped = F.arrays_zip(F.col("_doc.hourly.time").alias("time"),
                          *[F.col(f"_doc.hourly.{v}").alias(v) for v in PROVIDER_HOURLY_VARIABLES])
    each = p.where(F.col("_reason").isNull()).select(*keys, payload_col, has.alias("_has"), F.explode(zipped).alias("_r")) \
        .where(F.col("_r.time").isNotNull()).withColumn("hour", hour(F.col("_r.time"))).withColumn("_gap", gap)
    rows = each.where(~F.col("_gap")).select(*keys, "hour", *[F.col(f"_r.{v}").alias(v) for v in PROVIDER_HOURLY_VARIABLES])
    holes = each.where("_gap").select(*keys, payload_col, "hour", F.lit("field without value").alias("reason"))
    return rows, bad.unionByName(holes)


def latest_forecast(forecast: DataFrame, hour_col: str = "hour", keys: Sequence[str] = (),
                    order: Column | None = None) -> DataFrame:
    """One forecast row per (keys, hour): the row with the smallest ``order`` value (e.g. the
    issue time; default: the row itself).  An aggregate (min_by), so duplicates of a hot
    hour are combined map-side instead of gathered into one window task."""
    cols = [c for c in forecast.columns if c not in list(keys) + [hour_col]]
    row = F.struct(*[F.col(f"`{c}`") for c in cols])
    pick = F.min_by(row, order if order is not None else row).alias("_r")
    return forecast.groupBy(*keys, hour_col).agg(pick).select(*keys, hour_col, *[F.col(f"_r.`{c}`").alias(c) for c in cols])


def attach_weather(requests: DataFrame, forecast: DataFrame, time_col: str = "target_time",
                   keys: Sequence[str] = (), hour_col: str = "hour") -> DataFrame:
    """Left equi-join of each request to the forecast of its (location, floor-hour);
    adds the 14 mapped weather columns (F4) and a ``weather`` map (NULLs dropped)."""
    fc = forecast.select(*keys, F.col(hour_col).alias("_fh"), *weather_columns())
    r = requests.withColumn("_fh", F.date_trunc("hour", F.col(time_col)).cast("timestamp_ntz"))
    return r.join(fc, list(keys) + ["_fh"], "left").drop("_fh")


def lag_table(history: DataFrame, n_lags: int = 24, series_keys: Sequence[str] = ("site_id",),
              value_col: str = "pv_production", history_time: str = "time") -> DataFrame:
    """Per (series, hour): the values 1..n_lags hours earlier.

    Hours are folded into one row per series and day (24 values, combined before the shuffle), a
    day's row is passed on to the days whose lags reach back to it, and each day then lists its hours.
    What is shuffled is a row per day and reach, not n_lags rows per hour.  Time-based: a missing
    hour gives NULL (no positional shift across gaps).  Times off the hour keep their minutes."""
    keys = list(series_keys)
    t, v = F.col(history_time).cast("timestamp_ntz"), F.col(value_col)
    day, hour = F.to_date(t), F.hour(t)
    beyond = (F.unix_micros(t.cast("timestamp")) % 3_600_000_000).alias("_m")
    days = history.where(t.isNotNull()).groupBy(*keys, day.alias("_d"), beyond).agg(
        F.array(*[F.max(F.when(hour == h, v)) for h in range(24)]).alias("_v"))
    reach = -(-n_lags // 24)
    none = F.array_repeat(F.lit(None).cast(history.schema[value_col].dataType), 24)
    ahead = days.select(*keys, "_m", "_v", F.explode(F.sequence(F.lit(0), F.lit(reach))).alias("_o"), "_d") \
        .withColumn("_d", F.date_add("_d", F.col("_o")))
    back = [F.coalesce(F.max(F.when(F.col("_o") == o, F.col("_v"))), none) for o in range(reach, -1, -1)]
    runs = ahead.groupBy(*keys, "_d", "_m").agg(F.concat(*back).alias("_v"))       # hours of the days before, then of the day
    each = runs.select(*keys, "_d", "_m", "_v", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("_h"))
    at = F.col("_d").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("_h"), F.lit(0), (F.col("_m") / 1_000_000).cast("decimal(18,6)"))
    lags = [F.col("_v")[F.col("_h") + (24 * reach - k)].alias(f"{value_col}_lag_{k}") for k in range(1, n_lags + 1)]
    out = each.select(*keys, at.cast("timestamp_ntz").alias(history_time), *lags)
    return out.where(F.coalesce(*[F.col(f"`{value_col}_lag_{k}`") for k in range(1, n_lags + 1)]).isNotNull())


def history_lags(requests: DataFrame, lags: DataFrame, n_lags: int = 24, time_col: str = "target_time",
                 series_keys: Sequence[str] = ("site_id",), value_col: str = "pv_production",
                 history_time: str = "time", id_col: str = "request_id") -> DataFrame:
    """C4: the value k hours before each request's target time, k = 1..n_lags: one equi-join
    on (series, target hour) with ``lag_table``."""
    keys = list(series_keys)
    names = [f"{value_col}_lag_{k}" for k in range(1, n_lags + 1)]
    r = requests.select(id_col, *keys, F.col(time_col).cast("timestamp_ntz").alias("_target"))
    h = lags.select(*keys, F.col(history_time).alias("_target"), *names)
    return r.join(h, [*keys, "_target"], "left").select(id_col, *names)


def with_local_and_utc(requests: DataFrame, time_col: str = "target_time") -> DataFrame:
    """Adds ``_local`` (the clock as written) and ``_utc``; a text without a zone counts as UTC,
    a text that cannot be read gives NULL."""
    t = F.col(time_col)
    if not isinstance(requests.schema[time_col].dataType, T.StringType):
        local = t.cast("timestamp_ntz")
        return requests.withColumn("_local", local).withColumn("_utc", local)
    zone = F.regexp_extract(F.trim(t), "(Z|[+-][0-9]{2}:?[0-9]{2})$", 1)
    clock = F.regexp_replace(F.trim(t), " ?(Z|[+-][0-9]{2}:?[0-9]{2})$", "")
    zone = F.when(clock.rlike("[0-9]:[0-9]{2}"), zone).otherwise("")      # '2024-01-05' ends in no zone
    clock = F.when(zone == "", F.trim(t)).otherwise(clock)
    digits = F.regexp_replace(zone, "[^0-9]", "")
    hours = F.when(digits != "", F.substring(digits, 1, 2).cast("int")).otherwise(0)
    minutes = F.when(digits != "", F.substring(digits, 3, 2).cast("int")).otherwise(0)
    shift = F.make_dt_interval(F.lit(0), hours, minutes)
    d = requests.withColumn("_local", clock.try_cast("timestamp_ntz"))
    return d.withColumn("_utc", F.when(zone.startswith("-"), F.col("_local") + shift).otherwise(F.col("_local") - shift))


def deterministic_values(time_col: str = "target_time", lat: str | None = "latitude",
                         lon: str | None = "longitude", solar_time_col: str | None = None) -> dict[str, Column]:
    """F1 (+ F3, F2 when a location is given) as named double columns; solar values are NULL
    for a request without a location (the layer then has no such key)."""
    t = F.col(time_col)
    out = {"hour": F.hour(t).cast("double"), "day_of_week": F.weekday(t).cast("double"),
           "month": F.month(t).cast("double"), "day_of_year": F.dayofyear(t).cast("double")}
    if lat is not None and lon is not None:
        elev = solar_elevation(solar_time_col or time_col, lat, lon)
        has = F.col(lat).isNotNull() & F.col(lon).isNotNull()
        out["sun_elevation:d"] = F.when(has, elev)
        out["is_daylight"] = F.when(has, is_daylight(elev).cast("double"))
    return out


def deterministic_map(time_col: str = "target_time", lat: str | None = "latitude",
                      lon: str | None = "longitude") -> Column:
    """F1 (+ F3, F2 when a location is given) as a map of doubles."""
    t = F.col(time_col)
    pairs = [F.lit("hour"), F.hour(t).cast("double"), F.lit("day_of_week"), F.weekday(t).cast("double"),
             F.lit("month"), F.month(t).cast("double"), F.lit("day_of_year"), F.dayofyear(t).cast("double")]
    base = F.create_map(*pairs)
    if lat is None or lon is None:
        return base
    elev = solar_elevation(time_col, lat, lon)
    solar = F.create_map(F.lit("sun_elevation:d"), elev, F.lit("is_daylight"), is_daylight(elev).cast("double"))
    return F.when(F.col(lat).isNotNull() & F.col(lon).isNotNull(), F.map_concat(base, solar)).otherwise(base)


def merged_values(requests: DataFrame, weather: Column | None = None, recent_pv: Column | None = None,
                  time_col: str = "target_time", lat: str | None = "latitude",
                  lon: str | None = "longitude") -> DataFrame:
    """Adds ``_all``: weather < calendar/solar < PV-history values as one map.
    The three layers are projected first, then merged over column references (3.5x faster
    than folding sorted entries, measured at sf0.1)."""
    empty = F.create_map().cast("map<string,double>")
    w = coerce_map(weather) if weather is not None else empty
    pv = normalise_lag_keys(recent_pv) if recent_pv is not None else empty
    d = requests.select("*", w.alias("_lw"), deterministic_map(time_col, lat, lon).alias("_ld"), pv.alias("_lh"))
    return d.select(*[F.col(f"`{c}`") for c in requests.columns],
                    merge_layers(F.col("_lw"), F.col("_ld"), F.col("_lh")).alias("_all"))


def _pv_lookup(entries: Column, name: str, target: str = "pv_production") -> Column:
    """Value of one normalised history key (F6) from the coerced map entries, without
    building the whole map: the last entry among ``lag_k`` / ``<target>_lag_k`` wins, like a
    dict update; pv_change_1h derives from lags 1 and 2."""
    prefix = f"{target}_lag_"
    if name == "pv_change_1h":
        l1, l2 = _pv_lookup(entries, prefix + "1", target), _pv_lookup(entries, prefix + "2", target)
        return F.abs(l1 - l2) + 1
    if not name.startswith(prefix):
        return F.lit(None).cast("double")
    short = "lag_" + name[len(prefix):]
    hits = F.filter(entries, lambda e: (e["key"] == F.lit(name)) | (e["key"] == F.lit(short)))
    return F.try_element_at(hits, F.lit(-1))["value"]


def build_features(requests: DataFrame, feature_columns: Sequence[str], weather: Column | None = None,
                   recent_pv: Column | None = None, time_col: str = "target_time",
                   lat: str | None = "latitude", lon: str | None = "longitude",
                   solar_time_col: str | None = None) -> DataFrame:
    """H1/H2: one row per request with the model's feature columns in order.

    Layers (later wins): weather < calendar/solar < PV history (F6), i.e. per feature
    ``coalesce(history, deterministic, weather)`` (coerced layers hold no NULL values).
    Missing names are listed in ``missing`` (comma-separated, '' when complete) instead of
    raising, so one bad request does not fail the batch; ``valid`` marks complete rows."""
    empty = F.create_map().cast("map<string,double>")
    w = coerce_map(weather) if weather is not None else empty
    pv = F.map_entries(coerce_map(recent_pv) if recent_pv is not None else empty)
    # weather and history layers are projected once; deterministic values are plain columns
    det = deterministic_values(time_col, lat, lon, solar_time_col)
    d = requests.select("*", w.alias("_lw"), pv.alias("_lp"))
    vals = [F.coalesce(_pv_lookup(F.col("_lp"), c), det.get(c, F.lit(None).cast("double")), F.col("_lw")[c]).alias(c)
            for c in feature_columns]
    d = d.select(*[F.col(f"`{c}`") for c in requests.columns], *vals)
    missing = F.array_compact(F.array(*[F.when(F.col(f"`{c}`").isNull(), F.lit(c)) for c in feature_columns]))
    return d.withColumn("missing", F.concat_ws(",", missing)).withColumn("valid", F.col("missing") == "")
