"""Map-valued request fields (F4, F5, F6, C3) handled with higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Provider hourly variables, in the provider's order.
PROVIDER_HOURLY_VARIABLES = ["temperature_2m", "relative_humidity_2m", "cloud_cover", "shortwave_radiation",
                             "direct_radiation", "diffuse_radiation", "terrestrial_radiation", "sunshine_duration"]

# Project column <- provider field (multiplier applied to the provider value).
PROVIDER_TO_PROJECT = [
    ("temp", "temperature_2m", 1.0),
    ("relative_humidity_2m:p", "relative_humidity_2m", 1.0),
    ("relative_humidity_10m:p", "relative_humidity_2m", 1.0),
    ("total_cloud_cover:p", "cloud_cover", 1.0),
    ("effective_cloud_cover:p", "cloud_cover", 1.0),
    ("global_rad:W", "shortwave_radiation", 1.0),
    ("global_rad_1h:Wh", "shortwave_radiation", 1.0),
    ("direct_rad:W", "direct_radiation", 1.0),
    ("direct_rad_1h:Wh", "direct_radiation", 1.0),
    ("diffuse_rad:W", "diffuse_radiation", 1.0),
    ("diffuse_rad_1h:Wh", "diffuse_radiation", 1.0),
    ("clear_sky_rad:W", "terrestrial_radiation", 1.0),
    ("clear_sky_energy_1h:J", "terrestrial_radiation", 3600.0),
    ("sunshine_duration_1h:min", "sunshine_duration", 1 / 60),
]


def _c(c) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def weather_columns(prefix: str = "") -> list[Column]:
    """the 14 project columns from the 8 provider columns (NULL stays NULL)."""
    out = []
    for name, src, mult in PROVIDER_TO_PROJECT:
        v = _c(prefix + src).cast("double")
        if mult == 1.0:
            out.append(v.alias(name))
        elif mult == 3600.0:
            out.append((v * 3600).alias(name))
        else:
            out.append((v / 60).alias(name))
    return out


def weather_map(prefix: str = "") -> Column:
    """F4 as a map; NULL inputs drop their keys."""
    cols = weather_columns(prefix)
    m = F.create_map(*[x for (name, _, _), c in zip(PROVIDER_TO_PROJECT, cols) for x in (F.lit(name), c)])
    return coerce_map(m)


def coerce_map(m: Column) -> Column:
    """values cast to double, entries with NULL values dropped."""
    return F.map_filter(F.transform_values(m, lambda k, v: v.cast("double")), lambda k, v: v.isNotNull())


def normalise_lag_keys(m: Column, target: str = "pv_production") -> Column:
    """``lag_k`` -> ``<target>_lag_k``; already-prefixed keys kept; others dropped;
    then ``pv_change_1h = |lag_1 - lag_2| + 1`` when both lags exist.

    One ``aggregate`` pass over the entries (later spellings of a key win, like a dict
    update) whose finish step appends pv_change_1h — the map expression is evaluated once."""
    prefix = f"{target}_lag_"
    kept = F.map_filter(coerce_map(m), lambda k, v: k.startswith(prefix) | k.startswith("lag_"))
    renamed = F.transform(F.map_entries(kept), lambda e: F.struct(
        F.when(e["key"].startswith("lag_"), F.concat(F.lit(prefix), F.substring(e["key"], 5, 1 << 20)))
         .otherwise(e["key"]).alias("key"),
        e["value"].alias("value")))
    entry_t = "struct<key:string,value:double>"
    init = F.struct(F.array().cast(f"array<{entry_t}>").alias("es"),
                    F.lit(None).cast("double").alias("l1"), F.lit(None).cast("double").alias("l2"))

    def step(acc, e):
        es = F.concat(F.filter(acc["es"], lambda x: x["key"] != e["key"]), F.array(e))
        l1 = F.when(e["key"] == F.lit(prefix + "1"), e["value"]).otherwise(acc["l1"])
        l2 = F.when(e["key"] == F.lit(prefix + "2"), e["value"]).otherwise(acc["l2"])
        return F.struct(es.alias("es"), l1.alias("l1"), l2.alias("l2"))

    def finish(acc):
        change = F.when(acc["l1"].isNotNull() & acc["l2"].isNotNull(),
                        F.array(F.struct(F.lit("pv_change_1h").alias("key"),
                                         (F.abs(acc["l1"] - acc["l2"]) + 1).alias("value"))))
        return F.map_from_entries(F.concat(acc["es"], F.coalesce(change, F.array().cast(f"array<{entry_t}>"))))

    return F.aggregate(renamed, init, step, finish)


def merge_layers(weather: Column, deterministic: Column, history: Column) -> Column:
    """One map where later layers win: weather < deterministic < PV history.

    Keys shadowed by a later layer are filtered out first, so no duplicate keys arise.  The
    layers are bound to a lambda variable, so each is evaluated once however often the
    filters look it up (the optimiser would otherwise merge their expressions back in)."""
    layers = F.array(F.struct(weather.alias("w"), deterministic.alias("d"), history.alias("h")))

    def merged(x: Column) -> Column:
        w = F.map_filter(x["w"], lambda k, v: ~F.map_contains_key(x["d"], k) & ~F.map_contains_key(x["h"], k))
        d = F.map_filter(x["d"], lambda k, v: ~F.map_contains_key(x["h"], k))
        return F.map_concat(w, d, x["h"])

    return F.element_at(F.transform(layers, merged), 1)
