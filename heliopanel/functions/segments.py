"""Segment labels for error analysis (F8, F9) and radiation bins — column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (chosen thresholds, see SURVEY "[choice] thresholds"):
CLEAR_LIKE_MIN_RATIO = 0.8
PARTLY_CLOUDY_MIN_RATIO = 0.4
NIGHT_BELOW_ELEVATION = 2.0
RAMP_MAX_ELEVATION = 10.0
MIDDAY_MIN_ELEVATION = 15.0
RADIATION_EDGES = [0.0, 50.0, 200.0, 400.0, 600.0]


def _c(c) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def clear_sky_ratio(global_rad="global_rad:W", clear_sky="clear_sky_rad:W") -> Column:
    return F.try_divide(_c(global_rad).cast("double"), _c(clear_sky).cast("double"))


def weather_state(global_rad="global_rad:W", clear_sky="clear_sky_rad:W",
                  clear_min: float = CLEAR_LIKE_MIN_RATIO, partly_min: float = PARTLY_CLOUDY_MIN_RATIO) -> Column:
    """F8: clear_like / partly_cloudy_like / cloudy_like by global / clear-sky ratio."""
    r = clear_sky_ratio(global_rad, clear_sky)
    return (F.when(r.isNull(), "unknown").when(r >= clear_min, "clear_like")
             .when(r >= partly_min, "partly_cloudy_like").otherwise("cloudy_like"))


def radiation_bin(global_rad="global_rad:W", edges: Sequence[float] = RADIATION_EDGES) -> Column:
    """Left-closed bins over the edges, open top; below the first edge or NULL -> unknown."""
    x = _c(global_rad)
    expr = F.when(x.isNull() | (x < edges[0]), "unknown")
    for lo, hi in zip(edges[:-1], edges[1:]):
        expr = expr.when(x < hi, f"[{lo:g},{hi:g})")
    return expr.otherwise(f"[{edges[-1]:g},inf)")


def ramp_phase(elevation: Column, prev_elevation: Column) -> Column:
    """night / sunrise_ramp_up / sunset_ramp_down / midday_high_sun / daylight_other."""
    e, p = elevation, prev_elevation
    low = (e >= NIGHT_BELOW_ELEVATION) & (e <= RAMP_MAX_ELEVATION)
    return (F.when(e.isNull(), "unknown").when(e < NIGHT_BELOW_ELEVATION, "night")
             .when(e >= MIDDAY_MIN_ELEVATION, "midday_high_sun")
             .when(low & (e > p), "sunrise_ramp_up").when(low & (e < p), "sunset_ramp_down")
             .otherwise("daylight_other"))
