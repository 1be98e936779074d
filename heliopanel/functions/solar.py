"""Solar elevation (F3) as pure column maths — no UDF, codegen'd, and reproducible in SQL.

Input timestamps are taken as UTC wall clock (TIMESTAMP_NTZ, session zone UTC).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# NOAA general solar position series coefficients.
DECLINATION_COEFFS = [0.006918, -0.399912, 0.070257, -0.006758, 0.000907, -0.002697, 0.00148]
EQUATION_OF_TIME_COEFFS = [0.000075, 0.001868, -0.032077, -0.014615, -0.040849]
EQUATION_OF_TIME_SCALE = 229.18
MINUTES_PER_DAY = 1440.0


def _c(c) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def solar_elevation(ts, latitude, longitude) -> Column:
    """Elevation of the sun in degrees at ``ts`` for the given latitude/longitude (degrees)."""
    t = _c(ts)
    lat = _c(latitude).cast("double") if not isinstance(latitude, (int, float)) else F.lit(float(latitude))
    lon = _c(longitude).cast("double") if not isinstance(longitude, (int, float)) else F.lit(float(longitude))
    doy = F.dayofyear(t).cast("double")
    fh = F.hour(t).cast("double") + F.minute(t).cast("double") / 60 + F.second(t).cast("double") / 3600
    g = F.lit(2 * math.pi / 365) * (doy - 1 + (fh - 12) / 24)
    d = DECLINATION_COEFFS
    decl = (F.lit(d[0]) + F.lit(d[1]) * F.cos(g) + F.lit(d[2]) * F.sin(g) + F.lit(d[3]) * F.cos(2 * g)
            + F.lit(d[4]) * F.sin(2 * g) + F.lit(d[5]) * F.cos(3 * g) + F.lit(d[6]) * F.sin(3 * g))
    e = EQUATION_OF_TIME_COEFFS
    eot = F.lit(EQUATION_OF_TIME_SCALE) * (F.lit(e[0]) + F.lit(e[1]) * F.cos(g) + F.lit(e[2]) * F.sin(g)
                                            + F.lit(e[3]) * F.cos(2 * g) + F.lit(e[4]) * F.sin(2 * g))
    # Python's % is non-negative for a positive modulus; Spark's % keeps the sign -> pmod.
    tsm = F.pmod(fh * 60 + eot + 4 * lon, F.lit(MINUTES_PER_DAY))
    ha = F.radians(tsm / 4 - 180)
    latr = F.radians(lat)
    return F.degrees(F.asin(F.sin(latr) * F.sin(decl) + F.cos(latr) * F.cos(decl) * F.cos(ha)))


def solar_elevation_sql(ts: str, lat: str, lon: str) -> str:
    """DuckDB twin of ``solar_elevation`` (same operation order)."""
    d, e = DECLINATION_COEFFS, EQUATION_OF_TIME_COEFFS
    fh = f"(CAST(hour({ts}) AS DOUBLE) + CAST(minute({ts}) AS DOUBLE) / 60 + CAST(second({ts}) AS DOUBLE) / 3600)"
    g = f"({2 * math.pi / 365!r} * (CAST(dayofyear({ts}) AS DOUBLE) - 1 + ({fh} - 12) / 24))"
    decl = (f"({d[0]!r} + {d[1]!r} * cos({g}) + {d[2]!r} * sin({g}) + {d[3]!r} * cos(2 * {g}) + {d[4]!r} * sin(2 * {g})"
            f" + {d[5]!r} * cos(3 * {g}) + {d[6]!r} * sin(3 * {g}))")
    eot = (f"({EQUATION_OF_TIME_SCALE!r} * ({e[0]!r} + {e[1]!r} * cos({g}) + {e[2]!r} * sin({g})"
           f" + {e[3]!r} * cos(2 * {g}) + {e[4]!r} * sin(2 * {g})))")
    raw = f"({fh} * 60 + {eot} + 4 * {lon})"
    tsm = f"((({raw}) % 1440.0 + 1440.0) % 1440.0)"
    ha = f"radians({tsm} / 4 - 180)"
    latr = f"radians({lat})"
    return f"degrees(asin(sin({latr}) * sin({decl}) + cos({latr}) * cos({decl}) * cos({ha})))"
