"""Calendar and daylight scalars (F1, F2) — plain column expressions, codegen-friendly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calendar columns the reference excludes from numeric feature discovery
# (`day_of_year` is deliberately not in this list).
CALENDAR_BASE_FEATURES = ["hour", "day_of_week", "day_of_month", "month", "quarter", "year", "week_of_year"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def calendar_columns(time_col="time") -> list[Column]:
    """hour, day_of_week (Monday = 0), month, day_of_year of the timestamp's own clock."""
    t = _c(time_col)
    return [
        F.hour(t).alias("hour"),
        F.weekday(t).alias("day_of_week"),
        F.month(t).alias("month"),
        F.dayofyear(t).alias("day_of_year"),
    ]


def with_time_features(df, time_col: str = "time"):
    return df.select("*", *calendar_columns(time_col))


def is_daylight(elevation="sun_elevation:d", threshold: float = 2.0) -> Column:
    """1 when elevation >= threshold, else 0; a missing elevation counts as night."""
    return F.coalesce((_c(elevation) >= threshold).cast("int"), F.lit(0))
