"""Numeric helpers shared by operators and oracle queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def r6(c: Column | str) -> Column:
    """Round half up at 6 decimals as floor(x*1e6 + 0.5)/1e6.

    Written this way (not ``round``) so that Spark and the DuckDB oracle, both on IEEE
    doubles, produce bit-identical results.  From 9e12 on the scaled value has no long (and
    a double hardly six decimals), so such a value stays as it is.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.abs(c) < F.lit(9e12), F.floor(c * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)).otherwise(c)


def nan_to_null(c: Column | str) -> Column:
    """NaN -> NULL (ingestion rule: only NULL marks a missing value downstream)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)
