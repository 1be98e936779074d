"""A measurement store (A4, B10): a table partitioned by date, bucketed by series and sorted by time.

Rows of a series lie in one bucket of every date.  Work by series (lags, joins with another store of
the same buckets) needs no shuffle, and a range of dates reads its own folders only.  The table is an
external one: its files lie under a path that the cluster shares, its name in the session's catalog.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BUCKETS = 32


def _q(c: str):
    return F.col(f"`{c}`")


def save_store(df: DataFrame, path: str, keys: Sequence[str], time_col: str = "time", buckets: int = BUCKETS,
               table: str | None = None, date_col: str = "date") -> str:
    """Write ``df`` as a store and return its table name.  ``date`` is added where it is missing; one
    file per date and bucket."""
    table = table or f"store_{uuid.uuid4().hex}"
    if date_col not in df.columns:
        df = df.withColumn(date_col, F.to_date(_q(time_col)))
    (df.repartition(buckets, *[_q(k) for k in keys]).sortWithinPartitions(_q(date_col), *[_q(k) for k in keys], _q(time_col)).write
     .mode("overwrite").format("parquet").partitionBy(date_col).bucketBy(buckets, *keys).sortBy(*keys, time_col)
     .option("path", path).saveAsTable(table))
    return table


def read_store(spark: SparkSession, table: str, start=None, end=None, date_col: str = "date") -> DataFrame:
    """The rows of dates from ``start`` (included) to ``end`` (left out); either may be missing."""
    df = spark.table(table)
    if start is not None:
        df = df.where(_q(date_col) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(_q(date_col) < F.lit(end).cast("date"))
    return df


def store_lags(stored: DataFrame, columns: Sequence[str], lags: Sequence[int], keys: Sequence[str], time_col: str = "time") -> DataFrame:
    """E1 on a store: ``<col>_lag_k``, the k-th previous row of the series.  A window by the bucketing keys:
    no row is shuffled.  A task holds the series of a bucket, so it is meant for many series, each of them
    short (hourly data: 8,760 rows a year); ``series.add_lags`` cuts long ones into blocks."""
    w = Window.partitionBy(*[_q(k) for k in keys]).orderBy(_q(time_col))
    return stored.select("*", *[F.lag(_q(c), k).over(w).alias(f"{c}_lag_{k}") for c in columns for k in lags])
