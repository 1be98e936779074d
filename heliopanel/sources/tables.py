"""Scans of the input tables (parquet by default, CSV on request).

Column pruning and filter pushdown are left to Catalyst: every reader returns a lazy
DataFrame and callers select what they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def load_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             sep: str = ",", encoding: str = "utf-8", header: bool = True) -> DataFrame:
    """CSV scan (A1). A declared schema avoids a second pass for inference; a missing
    path raises at plan time (``PATH_NOT_FOUND``), like the reference's FileNotFoundError."""
    reader = spark.read.options(header=str(header).lower(), sep=sep, encoding=encoding,
                                mode="FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def load_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
