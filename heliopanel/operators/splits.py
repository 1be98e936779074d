"""Row-position splits and cross-validation folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .series import join_small, row_index


def tail_split(df: DataFrame, test_size: float = 0.2, keys: Sequence[str] = (), time_col: str = "time",
               split_col: str = "split", tiebreak: Sequence[str] = ()) -> DataFrame:
    """First int(n * (1 - test_size)) rows of each series are train, the rest test.

    n per series comes from a small count table (one row per key) joined back."""
    keys = list(keys)
    d = row_index(df, keys, time_col, "row_idx", tiebreak)
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    d = join_small(d, n, keys)
    cut = F.floor(F.col("_n") * (1 - test_size)).cast("long")
    return d.withColumn(split_col, F.when(F.col("row_idx") < cut, "train").otherwise("test")).drop("_n")


def ts_folds(df: DataFrame, n_splits: int = 5, keys: Sequence[str] = (), time_col: str = "time",
             tiebreak: Sequence[str] = ()) -> DataFrame:
    """Expanding-window folds (TimeSeriesSplit). Test size = n // (n_splits + 1); the
    last n_splits blocks are test blocks; fold i trains on every row before its block.

    Adds ``row_idx`` and ``test_fold`` (0-based fold whose test block holds the row, NULL for
    rows that are only ever training rows).  Train rows of fold i: ``row_idx < start_i``.
    """
    keys = list(keys)
    d = row_index(df, keys, time_col, "row_idx", tiebreak)
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    d = join_small(d, n, keys)
    size = F.floor(F.col("_n") / (n_splits + 1)).cast("long")
    first = F.col("_n") - size * n_splits
    fold = F.when((F.col("row_idx") >= first) & (size > 0),
                  F.floor((F.col("row_idx") - first) / size).cast("int"))
    return d.withColumn("test_fold", fold).withColumn("fold_size", size).withColumn(
        "first_test_idx", first).drop("_n")


def fold_pairs(folds: DataFrame, n_splits: int) -> DataFrame:
    """Expand ts_folds output to (fold, role) rows: each row appears as 'test' in its own
    fold and as 'train' in every later fold.  Output grows by at most n_splits x."""
    start_of = lambda i: F.col("first_test_idx") + F.col("fold_size") * i
    roles = F.array(*[
        F.when(F.col("row_idx") < start_of(i), F.struct(F.lit(i).alias("fold"), F.lit("train").alias("role")))
         .when(F.col("test_fold") == i, F.struct(F.lit(i).alias("fold"), F.lit("test").alias("role")))
        for i in range(n_splits)])
    return (folds.withColumn("_r", F.explode(F.filter(roles, lambda x: x.isNotNull())))
                 .withColumn("fold", F.col("_r.fold")).withColumn("role", F.col("_r.role")).drop("_r"))


def fold_marks(df: DataFrame, n_splits: int = 5, strategy: str = "timeseries", keys: Sequence[str] = (),
               time_col: str = "time", tiebreak: Sequence[str] = (), seed: int = 42) -> DataFrame:
    """Both kinds of folds without copying a row: ``test_fold`` (the fold that the row tests, or NULL)
    and ``trains`` (bit f set if the row trains fold f; at most 31 folds)."""
    if strategy == "kfold":
        d = kfold(df, n_splits, seed, keys).withColumnRenamed("fold", "test_fold")
        return d.withColumn("trains", F.expr(f"{(1 << n_splits) - 1} - shiftleft(1, test_fold)"))
    if strategy != "timeseries":
        raise ValueError("strategy must be 'timeseries' or 'kfold'")
    d = ts_folds(df, n_splits, keys, time_col, tiebreak)
    trains = sum((F.when(F.col("row_idx") < F.col("first_test_idx") + F.col("fold_size") * f, 1 << f).otherwise(0)
                  for f in range(n_splits)), F.lit(0))
    return d.withColumn("trains", trains).drop("row_idx", "fold_size", "first_test_idx")


def kfold(df: DataFrame, n_splits: int = 5, seed: int = 42, keys: Sequence[str] = (),
          id_cols: Sequence[str] = ()) -> DataFrame:
    """Shuffled k-fold.  Rows are ordered by a seeded hash of their identity inside their series, by
    sampled ranges of the hash (``series.in_ranges``), and fold = position mod k: sizes differ by at most
    one, as KFold's do, at any number of rows.  Membership differs from numpy's permutation."""
    keys = list(keys)
    id_cols = list(id_cols) or [c for c in df.columns if c not in keys]   # a row's identity
    d = df.withColumn("_h", F.xxhash64(*[F.col(f"`{c}`") for c in id_cols], F.lit(seed)))
    d = row_index(d, keys, "_h", "_hrank", tiebreak=id_cols, bucket="range")
    return d.withColumn("fold", (F.col("_hrank") % n_splits).cast("int")).drop("_h", "_hrank")
