"""Window operators over ordered series (E1-E9) without single-task windows.

A series is identified by ``keys`` (possibly none) and ordered by ``time_col``.  Windowing
by the keys alone would put a whole series — or, with no keys, the whole table — into one
task.  Instead every operator here windows over bounded groups:

* ``row_index`` (E8): per-(series, day) counts form a small table; an exclusive prefix sum
  over it gives each day its offset; ``row_number`` inside (series, day) adds the rest.
* positional operators (lags, differences): rows get ``block = idx div block_rows``; the
  last ``max_back`` rows of each block are copied into the next block (halo), the window
  runs over (series, block), halo rows are dropped afterwards.  Exact for any lag
  <= ``max_back`` <= ``block_rows``.
* fills and interpolation: windows over (series, day) plus, per (series, day), the first
  and last non-null value carried across days through the small day table.

Hourly data have at most a few dozen rows of a series in a day.  Where days are dense, times are
missing or the order is not a time at all, ``bucket='range'`` takes ranges of (series, order) in
place of days (``in_ranges``): sampled splitters make them even, whatever the values, and rows of
equal order are divided as well.  The sorted rows are written once, so a position is the range's
offset plus the row's place in it, without a window.

Small per-day tables are joined back without a broadcast hint; AQE broadcasts them when
their measured size is below the threshold and falls back to a shuffle join otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BLOCK_ROWS = 8192
_FAR = "9999-12-31 00:00:00"


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _bucket(time_col: str, unit: str = "day") -> Column:
    """Day bucket of the time column; null times go to a bucket after all others."""
    return F.coalesce(F.date_trunc(unit, _q(time_col)).cast("timestamp_ntz"),
                      F.lit(_FAR).cast("timestamp_ntz"))


def _order(time_col: str, tiebreak: Sequence[str] = ()) -> list[Column]:
    return [_q(time_col).asc_nulls_last(), *[_q(c).asc_nulls_last() for c in tiebreak]]


def join_small(big: DataFrame, small: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join on null-safe equality of ``on``; keeps ``big``'s key columns."""
    on = list(on)
    if not on:
        # keyless: the small side is a global aggregate (one row, a proven size), so it is
        # broadcast explicitly — a shuffle join on a constant key would put every row in
        # one partition.
        return (big.withColumn("__one", F.lit(0))
                   .join(F.broadcast(small.withColumn("__one", F.lit(0))), "__one").drop("__one"))
    r = small.select(*[_q(c).alias(f"__r_{c}") for c in on],
                     *[_q(c) for c in small.columns if c not in on])
    cond = [big[f"`{c}`"].eqNullSafe(r[f"`__r_{c}`"]) for c in on]
    return big.join(r, cond).drop(*[f"__r_{c}" for c in on])


def in_ranges(df: DataFrame, keys: Sequence[str], order_col: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The rows sorted by (keys, order, tiebreak) in ranges of like size, written once: ``_bkt``, the range, and
    ``_ord``, which ascends in that order (by one from row to row of a range).  Null orders come last."""
    from ..session import stage
    d = df.withColumn("_tie", F.monotonically_increasing_id())          # equal rows fall into several ranges too
    order = [*[_q(k) for k in keys], *_order(order_col, tiebreak), F.col("_tie")]
    d = d.repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie")
    return stage(d.withColumn("_ord", F.monotonically_increasing_id()).withColumn("_bkt", F.shiftright("_ord", 33)), "ranges")


def row_index(df: DataFrame, keys: Sequence[str] = (), time_col: str = "time",
              idx_col: str = "row_idx", tiebreak: Sequence[str] = (),
              keep_bucket: bool = False, bucket: str = "day") -> DataFrame:
    """0-based position of each row inside its series, in time order.

    Two passes, no single-partition window: (1) counts per (keys, day) — partial aggregation,
    output keys x days — and an exclusive running sum per series over that small table;
    (2) ``row_number`` within (keys, day), plus the day's offset.
    ``bucket`` is the date_trunc unit: 'day' for hourly data, 'month' for daily data (the
    count table then has ~30x fewer rows than the data); or 'range' (see ``in_ranges``).
    """
    keys = list(keys)
    wk = Window.partitionBy(*keys).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    if bucket == "range":
        d = in_ranges(df, keys, time_col, tiebreak)
        counts = d.groupBy(*keys, "_bkt").agg(F.count(F.lit(1)).alias("_n"), F.min("_ord").alias("_first"))
        offsets = counts.select(*keys, "_bkt", (F.coalesce(F.sum("_n").over(wk), F.lit(0)) - F.col("_first")).alias("_off"))
        d = join_small(d, offsets, keys + ["_bkt"]).withColumn(idx_col, F.col("_off") + F.col("_ord")).drop("_off", "_ord")
        return d if keep_bucket else d.drop("_bkt")
    d = df.withColumn("_bkt", _bucket(time_col, bucket))
    counts = d.groupBy(*keys, "_bkt").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(*keys, "_bkt", F.coalesce(F.sum("_n").over(wk), F.lit(0)).alias("_off"))
    d = join_small(d, offsets, keys + ["_bkt"])
    w = Window.partitionBy(*keys, "_bkt").orderBy(*_order(time_col, tiebreak))
    d = d.withColumn(idx_col, (F.col("_off") + F.row_number().over(w) - 1).cast("long")).drop("_off")
    return d if keep_bucket else d.drop("_bkt")


def positional(df: DataFrame, build: Callable[[Window], list[Column]], max_back: int,
               keys: Sequence[str] = (), time_col: str = "time", tiebreak: Sequence[str] = (),
               block_rows: int = DEFAULT_BLOCK_ROWS, idx_col: str | None = None,
               bucket: str = "day") -> DataFrame:
    """Evaluate window expressions that look at most ``max_back`` rows back, per series.

    ``build(w)`` returns columns written against ``w`` (ordered by position).  All of them
    share one Window node and one shuffle on (keys, block).
    """
    if max_back < 0 or max_back > block_rows:
        raise ValueError("need 0 <= max_back <= block_rows")
    keys = list(keys)
    cols = list(df.columns)
    idx = idx_col or "_idx"
    d = row_index(df, keys, time_col, idx, tiebreak, bucket=bucket)
    home = F.floor(F.col(idx) / F.lit(block_rows))
    in_halo = (F.col(idx) % F.lit(block_rows)) >= F.lit(block_rows - max_back)
    blocks = F.when(in_halo & F.lit(max_back > 0), F.array(home, home + 1)).otherwise(F.array(home))
    d = d.withColumn("_blk", F.explode(blocks))
    w = Window.partitionBy(*keys, "_blk").orderBy(idx)
    keep = [_q(c) for c in cols] + ([F.col(idx)] if idx_col else [])
    out = d.select(*keep, *build(w), (F.col("_blk") == home).alias("_own"))
    return out.where("_own").drop("_own")


def lag_names(col: str, lags: Sequence[int]) -> list[str]:
    return [f"{col}_lag_{k}" for k in lags]


def time_lags(df: DataFrame, columns: Sequence[str], lags: Sequence[int], keys: Sequence[str] = (),
              time_col: str = "time", step_seconds: int = 3600) -> DataFrame:
    """E1, ``mode='time'``: the value exactly k steps earlier (NULL when that time is absent),
    so dropped incomplete days cannot shift a lag.  Windows run over (series, day) with a
    time halo: each row is also copied into the next ceil(max lag / 1 day) days; a numeric
    RANGE frame on epoch seconds picks the row at t - k*step.  Duplicated timestamps of a
    series resolve to their largest value."""
    keys = list(keys)
    cols = list(df.columns)
    reach = max(lags) * step_seconds
    span = -(-reach // 86400)
    ts = F.unix_seconds(_q(time_col).cast("timestamp"))
    d = df.withColumn("_ts", ts).withColumn("_day", F.floor(F.col("_ts") / 86400))
    d = d.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(span)))).withColumn(
        "_home", F.col("_day") + F.col("_copy"))
    w = Window.partitionBy(*keys, "_home").orderBy("_ts")
    out = d.select(*[_q(c) for c in cols], "_copy",
                   *[F.max(_q(c)).over(w.rangeBetween(-k * step_seconds, -k * step_seconds)).alias(f"{c}_lag_{k}")
                     for c in columns for k in lags])
    return out.where(F.col("_copy") == 0).drop("_copy")


def add_lags(df: DataFrame, columns: Sequence[str], n_lags: int = 24, keys: Sequence[str] = (),
             time_col: str = "time", block_rows: int = DEFAULT_BLOCK_ROWS, mode: str = "rows",
             step_seconds: int = 3600) -> DataFrame:
    """``<col>_lag_k`` for k = 1..n_lags within each series.

    mode='rows' (default, like a positional shift): the k-th previous row;
    mode='time': the row exactly k steps earlier (see ``time_lags``)."""
    lags = list(range(1, n_lags + 1))
    if mode == "time":
        return time_lags(df, columns, lags, keys, time_col, step_seconds)
    if mode != "rows":
        raise ValueError("mode must be 'rows' or 'time'")
    return positional(
        df, lambda w: [F.lag(_q(c), k).over(w).alias(f"{c}_lag_{k}") for c in columns for k in lags],
        n_lags, keys, time_col, block_rows=block_rows)


def radiation_features(df: DataFrame, keys: Sequence[str] = (), time_col: str = "time",
                       radiation_col: str = "global_rad:W", target_col: str = "pv_production",
                       elevation_col: str = "sun_elevation:d", n_lags: int = 0,
                       block_rows: int = DEFAULT_BLOCK_ROWS,
                       extra_lags: Sequence[tuple[str, str, int]] = ()) -> DataFrame:
    """E2-E4 + F2 (+ optional E1 target lags) in one Window node.

    trend = x - x[-1]; acceleration = trend - trend[-1]; pv_change_1h = |y[-1] - y[-2]| + 1
    (leak-free: never uses the current target); is_daylight = elevation >= 2.
    """
    from ..functions.calendar import is_daylight

    def build(w: Window) -> list[Column]:
        out: list[Column] = []
        if radiation_col in df.columns:
            x = _q(radiation_col)
            x1, x2 = F.lag(x, 1).over(w), F.lag(x, 2).over(w)
            out += [(x - x1).alias("global_rad_trend_1h"),
                    ((x - x1) - (x1 - x2)).alias("global_rad_acceleration_1h")]
        if target_col in df.columns:
            y = _q(target_col)
            out.append((F.abs(F.lag(y, 1).over(w) - F.lag(y, 2).over(w)) + 1).alias("pv_change_1h"))
            out += [F.lag(y, k).over(w).alias(f"{target_col}_lag_{k}") for k in range(1, n_lags + 1)]
        out += [F.lag(_q(col), k).over(w).alias(name) for name, col, k in extra_lags]
        return out

    reach = max([2, n_lags] + [k for _, _, k in extra_lags])
    out = positional(df, build, reach, keys, time_col, block_rows=block_rows)
    if elevation_col in df.columns:
        out = out.withColumn("is_daylight", is_daylight(elevation_col))
    return out


def _day_carries(d: DataFrame, keys: list[str], time_col: str, columns: Sequence[str],
                 order_col: str) -> DataFrame:
    """Per (keys, day): previous days' last non-null and later days' first non-null value
    (as structs of position and value), from a small table windowed per series."""
    aggs = []
    for i, c in enumerate(columns):
        has = _q(c).isNotNull()
        pair = F.struct(F.col(order_col).alias("i"), _q(c).alias("v"))
        aggs += [F.max_by(pair, F.when(has, F.col(order_col))).alias(f"_l{i}"),
                 F.min_by(pair, F.when(has, F.col(order_col))).alias(f"_f{i}")]
    small = d.groupBy(*keys, "_bkt").agg(*aggs)
    wk = Window.partitionBy(*keys).orderBy("_bkt")
    before = wk.rowsBetween(Window.unboundedPreceding, -1)
    # looking ahead is looking back in the other order: frames that grow are linear work, those that shrink are not
    after = Window.partitionBy(*keys).orderBy(F.col("_bkt").desc()).rowsBetween(Window.unboundedPreceding, -1)
    sel = []
    for i, _ in enumerate(columns):
        # a struct is null only when the day has no non-null value (max_by over no rows)
        sel += [F.last(F.col(f"_l{i}"), True).over(before).alias(f"_pl{i}"),
                F.last(F.col(f"_f{i}"), True).over(after).alias(f"_nf{i}")]
    return small.select(*keys, "_bkt", *sel)


def fill_forward_backward(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (),
                          time_col: str = "time", backward: bool = True, bucket: str = "day",
                          tiebreak: Sequence[str] = ()) -> DataFrame:
    """E5: forward fill then (unless ``backward=False``, the leak-safe variant) backward fill.
    ``bucket``: 'day' or 'range' (then rows of equal times are ordered by ``tiebreak``)."""
    keys = list(keys)
    columns = [c for c in columns if c not in keys and c != time_col]
    if bucket == "range":
        d, inside, back = in_ranges(df, keys, time_col, tiebreak), [F.col("_ord")], [F.col("_ord").desc()]
    else:
        d = df.withColumn("_bkt", _bucket(time_col)).withColumn(
            "_ord", F.coalesce(_q(time_col), F.lit(_FAR).cast("timestamp_ntz")))
        inside, back = _order(time_col), [_q(time_col).desc_nulls_first()]
    carries = _day_carries(d, keys, time_col, columns, "_ord")
    d = join_small(d, carries, keys + ["_bkt"])
    upto = Window.partitionBy(*keys, "_bkt").orderBy(*inside).rowsBetween(Window.unboundedPreceding, 0)
    onward = Window.partitionBy(*keys, "_bkt").orderBy(*back).rowsBetween(Window.unboundedPreceding, 0)
    sel = []
    for i, c in enumerate(columns):
        ff = F.coalesce(F.last(_q(c), True).over(upto), F.col(f"_pl{i}.v"))
        if backward:
            ff = F.coalesce(ff, F.last(_q(c), True).over(onward), F.col(f"_nf{i}.v"))
        sel.append(ff.alias(c))
    return d.select(*[_q(c) if c not in columns else sel[columns.index(c)] for c in df.columns])


def interpolate_linear(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (),
                       time_col: str = "time", bucket: str = "day", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Positional linear interpolation (ignores time spacing, like pandas ``linear``).

    Leading nulls stay null, trailing nulls repeat the last value.  ``bucket`` as for fills.
    """
    keys = list(keys)
    columns = [c for c in columns if c not in keys and c != time_col]
    d = row_index(df, keys, time_col, "_idx", tiebreak, keep_bucket=True, bucket=bucket)
    carries = _day_carries(d, keys, time_col, columns, "_idx")
    d = join_small(d, carries, keys + ["_bkt"])
    upto = Window.partitionBy(*keys, "_bkt").orderBy("_idx").rowsBetween(Window.unboundedPreceding, 0)
    onward = Window.partitionBy(*keys, "_bkt").orderBy(F.col("_idx").desc()).rowsBetween(Window.unboundedPreceding, 0)
    sel = {}
    for i, c in enumerate(columns):
        pair = F.when(_q(c).isNotNull(), F.struct(F.col("_idx").alias("i"), _q(c).alias("v")))
        prev = F.coalesce(F.last(pair, True).over(upto), F.col(f"_pl{i}"))
        nxt = F.coalesce(F.last(pair, True).over(onward), F.col(f"_nf{i}"))
        slope = (nxt["v"] - prev["v"]) / (nxt["i"] - prev["i"]).cast("double")
        sel[c] = (F.when(_q(c).isNotNull(), _q(c))
                   .when(prev.isNull(), F.lit(None))
                   .when(nxt.isNull(), prev["v"])
                   .otherwise(slope * (F.col("_idx") - prev["i"]).cast("double") + prev["v"])).alias(c)
    return d.select(*[sel.get(c, _q(c)) for c in df.columns])


def handle_missing(df: DataFrame, strategy: str = "forward_fill", columns: Sequence[str] | None = None,
                   keys: Sequence[str] = (), time_col: str = "time", leak_safe: bool = False) -> DataFrame:
    """E5-E7 under one name. Unknown strategies raise (the reference silently ignores them)."""
    if columns is None:
        columns = [c for c in df.columns if c not in keys and c != time_col]
    if strategy == "forward_fill":
        return fill_forward_backward(df, columns, keys, time_col, backward=not leak_safe)
    if strategy == "interpolate":
        from .panel import numeric_columns
        num = set(numeric_columns(df))
        return interpolate_linear(df, [c for c in columns if c in num], keys, time_col)
    if strategy == "drop":
        return df.na.drop("any")
    raise ValueError(f"unknown missing-value strategy: {strategy}")


def top_k(df: DataFrame, k: int, order: Sequence[Column], group: Sequence[str] = (),
          rank_col: str = "rank") -> DataFrame:
    """First k rows per group under ``order`` (add a tie-breaker to ``order``).

    Spark plans WindowGroupLimit (partial) before the shuffle, so each group ships <= k rows
    per input partition.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
