"""Nearest-neighbour regression for every k, weighting and fold from one search.

Space is cut into boxes (cells) of about ``PART_ROWS`` training rows by medians of a sample.  Folds
scale features by their own training rows, so each fold has a metric of its own; cuts are along
single features and serve all of them, and a cell keeps the bounds of its rows for each fold.

1. A query looks at the nearest cell that holds ``k`` rows of its fold; the k-th distance found there
   bounds the true one.
2. It then looks at every other cell whose box is not farther than that.  Most have none or few, however
   many cells there are, so the work grows with the rows.
3. Of all rows seen, the k nearest (ties: smaller key) of its fold are its list.  Lists hold as
   many rows as the largest k asks for; smaller k and both weightings are read off them.

Inside a cell the same holds for leaves of ``LEAF_ROWS`` rows.  Of rows with equal features and folds only
the first k by key can be chosen; the rest are left out before anything is joined.  Queries of equal
features and fold have the same list: one of them asks, the others are given what was made of its list.  Work goes by (cell,
block of queries), so a popular cell's queries do not meet in one task.  Rows with a null feature take
no part, rows without a target are queries alone.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .models import param_grid

PIVOTS = 128                # sampled rows a cell, to lay the cells out
MOST_PIVOTS = 1 << 17
PART_ROWS = 1 << 15
QUERY_ROWS = 1 << 16
LEAF_ROWS = 256
TOLERANCE = 1e-9


def _matrix(batch, first: int, p: int) -> np.ndarray:
    return np.stack([batch.column(first + j).to_numpy(zero_copy_only=False) for j in range(p)], axis=1)


def _layout(sample: np.ndarray, cells: float, unit: np.ndarray, bounds: list):
    """(feature, cut, rows up to the cut, rows beyond it) down to cells, which are numbers; ``bounds`` counts them."""
    spread = np.ptp(sample, axis=0) / unit if len(sample) else np.zeros(len(unit))
    j = int(spread.argmax())
    if cells <= 1 or not spread[j] > 0:
        bounds.append(len(bounds))
        return bounds[-1]
    v = np.sort(sample[:, j])
    cut = v[(len(v) - 1) // 2]
    if cut == v[-1]:
        cut = v[np.searchsorted(v, cut) - 1]
    left = sample[:, j] <= cut
    return (j, float(cut), _layout(sample[left], cells * left.mean(), unit, bounds), _layout(sample[~left], cells * (~left).mean(), unit, bounds))


def _cells_of(x: np.ndarray, tree) -> np.ndarray:
    out, todo = np.zeros(len(x), np.int32), [(tree, np.arange(len(x)))]
    while todo:
        node, at = todo.pop()
        if isinstance(node, int):
            out[at] = node
        elif len(at):
            left = x[at, node[0]] <= node[1]
            todo += [(node[2], at[left]), (node[3], at[~left])]
    return out


def _with_cell(batches, tree, p: int):
    """Adds each row's cell; batches hold the features first."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_cells_of(_matrix(batch, 0, p), tree))], [*batch.schema.names, "cell"])


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of x from all rows of y."""
    total = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        d = x[:, j, None] - y[None, :, j]
        total += d * d
    return np.sqrt(total)


def gaps(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Distances of all rows of x from all boxes (inf from a box without rows: low inf, high -inf)."""
    total = np.zeros((len(x), len(low)))
    for j in range(x.shape[1]):
        d = np.maximum(np.maximum(low[None, :, j] - x[:, j, None], x[:, j, None] - high[None, :, j]), 0.0)
        total += d * d
    return np.sqrt(total)


def _reach(bound: np.ndarray) -> np.ndarray:
    return (bound * (1 + TOLERANCE) + TOLERANCE)[:, None]


def _leaves(x: np.ndarray, most: int) -> list[np.ndarray]:
    """The rows in boxes of at most ``most``, halved along the widest feature."""
    out, todo = [], [np.arange(len(x))]
    while todo:
        at = todo.pop()
        if len(at) <= most:
            out.append(at)
            continue
        j = int(np.ptp(x[at], axis=0).argmax())
        order = np.argpartition(x[at, j], len(at) // 2)
        todo += [at[order[:len(at) // 2]], at[order[len(at) // 2:]]]
    return out


def nearest(x: np.ndarray, key: np.ndarray, ask: np.ndarray, bound: np.ndarray, k: int):
    """(query, row, distance) of the k nearest rows of every query within its bound, queries together,
    nearest first (ties: smaller key)."""
    leaves = _leaves(x, max(LEAF_ROWS, 2 * k))
    low, high = (np.array([f(x[i], axis=0) for i in leaves]) for f in (np.min, np.max))
    parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for lo in range(0, len(ask), 4096):
        q, limit = ask[lo:lo + 4096], bound[lo:lo + 4096].copy()
        gap = gaps(q, low, high)
        seen = np.zeros(gap.shape, bool)
        found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        for upto in (1, 4, 16, len(leaves)):         # the nearest leaves first: they tell which others matter
            upto = min(upto, len(leaves))
            go = ~seen & (gap <= np.minimum(_reach(limit), np.partition(gap, upto - 1, axis=1)[:, upto - 1:upto]))
            seen |= go
            more = [found]
            for leaf in np.flatnonzero(go.any(axis=0)).tolist():
                m, rows = np.flatnonzero(go[:, leaf]), leaves[leaf]
                d = distances(q[m], x[rows])
                most = limit[m]
                if len(rows) > k:
                    most = np.minimum(most, np.partition(d, k - 1, axis=1)[:, k - 1])
                r, c = np.nonzero(d <= most[:, None])
                more.append((m[r], rows[c], d[r, c]))
            r, c, d = (np.concatenate(v) for v in zip(*more))
            order = np.lexsort((key[c], d, r))
            r, c, d = r[order], c[order], d[order]
            place = np.arange(len(r)) - np.searchsorted(r, r)
            full = place == k - 1
            limit[r[full]] = np.minimum(limit[r[full]], d[full])
            found = r[place < k], c[place < k], d[place < k]
        parts.append((found[0] + lo, *found[1:]))
    return tuple(np.concatenate(v) for v in zip(*parts))


def _first_cells(batches, boxes: dict, p: int, k: int):
    """Adds the nearest cell with k rows of the query's fold (if none has as many: with any); rows: features, query, fold."""
    for batch in batches:
        x, fold = _matrix(batch, 0, p), batch.column(p + 1).to_numpy()
        cells = np.full(len(x), -1, np.int32)
        for f in np.unique(fold).tolist():
            low, high, count, scale = boxes[f]
            enough = count >= min(k, count.max())
            if not count.max():
                continue
            for lo in range(0, len(x), 4096):
                at = lo + np.flatnonzero(fold[lo:lo + 4096] == f)
                gap = gaps(x[at] / scale, low, high)
                cells[at] = np.where(enough[None, :], gap, np.inf).argmin(axis=1)
        out = pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], [*batch.schema.names, "cell"])
        yield out.filter(pa.array(cells >= 0))


def _ranked(batches, boxes: dict, p: int, k: int):
    """The k nearest training rows of each query in a unit, and the other cells that it must look at.  Rows of a
    unit lie together, training rows first (kind 0): unit, kind, key, fold, trains, y, bound, features."""
    held, now = [], None

    def lists(values: np.ndarray, counts: np.ndarray):
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values))

    def settle():
        t = pa.Table.from_batches(held).combine_chunks()
        kind = t["kind"].to_numpy()
        base, ask = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
        x = np.stack([t[f"f{j}"].to_numpy() for j in range(p)], axis=1)
        key, y, fold, trains, bound = (t[c].to_numpy(zero_copy_only=False) for c in ("key", "y", "fold", "trains", "bound"))
        for f in np.unique(fold[ask]).tolist():
            low, high, count, scale = boxes[f]
            mine, asks = base[np.asarray(trains[base], np.int64) >> int(f) & 1 == 1], ask[fold[ask] == f]
            for lo in range(0, len(asks), QUERY_ROWS) if len(mine) else ():
                q = asks[lo:lo + QUERY_ROWS]
                first = bound[q] < 0                        # no bound yet: the query's first cell
                z = x[q] / scale
                r, c, d = nearest(x[mine] / scale, key[mine], z, np.where(first, np.inf, bound[q]), k)
                n = np.bincount(r, minlength=len(q))
                kth = np.full(len(q), np.inf)
                last = np.cumsum(n)[n >= k] - 1
                kth[n >= k] = d[last]
                others, cells = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for i in range(0, len(q), 4096):
                    far = (gaps(z[i:i + 4096], low, high) <= _reach(kth[i:i + 4096])) & (count > 0)[None, :] & first[i:i + 4096, None]
                    far[:, now[0]] = False
                    a, b = np.nonzero(far)
                    others.append(a + i)
                    cells.append(b)
                fars = np.bincount(np.concatenate(others), minlength=len(q))
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(x[q, j]) for j in range(p)], pa.array(key[q]), pa.array(np.full(len(q), int(f), np.int32)), pa.array(kth),
                     lists(np.concatenate(cells).astype(np.int32), fars), lists(key[mine[c]], n), lists(y[mine[c]], n), lists(d, n)],
                    [*(f"f{j}" for j in range(p)), "query", "fold", "bound", "far", "key", "y", "distance"])

    for batch in batches:
        if not batch.num_rows:
            continue
        unit = np.stack([batch.column(i).to_numpy() for i in range(2)], axis=1)
        edge = [0, *(np.flatnonzero((unit[1:] != unit[:-1]).any(axis=1)) + 1), batch.num_rows]
        for s, e in zip(edge[:-1], edge[1:]):
            here = tuple(unit[s].tolist())
            if held and here != now:
                yield from settle()
                held = []
            now = here
            held.append(batch.slice(s, e - s))
    if held:
        yield from settle()


def nearest_rows(base: DataFrame, ask: DataFrame, scales: np.ndarray, unit: np.ndarray, n: int, k: int,
                 pivots: int = PIVOTS, part_rows: int = PART_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(fold, query, rank, key, y, distance): the k nearest rows of ``base`` that train the query's fold.

    ``base``: f0, f1, ..., key, trains, y (``n`` rows or more before repeats were left out); ``ask``: f0, f1, ..., query,
    fold.  ``scales``: what divides the features in each fold; ``unit``: their spread over all rows."""
    n_folds, p = scales.shape
    fs = [f"f{j}" for j in range(p)]
    cells = max(1.0, n / part_rows)
    want = int(min(MOST_PIVOTS, np.ceil(cells) * pivots))
    picked = base.select(*fs).where(F.pmod(F.xxhash64(*fs, "key"), F.lit(max(1, n // want))) == 0).limit(4 * want).collect()   # sampled rows
    known: list = []
    tree = _layout(np.array([list(r) for r in picked], float).reshape(-1, p), cells, unit, known)
    types = ", ".join(f"{f} double" for f in fs)
    base = stage(base.select(*fs, "key", "trains", "y").mapInArrow(lambda it: _with_cell(it, tree, p), f"{types}, key long, trains int, y double, cell int"),
                 "knn_cells")
    in_fold = [F.col("trains").bitwiseAND(F.lit(1 << f)) != 0 for f in range(n_folds)]
    low, high, counts = np.full((n_folds, len(known), p), np.inf), np.full((n_folds, len(known), p), -np.inf), np.zeros((n_folds, len(known)), np.int64)
    for r in base.groupBy("cell").agg(*[g(F.when(b, F.col(c))).alias(f"{m}{f}_{c}") for f, b in enumerate(in_fold) for c in fs for m, g in (("a", F.min), ("z", F.max))],
                                      *[F.count(F.when(b, 1)).alias(f"n{f}") for f, b in enumerate(in_fold)]).collect():      # a row a cell
        for f in range(n_folds):
            if r[f"n{f}"]:
                low[f, r["cell"]], high[f, r["cell"]] = ([r[f"{m}{f}_{c}"] for c in fs] for m in "az")
                counts[f, r["cell"]] = r[f"n{f}"]
    boxes = {f: (low[f] / scales[f], high[f] / scales[f], counts[f], scales[f]) for f in range(n_folds)}

    def search(visits: DataFrame, name: str) -> DataFrame:
        visits = stage(visits, "knn_visits")
        many = visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / query_rows).cast("int").alias("blocks"))      # a row a cell
        asked = visits.join(F.broadcast(many), "cell").withColumn("block", F.pmod(F.xxhash64("query"), F.col("blocks")).cast("int"))
        held = base.join(F.broadcast(many), "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        where, none = ["cell", "block"], F.lit(0)
        both = held.select(*where, none.alias("kind"), "key", none.alias("fold"), "trains", "y", F.lit(0.0).alias("bound"), *fs) \
            .union(asked.select(*where, F.lit(1).alias("kind"), F.col("query").alias("key"), "fold", none.alias("trains"), F.lit(0.0).alias("y"), "bound", *fs))
        dealt = both.repartition(*where).sortWithinPartitions(*where, "kind")
        return stage(dealt.mapInArrow(lambda it: _ranked(it, boxes, p, k), f"{types}, query long, fold int, bound double, far array<int>, "
                                      "key array<long>, y array<double>, distance array<double>"), name)

    def pairs(lists: DataFrame) -> DataFrame:
        return lists.select("fold", "query", F.explode(F.arrays_zip("key", "y", "distance")).alias("_p")) \
            .select("fold", "query", "_p.key", "_p.y", "_p.distance")

    first = ask.select(*fs, "query", "fold").mapInArrow(lambda it: _first_cells(it, boxes, p, k), f"{types}, query long, fold int, cell int")
    near = search(first.withColumn("bound", F.lit(-1.0)), "knn_near")
    far = search(near.select(*fs, "query", "fold", F.explode("far").alias("cell"), "bound"), "knn_far")
    mine = Window.partitionBy("query").orderBy("distance", "key")
    return pairs(near).union(pairs(far)).withColumn("rank", F.row_number().over(mine)).where(F.col("rank") <= k) \
        .select("fold", "query", "rank", "key", "y", "distance")


def first_of_equals(ask: DataFrame, same: Sequence[str], query: str = "query") -> DataFrame:
    """Adds ``first``, the smallest ``query`` of the rows that are equal in ``same`` (no nulls); written once."""
    firsts = ask.groupBy(*same).agg(F.min(query).alias("first"))
    return stage(ask.join(firsts, list(same)), "knn_asked")


def _searched(rows: DataFrame, features: Sequence[str], target: str, k: int, n_folds: int, key: str = "row_key",
              pivots: int = PIVOTS, part_rows: int = PART_ROWS, query_rows: int = QUERY_ROWS) -> tuple[DataFrame, DataFrame]:
    """(fold, query, rank, key, y, distance) of the queries that ask, and all queries beside the one that asks for
    them: fold, query, first, y."""
    feats, p = list(features), len(features)
    fs = [f"f{j}" for j in range(p)]
    whole = F.lit(True)
    for c in feats:
        whole = whole & F.col(f"`{c}`").isNotNull()
    data = stage(rows.where(whole).select(*[F.col(f"`{c}`").cast("double").alias(f) for c, f in zip(feats, fs)],
                                          F.col(key).cast("long").alias("key"), F.coalesce("test_fold", F.lit(-1)).cast("int").alias("fold"),
                                          F.when(F.col(f"`{target}`").isNull(), 0).otherwise(F.col("trains")).cast("int").alias("trains"),
                                          F.col(f"`{target}`").cast("double").alias("y")), "knn_rows")
    spark = data.sparkSession
    empty = spark.createDataFrame([], "fold int, query long, rank int, key long, y double, distance double")
    in_fold = [F.col("trains").bitwiseAND(F.lit(1 << f)) != 0 for f in range(n_folds)]
    facts = data.agg(*[F.stddev_pop(F.when(b, F.col(c))).alias(f"s{f}_{c}") for f, b in enumerate(in_fold) for c in fs],
                     *[F.stddev_pop(c).alias(f"s_{c}") for c in fs], F.count(F.when(F.col("trains") != 0, 1)).alias("n")).first()    # one row
    asked = data.where("fold >= 0").select(*fs, F.col("key").alias("query"), "fold", "y")
    if not facts["n"]:
        return empty, asked.select("fold", "query", F.col("query").alias("first"), "y")
    scales = np.array([[facts[f"s{f}_{c}"] or 1.0 for c in fs] for f in range(n_folds)])
    unit = np.array([facts[f"s_{c}"] or 1.0 for c in fs])
    # no more than k rows of equal features and folds can be chosen
    first = Window.partitionBy(*fs, "trains").orderBy("key")
    base = data.where("trains != 0").withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k)
    asked = first_of_equals(asked, [*fs, "fold"])
    ask = asked.where("query = first").select(*fs, "query", "fold")
    return nearest_rows(base, ask, scales, unit, facts["n"], k, pivots, part_rows, query_rows), asked.select("fold", "query", "first", "y")


def neighbour_lists(rows: DataFrame, features: Sequence[str], target: str, k: int, n_folds: int, key: str = "row_key", **kw) -> DataFrame:
    """(fold, query, rank, key, y, distance): the k nearest training rows of every test row of every fold,
    on features divided by the population deviation of the fold's training rows.

    ``rows``: features, target, ``key`` (a distinct long) and the marks ``trains`` and ``test_fold``."""
    lists, asked = _searched(rows, features, target, k, n_folds, key, **kw)
    return asked.select("query", "first").join(lists.withColumnRenamed("query", "first"), "first") \
        .select("fold", "query", "rank", "key", "y", "distance")


def neighbour_values(rows: DataFrame, features: Sequence[str], target: str, k: int, n_folds: int, values: Sequence[Column],
                     key: str = "row_key", **kw) -> DataFrame:
    """(fold, query, y, ``values``): aggregates over the list of every test row of every fold, beside the row's
    own target.  Parameters as those of ``neighbour_lists``."""
    lists, asked = _searched(rows, features, target, k, n_folds, key, **kw)
    made = lists.groupBy(F.col("query").alias("first")).agg(*values)
    return asked.join(made, "first").drop("first")


def weighted(k: int, weights: str):
    """Aggregate over a query's list: the k nearest targets' mean, or their mean by 1 / distance (rows at
    distance zero take all)."""
    mine = F.col("rank") <= k
    if weights == "uniform":
        return F.avg(F.when(mine, F.col("y")))
    if weights != "distance":
        raise ValueError("weights must be 'uniform' or 'distance'")
    zero = mine & (F.col("distance") == 0)
    share = F.when(mine & (F.col("distance") > 0), 1 / F.nullif(F.col("distance"), F.lit(0.0)))
    return F.coalesce(F.avg(F.when(zero, F.col("y"))), F.sum(F.col("y") * share) / F.sum(share))


def knn_grid_scores(rows: DataFrame, features: Sequence[str], target: str, grid: dict, n_folds: int, key: str = "row_key", **kw) -> DataFrame:
    """(grid_idx, params, fold, mse, n_test) of every ``n_neighbors`` and ``weights`` in every fold."""
    sets = param_grid({"n_neighbors": [5], "weights": ["uniform"]} | {c: v for c, v in grid.items() if c in ("n_neighbors", "weights")})
    columns = [weighted(int(s["n_neighbors"]), s["weights"]).alias(f"p{i}") for i, s in enumerate(sets)]
    predicted = neighbour_values(rows, features, target, max(int(s["n_neighbors"]) for s in sets), n_folds, columns, key, **kw)
    errors = predicted.where(F.col("y").isNotNull()).groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_test"), *[F.avg((F.col(f"p{i}") - F.col("y")) ** 2).alias(f"p{i}") for i in range(len(sets))])
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("grid_idx"), F.lit(json.dumps(s, sort_keys=True)).alias("params"), F.col(f"p{i}").alias("mse"))
                               for i, s in enumerate(sets)]))
    return errors.select("fold", "n_test", each.alias("_e")).select("_e.grid_idx", "_e.params", "fold", "_e.mse", "n_test")
