"""Second-order gradient boosting on binned features, for a whole grid and all folds.

Squared error: a row's gradient is its prediction less its target, its Hessian its weight.  A split's
gain is half of GL^2/(HL+lambda) + GR^2/(HR+lambda) - G^2/(H+lambda), less gamma; a leaf adds
-learning_rate * G/(H+lambda).  Rows are drawn for a round (``subsample``), features for a tree
(``colsample_bytree``) by hashes, the same whatever the order of work.

* Sets that differ in ``n_estimators`` alone share one model, read off after 50, 100, ... rounds.
* Models of folds with at most ``local_rows`` training rows are boosted in one task each, over the
  fold's packed rows.
* Folds with at most ``task_rows`` go to a task once per ``GROUP`` models.  Rows of equal codes share their
  margin and node in every round, so trees are grown over the distinct code vectors, with the counts and
  targets of the rows that a round draws added up once for all models of the task.
* Scores of such folds are the tasks' own sums of squared errors: no prediction is written.
* Larger folds are boosted by levels: one job a level and round adds up the (model, node, feature, bin)
  histograms of gradient and Hessian of all such models' blocks; the margins of the rows are written
  once a round.  Only splits reach the driver.

Bins, blocks and fold marks are those of ``operators.trees``.  Rows with a null feature take no part,
rows without a target are scored alone.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import trees as T
from .models import param_grid

DEFAULTS = {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3, "subsample": 1.0, "colsample_bytree": 1.0,
            "gamma": 0.0, "reg_lambda": 1.0, "min_child_weight": 1.0, "min_samples_split": 2}
SEED = 42
LOCAL_ROWS = 250_000
GROUP = 6                   # models of one task, while a fold has more rows than that


@dataclass(frozen=True)
class Booster:
    """The parameters of one model (all but the number of rounds)."""
    learning_rate: float
    max_depth: int
    subsample: float
    colsample_bytree: float
    gamma: float
    reg_lambda: float
    min_child_weight: float
    min_samples_split: int

    @staticmethod
    def of(params: dict) -> "Booster":
        p = DEFAULTS | params
        return Booster(float(p["learning_rate"]), int(p["max_depth"]), float(p["subsample"]), float(p["colsample_bytree"]),
                       float(p["gamma"]), float(p["reg_lambda"]), float(p["min_child_weight"]), int(p["min_samples_split"]))

    def drawn(self, key: np.ndarray, round_: int) -> np.ndarray:
        """Which rows a round uses."""
        if self.subsample >= 1:
            return np.ones(len(key), bool)
        seed, out = T._mix((SEED << 32) + round_), np.zeros(len(key), bool)
        for lo in range(0, len(key), 1 << 14):          # pieces that stay in the processor's cache
            piece = key[lo:lo + (1 << 14)]
            out[lo:lo + len(piece)] = (T._mix(piece.view(np.uint64) ^ seed) >> np.uint64(11)) / float(1 << 53) < self.subsample
        return out

    def columns(self, round_: int, p: int) -> np.ndarray:
        """Which features a round's tree uses."""
        return T.features_of((SEED << 33) + round_, np.array([0]), p, max(1, round(self.colsample_bytree * p)))[0]

    def split(self, hist: np.ndarray, columns: np.ndarray):
        """(feature or -1, bin, gain) of each node; ``hist``: ([rows, H, G], feature, node, bin)."""
        c, h, g = hist.cumsum(axis=3)
        rows, hw, gw = c[..., -1:], h[..., -1:], g[..., -1:]
        lam = self.reg_lambda
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = 0.5 * (g * g / (h + lam) + (gw - g) ** 2 / (hw - h + lam) - gw * gw / (hw + lam)) - self.gamma
        ok = (c > 0) & (rows - c > 0) & (h >= self.min_child_weight) & (hw - h >= self.min_child_weight) \
            & columns[:, None, None] & (rows >= self.min_samples_split)
        gain = np.where(ok, gain, -np.inf)
        flat = gain.transpose(1, 0, 2).reshape(gain.shape[1], -1)           # ties: the first feature, then bin
        best = flat.argmax(axis=1)
        top = flat[np.arange(len(flat)), best]
        f = int(columns.argmax())
        least = T.ROUNDING * (gw[f, :, 0] ** 2 / np.maximum(hw[f, :, 0] + lam, 1e-12) + 1e-300)
        return np.where(top > least, best // gain.shape[2], -1), best % gain.shape[2], top

    def leaf(self, h, g):
        return -self.learning_rate * g / np.maximum(h + self.reg_lambda, 1e-12)


def _histograms(x: np.ndarray, node: np.ndarray, g: np.ndarray, nodes: int, bins: int, columns: np.ndarray) -> np.ndarray:
    """([rows, H, G], feature, node, bin) sums; a row's Hessian is 1.  Features that are not drawn have none."""
    none = np.zeros((3, nodes, bins))
    return np.stack([T.histogram(x[:, f], node, None, g, nodes, bins) if columns[f] else none for f in range(x.shape[1])], axis=1)


# small folds: a model in a task -----------------------------------------------------------------
def boost(rows: T.Rows, y: np.ndarray, fold: int, booster: Booster, rounds: Sequence[int], bins: int) -> np.ndarray:
    """(test row, count of ``rounds``) predictions of one model of a fold."""
    train, test = rows.trains >> fold & 1 == 1, rows.test == fold
    xt, yt, key, xs = rows.x[train], y[train], rows.key[train], rows.x[test]
    margin, scored = np.full(len(yt), yt.mean() if len(yt) else 0.0), np.full(len(xs), yt.mean() if len(yt) else 0.0)
    out = np.zeros((len(xs), len(rounds)))
    for r in range(max(rounds)):
        use = np.flatnonzero(booster.drawn(key, r))
        columns = booster.columns(r, xt.shape[1])
        # all training rows go down the tree, those drawn make it
        at, pos, live = np.arange(len(yt)), np.zeros(len(yt), np.int64), np.arange(len(xs))
        spos, inside = np.zeros(len(xs), np.int64), np.zeros(len(yt), bool)
        inside[use] = True
        g_all = margin - yt
        nodes = 1
        for depth in range(booster.max_depth + 1):
            mine = inside[at]
            g = np.bincount(pos[mine], g_all[at[mine]], nodes)
            h = np.bincount(pos[mine], minlength=nodes).astype(float)
            value = booster.leaf(h, g)
            feature = np.full(nodes, -1)
            if depth < booster.max_depth and mine.any():
                hist = _histograms(xt[at[mine]], pos[mine], g_all[at[mine]], nodes, bins, columns)
                feature, cut, _ = booster.split(hist, columns)
            stop, sstop = feature[pos] < 0, feature[spos] < 0
            margin[at[stop]] += value[pos[stop]]
            scored[live[sstop]] += value[spos[sstop]]
            at, pos, live, spos = at[~stop], pos[~stop], live[~sstop], spos[~sstop]
            if not len(at):
                break
            number = np.cumsum(feature >= 0) - 1
            pos = 2 * number[pos] + (xt[at, feature[pos]] > cut[pos])
            spos = 2 * number[spos] + (xs[live, feature[spos]] > cut[spos])
            nodes = 2 * (int(number[-1]) + 1)
        for i, n in enumerate(rounds):
            if n == r + 1:
                out[:, i] = scored
    return out


def boost_together(cells: T.Cells, boosters: Sequence[Booster], rounds: Sequence[int], bins: int) -> list[np.ndarray]:
    """As ``boost`` for several models of a fold, over its distinct code vectors.

    Models that differ in ``min_samples_split`` alone are one until a tree splits a node that is too small for some of them."""
    (n, p), codes, flat = cells.x.shape, T.Codes(cells.x, bins), np.ascontiguousarray(cells.x).ravel()
    alike: dict[Booster, list[int]] = {}
    for m, booster in sorted(enumerate(boosters), key=lambda b: b[1].min_samples_split):
        alike.setdefault(replace(booster, min_samples_split=0), []).append(m)
    states = [(members, np.full(n, cells.y.mean())) for members in alike.values()]
    out = [np.zeros((len(cells.test), len(rounds))) for _ in boosters]
    sums: dict = {}
    for r in range(max(rounds)):
        at = 0
        while at < len(states):
            members, margin = states[at]
            booster = boosters[members[0]]
            if (booster.subsample, r) not in sums:          # of all rows once, of a draw every round
                sums = {k: v for k, v in sums.items() if k[1] == r}
                use = booster.drawn(cells.key, r)
                sums[booster.subsample, r] = np.bincount(cells.train[use], minlength=n).astype(float), np.bincount(cells.train[use], cells.y[use], n)
            count, total = sums[booster.subsample, r]
            hg = np.empty(n, complex)
            hg.real, hg.imag = count, count * margin - total
            pos, value, least = _tree(codes, flat, hg, booster, booster.columns(r, p))
            apart = [m for m in members if boosters[m].min_samples_split > least]
            if apart:
                states[at] = [m for m in members if m not in apart], margin
                states.append((apart, margin.copy()))       # their turn comes in this round
            for lo in range(0, n, T.PIECE):
                margin[lo:lo + T.PIECE] += value[pos[lo:lo + T.PIECE]]
            at += 1
        for i, last in enumerate(rounds):
            if last == r + 1:
                for members, margin in states:
                    for m in members:
                        out[m][:, i] = margin[cells.test]
    return out


def _tree(codes: T.Codes, flat: np.ndarray, hg: np.ndarray, booster: Booster, columns: np.ndarray):
    """A round's tree over code vectors: each vector's leaf, the leaves' values, and the rows of the least node that is split.

    ``flat``: the codes of the vectors one after another; ``hg``: Hessian and gradient of each, as complex numbers."""
    n, p, bins = len(hg), codes.p, codes.bins
    pos, nodes, open_, least, route = np.zeros(n, np.int32), 1, np.ones(1, bool), np.inf, None

    first = np.arange(0, T.PIECE * p, p)

    def pieces():
        """Rows by pieces, sent down the last level's splits."""
        for lo in range(0, n, T.PIECE):
            hi = min(lo + T.PIECE, n)
            now = pos[lo:hi].astype(np.int64)
            if route is not None:
                feature, cut, child = route
                code = flat[lo * p:hi * p].take(first[:hi - lo] + feature.take(now, mode="clip"), mode="clip")
                now = child.take(now, mode="clip") + (code > cut.take(now, mode="clip"))
                pos[lo:hi] = now
            yield lo, hi, now

    for _ in range(booster.max_depth):
        sums = codes.empty(nodes)
        for lo, hi, now in pieces():
            codes.add(sums, lo, hi, now, hg)
        hist, route = codes.histograms(sums, nodes), None
        hist = np.stack([hist.real, hist.real, hist.imag])          # a row's Hessian is 1
        feature, cut, _ = booster.split(hist, columns)
        split = open_ & (feature >= 0)
        if not split.any():
            break
        least = min(least, hist[0, int(columns.argmax()), split].sum(axis=1).min())
        ways = 1 + split
        # a node that is not split goes on as one
        route = np.where(split, feature, 0), np.where(split, cut, bins).astype(np.uint8), np.cumsum(ways) - ways
        open_, nodes = np.repeat(split, ways), int(ways.sum())
    total = np.zeros(nodes, complex)
    for lo, hi, now in pieces():
        np.add.at(total, now, hg[lo:hi])
    return pos, booster.leaf(total.real, total.imag), least


_UNIT = "part int, model int, fold int, x binary, y binary, key binary, trains binary, test binary"


def _deal(batches, models: dict[int, list[int]], part_of: dict[tuple[int, int], int], p: int):
    """The rows of a fold for every model that is boosted in a task, with the part that each model and fold goes to."""
    names = [c.split()[0] for c in _UNIT.split(", ")]
    for batch in batches:
        rows = T.Rows.of(batch, p)
        for fold, numbers in models.items():
            mine = rows.take(np.flatnonzero((rows.trains >> fold & 1 == 1) | (rows.test == fold)))
            if len(mine.y):
                packed = [pa.array([b], pa.binary()) for b in mine.packed()]
                for m in numbers:
                    yield pa.RecordBatch.from_arrays([*[pa.array([v], pa.int32()) for v in (part_of[m, fold], m, fold)], *packed], names)


def _predictions(model: int, fold: int, rows: T.Rows, test: np.ndarray, out: np.ndarray, scale: float) -> pa.RecordBatch:
    n, k = out.shape
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, model, np.int32)), pa.array(np.full(n, fold, np.int32)), pa.array(rows.key[test]), pa.array(rows.y[test] / scale),
         pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(out.ravel()))], ["model", "fold", "key", "y", "p"])


def _boosted(batches, boosters: list[Booster], groups: list[list[int]], rounds: Sequence[int], p: int, bins: int, scale: float, scores: bool):
    """Predictions of the test rows of every unit, or their number and mean squared errors (``scores``).  The units
    after those of single models are ``groups`` of them."""
    held, now = [], None

    def result(model, rows, test, out):
        if not scores:
            return _predictions(model, now[1], rows, test, out, scale)
        e = out - (rows.y[test] / scale)[:, None]
        return pa.RecordBatch.from_arrays([pa.array([model], pa.int32()), pa.array([now[1]], pa.int32()), pa.array([len(e)], pa.int64()),
                                           pa.array([(e * e).mean(axis=0).tolist()], pa.list_(pa.float64()))], ["model", "fold", "n_test", "mse"])

    def settle():
        rows = T.Rows.of(pa.Table.from_batches(held), p)
        # the order of the rows must not matter to the last bit of a sum
        rows = rows.take(np.argsort(rows.key, kind="stable"))
        test = rows.test == now[1]
        if scores and not test.any():
            return
        if now[0] < len(boosters):
            yield result(now[0], rows, test, boost(rows, rows.y / scale, now[1], boosters[now[0]], rounds, bins))
            return
        cells, models = T.Cells.of(rows, now[1], bins), groups[now[0] - len(boosters)]
        cells.y = cells.y / scale
        for model, out in zip(models, boost_together(cells, [boosters[m] for m in models], rounds, bins)):
            yield result(model, rows, test, out)

    for batch in batches:
        for i in range(batch.num_rows):
            key = (batch.column(1)[i].as_py(), batch.column(2)[i].as_py())
            if held and key != now:
                yield from settle()
                held = []
            now = key
            held.append(batch.slice(i, 1))
    if held:
        yield from settle()


# large folds: all models together, level by level --------------------------------------------------
def _walk(x: np.ndarray, tree: dict[int, tuple]) -> np.ndarray:
    """The node that each row ends in; ``tree``: heap number -> (feature, bin) of the splits so far."""
    at = np.ones(len(x), np.int64)
    for node in sorted(tree):
        on = np.flatnonzero(at == node)
        at[on] = 2 * node + (x[on, tree[node][0]] > tree[node][1])
    return at


def _level(batches, models: list[tuple[int, int]], boosters, growing: dict, round_: int, p: int, bins: int, scale: float):
    names = ["model", "fold", "node", "hist"]
    for batch in batches:
        for i in range(batch.num_rows):
            rows = T.Rows.of(batch.slice(i, 1), p)
            margins = np.frombuffer(batch.column(batch.schema.get_field_index("margins"))[i].as_buffer(), float).reshape(len(models), -1)
            for j, (m, fold) in enumerate(models):
                tree, open_ = growing[m, fold]
                if not open_:
                    continue
                use = np.flatnonzero((rows.trains >> fold & 1 == 1) & boosters[m].drawn(rows.key, round_))
                at = _walk(rows.x[use], tree)
                place = np.searchsorted(open_, at)
                on = np.flatnonzero((place < len(open_)) & (np.array(open_)[np.minimum(place, len(open_) - 1)] == at))
                if not len(on):
                    continue
                r = use[on]
                hist = _histograms(rows.x[r], place[on], margins[j, r] - rows.y[r] / scale, len(open_), bins,
                                   boosters[m].columns(round_, p))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v] * len(open_), t) for v, t in ((m, pa.int32()), (fold, pa.int32()))]
                    + [pa.array(open_, pa.int64()), pa.array([hist[:, :, k].tobytes() for k in range(len(open_))], pa.binary())], names)


def _chosen(batches, boosters, round_: int, p: int, bins: int):
    """The split and the sums of each node; rows come sorted by (model, fold, node)."""
    names = ["model", "fold", "node", "feature", "bin", "h", "g"]
    types = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64())
    now, total = None, None

    def row():
        booster = boosters[now[0]]
        f, b, _ = booster.split(total[:, :, None], booster.columns(round_, p))
        _, h, g = total[:, int(booster.columns(round_, p).argmax())].sum(axis=1)
        return (*now, int(f[0]), int(b[0]), float(h), float(g))

    for batch in batches:
        out = []
        for *key, hist in zip(*(batch.column(i).to_pylist() for i in range(4))):
            h = np.frombuffer(hist, float).reshape(3, p, bins)
            if tuple(key) == now:
                total = total + h
                continue
            if now is not None:
                out.append(row())
            now, total = tuple(key), h
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row(), types)], names)


def _advanced(batches, models, grown: dict, p: int):
    """Blocks with the margins after a round's trees; ``grown``: (splits, values of the leaves)."""
    for batch in batches:
        for i in range(batch.num_rows):
            rows = T.Rows.of(batch.slice(i, 1), p)
            at = batch.schema.get_field_index("margins")
            margins = np.frombuffer(batch.column(at)[i].as_buffer(), float).reshape(len(models), -1).copy()
            for j, key in enumerate(models):
                tree, values = grown[key]
                nodes = _walk(rows.x, tree)
                heaps = np.array(sorted(values))
                margins[j] += np.array([values[h] for h in heaps.tolist()])[np.searchsorted(heaps, nodes)]
            cols = list(batch.slice(i, 1).columns)
            cols[at] = pa.array([margins.tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays(cols, batch.schema.names)


def _read_off(batches, models, p: int, scale: float):
    for batch in batches:
        for i in range(batch.num_rows):
            rows = T.Rows.of(batch.slice(i, 1), p)
            margins = np.frombuffer(batch.column(batch.schema.get_field_index("margins"))[i].as_buffer(), float).reshape(len(models), -1)
            for j, (m, fold) in enumerate(models):
                test = rows.test == fold
                if test.any():
                    yield _predictions(m, fold, rows, test, margins[j, test][:, None], scale)


def _by_levels(blocks: DataFrame, models: list[tuple[int, int]], boosters: list[Booster], base: dict[int, float],
               rounds: Sequence[int], p: int, bins: int, scale: float) -> DataFrame:
    """(model, fold, key, y, p) of the models of large folds."""
    start = np.array([base[fold] for _, fold in models])
    schema = T._PACKED + ", margins binary"

    def with_base(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                n = batch.column(0)[i].as_py()
                yield pa.RecordBatch.from_arrays([*batch.slice(i, 1).columns, pa.array([np.repeat(start, n).tobytes()], pa.binary())],
                                                 [*batch.schema.names, "margins"])

    now, parts = stage(blocks.mapInArrow(with_base, schema), "boost_margins"), []
    keys = ["model", "fold", "node"]
    for r in range(max(rounds)):
        growing = {k: ({}, [1]) for k in models}
        values = {k: {} for k in models}
        for depth in range(max(b.max_depth for b in boosters) + 1):
            if not any(open_ for _, open_ in growing.values()):
                break
            state = growing
            hists = now.mapInArrow(lambda it: _level(it, models, boosters, state, r, p, bins, scale),
                                   "model int, fold int, node long, hist binary")
            found = hists.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
                lambda it: _chosen(it, boosters, r, p, bins), "model int, fold int, node long, feature int, bin int, h double, g double").collect()
            nodes_of: dict[tuple, list] = {k: [] for k in models}           # a row per open node: at most 2 ** max_depth a model
            for row in found:
                nodes_of[row["model"], row["fold"]].append(row)
            following = {}
            for k, rows_ in nodes_of.items():
                tree, open_ = dict(growing[k][0]), []
                for row in rows_:
                    if row["feature"] >= 0 and depth < boosters[k[0]].max_depth:
                        tree[row["node"]] = (row["feature"], row["bin"])
                        open_ += [2 * row["node"], 2 * row["node"] + 1]
                    else:
                        values[k][row["node"]] = boosters[k[0]].leaf(row["h"], row["g"])
                if not rows_ and growing[k][1]:                             # no row was drawn
                    values[k] = {h: 0.0 for h in growing[k][1]}
                following[k] = (tree, sorted(open_))
            growing = following
        grown = {k: (growing[k][0], values[k]) for k in models}
        now = stage(now.mapInArrow(lambda it: _advanced(it, models, grown, p), schema), "boost_margins")
        for i, n in enumerate(rounds):
            if n == r + 1:
                one = now.mapInArrow(lambda it: _read_off(it, models, p, scale), "model int, fold int, key long, y double, p array<double>")
                parts.append(one.select("model", "fold", "key", "y", F.lit(i).alias("part"), F.col("p")[0].alias("v")))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    columns = F.array(*[F.max(F.when(F.col("part") == i, F.col("v"))) for i in range(len(rounds))]).alias("p")
    return out.groupBy("model", "fold", "key").agg(F.max("y").alias("y"), columns).select("model", "fold", "key", "y", "p")


# the operator -----------------------------------------------------------------------------------------
def boost_predictions(rows: DataFrame, features: Sequence[str], target: str, grid: dict, n_folds: int, key: str = "row_key",
                      bins: int = T.BINS, local_rows: int = LOCAL_ROWS, task_rows: int = T.LOCAL_ROWS,
                      scores: bool = False) -> tuple[DataFrame, list[tuple[dict, int, int]]]:
    """(model, fold, key, y, p: predictions after each number of rounds) for the test rows of every fold, and the
    sets as (parameters, model, place in p); with ``scores`` (model, fold, n_test, mse: after each number of
    rounds) instead.  ``rows`` as for ``trees.forest_predictions``."""
    feats, p = list(features), len(features)
    rounds = tuple(sorted({int(n) for n in grid.get("n_estimators", [DEFAULTS["n_estimators"]])}))
    sets = param_grid({k: list(v) for k, v in grid.items()})
    boosters = list(dict.fromkeys(Booster.of(s) for s in sets))
    places = [(s, boosters.index(Booster.of(s)), rounds.index(int(s.get("n_estimators", DEFAULTS["n_estimators"])))) for s in sets]
    blocks, scale, sizes, base = T.binned_blocks(rows, feats, target, n_folds, key, bins)
    groups = []
    for share in dict.fromkeys(b.subsample for b in boosters):
        alike = [m for m, b in enumerate(boosters) if b.subsample == share]
        known = list(dict.fromkeys(replace(boosters[m], min_samples_split=0) for m in alike))
        alike.sort(key=lambda m: known.index(replace(boosters[m], min_samples_split=0)))     # such models share their trees
        groups += [alike[i:i + GROUP] for i in range(0, len(alike), GROUP)]
    small = {f: list(range(len(boosters))) for f in range(n_folds) if 0 < sizes[f] <= local_rows}
    small |= {f: [len(boosters) + i for i in range(len(groups))] for f in range(n_folds) if local_rows < sizes[f] <= task_rows}
    unit = ["model", "fold"]
    units = sorted(((m, f) for f, mine in small.items() for m in mine), key=lambda u: -sizes[u[1]])
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), len(units) // 4 + 1)
    large_folds = max(sizes.values()) > local_rows
    if large_folds:             # units of many rows come in the first parts, each in its own if there are enough
        parts = max(1, min(len(units), parts))
    part_of = {u: i % parts for i, u in enumerate(units)}
    dealt = blocks.mapInArrow(lambda it: _deal(it, small, part_of, p), _UNIT)
    dealt = dealt.repartitionById(parts, F.col("part")) if large_folds else dealt.repartition(parts, *unit)
    summed = scores and large_folds         # small folds: predictions, averaged by Spark
    schema = "model int, fold int, n_test long, mse array<double>" if summed else "model int, fold int, key long, y double, p array<double>"
    out = dealt.sortWithinPartitions(*unit).mapInArrow(
        lambda it: _boosted(it, boosters, groups, rounds, p, bins, scale, summed), schema)
    large = [(m, f) for f in range(n_folds) if sizes[f] > max(local_rows, task_rows) for m in range(len(boosters))]
    if large:
        more = _by_levels(blocks, large, boosters, base, rounds, p, bins, scale)
        out = out.union(_errors(more, len(rounds)) if scores else more)
    out = stage(out, "boosted")
    return _errors(out, len(rounds)) if scores and not summed else out, places


def _errors(predicted: DataFrame, width: int) -> DataFrame:
    mse = F.array(*[F.avg((F.col("p")[i] - F.col("y")) ** 2) for i in range(width)])
    return predicted.groupBy("model", "fold").agg(F.count(F.lit(1)).alias("n_test"), mse.alias("mse"))


def boost_grid_scores(rows: DataFrame, features: Sequence[str], target: str, grid: dict, n_folds: int, **kw) -> DataFrame:
    """(grid_idx, params, fold, mse, n_test) of every set of a boosting grid in every fold."""
    known = rows.where(F.col(f"`{target}`").isNotNull())
    errors, places = boost_predictions(known, features, target, grid, n_folds, scores=True, **kw)
    long = errors.select("model", "fold", "n_test", F.posexplode("mse").alias("place", "mse"))
    wanted = rows.sparkSession.createDataFrame([(g, json.dumps(s, sort_keys=True), m, i) for g, (s, m, i) in enumerate(places)],
                                               "grid_idx int, params string, model int, place int")
    return long.join(F.broadcast(wanted), ["model", "place"]).select("grid_idx", "params", "fold", "mse", "n_test")    # one row a set
