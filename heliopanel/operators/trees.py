"""Regression forests on binned features, a whole parameter grid and all folds at once.

* Features are binned once (at most ``BINS`` codes, edges from approximate quantiles) and rows
  packed into blocks of bytes.
* Parameter sets share trees.  A split depends on its node's rows alone, so a forest of fewer
  trees is the first part of a larger one, and a tree with a smaller ``max_depth`` or a larger
  ``min_samples_split`` is the deeper one cut off earlier.  Only ``min_samples_leaf`` and
  ``max_features`` (a *family*) ask for trees of their own; all other sets are read off while
  test rows go down.
* The packed rows of a fold with at most ``local_rows`` training rows (tens of bytes a row) go to a task
  once per family of a grid, or per group of trees.  Rows of equal codes share a node in every tree,
  so trees are grown over the distinct code vectors with the draws of their rows added up.  A task that
  grows all trees of a family sums the squared errors itself: no prediction is written.
* Nodes of larger folds are split by one aggregation a level over all folds, families and trees:
  tasks add up (tree, node, feature, bin) histograms of their blocks, the histograms of a node are
  summed and its split chosen.  Only splits reach the driver.  The rows of a smaller node go to one
  task, which grows the rest of its subtree.

Targets are scaled to integers, so sums are exact and a split does not depend on how rows were
dealt.  Bootstrap weights are Poisson(1) draws by a hash of (row, tree), feature subsets a hash
of (tree, node, feature): the same whatever the order of work.  Rows with a null feature take no
part, rows without a target are scored alone.
"""

from __future__ import annotations

import json
import math
from copy import copy
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .models import param_grid

BINS = 32
LOCAL_ROWS = 12_000_000     # of a task: about 100 bytes each while trees grow
SPLIT_ROWS = 250_000        # training rows from which a family's trees are dealt over the cores
BLOCK_ROWS = 1 << 16
ROUNDING = 1e-12
GROUP = 25                  # trees of one task, while a fold is small
# Poisson(1): chances of at most 0, 1, 2, ... draws, in 2 ** -53
_DRAWS = [math.ceil(c * (1 << 53)) for c in np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])]
_PACKED = "n int, x binary, y binary, key binary, trains binary, test binary"


def _mix(x) -> np.ndarray:
    """Scrambled 64-bit integers (splitmix64)."""
    with np.errstate(over="ignore"):
        x = np.asarray(x, np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


# binned rows ------------------------------------------------------------------------------------
def bin_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Per feature the ascending edges between bins (a row's code counts the edges below its value)."""
    share = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), share, 10_000).alias(f"e{j}")
                   for j, c in enumerate(features)]).first()        # features x bins numbers
    return [np.unique(np.array(row[f"e{j}"] or [], float)) for j in range(len(features))]


def _pack(batches, edges: list[np.ndarray], scale: float):
    """Blocks of rows; batches hold the features, then y, key, trains, test."""
    p = len(edges)
    for batch in batches:
        for lo in range(0, batch.num_rows, BLOCK_ROWS):
            b = batch.slice(lo, BLOCK_ROWS)
            cols = [b.column(j).to_numpy(zero_copy_only=False) for j in range(p + 4)]
            x = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, cols)], axis=1).astype(np.uint8)
            parts = [x, np.rint(cols[p] * scale), cols[p + 1].astype(np.int64), cols[p + 2].astype(np.int32), cols[p + 3].astype(np.int8)]
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int32()), *[pa.array([a.tobytes()], pa.binary()) for a in parts]],
                                             ["n", "x", "y", "key", "trains", "test"])


@dataclass
class Rows:
    """Binned rows: codes, scaled targets, keys, bit mask of the folds they train, fold they test (-1: none)."""
    x: np.ndarray
    y: np.ndarray
    key: np.ndarray
    trains: np.ndarray
    test: np.ndarray

    @staticmethod
    def of(table: pa.Table | pa.RecordBatch, p: int) -> "Rows":
        def joined(name, kind):
            return np.frombuffer(b"".join(table[name].to_pylist()), kind)
        return Rows(joined("x", np.uint8).reshape(-1, p), joined("y", float), joined("key", np.int64),
                    joined("trains", np.int32), joined("test", np.int8))

    def take(self, i: np.ndarray) -> "Rows":
        return Rows(self.x[i], self.y[i], self.key[i], self.trains[i], self.test[i])

    def packed(self) -> list[bytes]:
        return [a.tobytes() for a in (self.x, self.y, self.key, self.trains, self.test)]


def cells_of(x: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct code vectors, the place of each row's among them)."""
    at, most = np.zeros(len(x), np.int64), 1
    for f in range(x.shape[1]):
        if most > (1 << 62) // bins:
            seen, at = np.unique(at, return_inverse=True)
            most = len(seen)
        at, most = at * bins + x[:, f], most * bins
    _, first, at = np.unique(at, return_index=True, return_inverse=True)
    return x[first], at.astype(np.int32)


PIECE = 1 << 14             # rows whose arrays stay in the processor's cache
NODES = 512                 # nodes whose histograms do
JOINT_CELLS = 1 << 16       # cells of a histogram of several features together


class Codes:
    """Codes of rows by feature, and those of pairs and triples of features as one number: a histogram over
    several features at once holds those of each of them."""

    def __init__(self, x: np.ndarray, bins: int, most: int = 3):
        self.p, self.bins, self.parts = x.shape[1], bins, {1: [((f,), np.ascontiguousarray(x[:, f])) for f in range(x.shape[1])]}
        for size in range(2, most + 1):
            if bins ** size > 1 << 16:
                break
            joint = []
            for first in range(0, self.p, size):
                features = tuple(range(first, min(first + size, self.p)))
                code = np.zeros(len(x), np.uint16)
                for f in features:
                    code = code * np.uint16(bins) + x[:, f]
                joint.append((features, code))
            self.parts[size] = joint

    def width(self, nodes: int) -> int:
        """How many features to take together for histograms of so many nodes."""
        return max(size for size in self.parts if size == 1 or nodes * self.bins ** size <= JOINT_CELLS)

    def take(self, keep: np.ndarray) -> "Codes":
        out = copy(self)
        out.parts = {size: [(features, code[keep]) for features, code in joint] for size, joint in self.parts.items()}
        return out

    def empty(self, nodes: int, kind=complex) -> tuple[int, list[np.ndarray]]:
        """(features taken together, sums of no rows)."""
        width = max(size for size in self.parts if size == 1 or nodes * self.bins ** size <= JOINT_CELLS)
        return width, [np.zeros(nodes * self.bins ** len(features), kind) for features, _ in self.parts[width]]

    def add(self, sums: tuple[int, list[np.ndarray]], lo: int, hi: int, node: np.ndarray, values: np.ndarray) -> None:
        """Add the values of rows lo to hi; two values a row are added at once as a complex number."""
        for (features, code), total in zip(self.parts[sums[0]], sums[1]):
            at = node * self.bins ** len(features)
            at += code[lo:hi]
            np.add.at(total, at, values[lo:hi])

    def histograms(self, sums: tuple[int, list[np.ndarray]], nodes: int) -> np.ndarray:
        """(feature, node, bin) sums."""
        out = np.zeros((self.p, nodes, self.bins), sums[1][0].dtype)
        for (features, _), total in zip(self.parts[sums[0]], sums[1]):
            whole = total.reshape(-1, *[self.bins] * len(features))[:nodes]
            for i, f in enumerate(features):
                out[f] = whole.sum(axis=tuple(j + 1 for j in range(len(features)) if j != i))
        return out


def weights(key: np.ndarray, tree: int, bootstrap: bool) -> np.ndarray:
    """How often each row is drawn for a tree."""
    if not bootstrap:
        return np.ones(len(key))
    out, tree = np.zeros(len(key)), _mix(tree)
    for lo in range(0, len(key), 1 << 14):          # pieces that stay in the processor's cache
        u, w = _mix(key[lo:lo + (1 << 14)].view(np.uint64) ^ tree) >> np.uint64(11), out[lo:lo + (1 << 14)]
        for least in _DRAWS:
            w += u >= np.uint64(least)
    return out


def features_of(tree: int, nodes: np.ndarray, p: int, m: int) -> np.ndarray:
    """(node, feature) flags: ``m`` features of each node, drawn by hash."""
    if m >= p:
        return np.ones((len(nodes), p), bool)
    h = _mix(_mix(nodes.astype(np.uint64)[:, None] ^ _mix(tree)) + np.arange(p, dtype=np.uint64)[None, :])
    flags = np.zeros((len(nodes), p), bool)
    np.put_along_axis(flags, np.argsort(h, axis=1, kind="stable")[:, :m], True, axis=1)
    return flags


# one level ------------------------------------------------------------------------------------------
def histogram(code: np.ndarray, node: np.ndarray, w: np.ndarray | None, wy: np.ndarray, nodes: int, bins: int,
              counts: np.ndarray | None = None) -> np.ndarray:
    """([rows, weight, weighted target], node, bin) sums of one feature.  Without ``counts`` the weights
    stand for the rows, which do as long as only no rows and some must be told apart; ``w`` None: all 1."""
    at = node * bins + code
    weight, target = (np.bincount(at, v, nodes * bins) for v in (w, wy))
    rows = np.bincount(at, counts, nodes * bins) if counts is not None else weight
    return np.stack([rows, weight, target]).reshape(3, nodes, bins)


def choose(hists: Iterator[np.ndarray | None], allowed: np.ndarray, min_leaf: int):
    """(feature, bin) of each node's best split by squared error; feature -1 if none lowers it.

    ``hists``: per feature the nodes' histogram (without rows if the weights stand for them); ``allowed``: (node,
    feature) flags."""
    n = len(allowed)
    best, feature, cut = np.zeros(n), np.full(n, -1), np.zeros(n, np.int64)
    for f, hist in enumerate(hists):
        if hist is None:
            continue
        asked = np.flatnonzero(allowed[:, f])
        for lo in range(0, len(asked), NODES):
            mine = asked[lo:lo + NODES]
            sums = hist[:, mine].cumsum(axis=2)
            c, w, s = sums if len(sums) == 3 else (sums[0], *sums)
            cr, wr, sr = c[:, -1:] - c, w[:, -1:] - w, s[:, -1:] - s
            whole = s[:, -1] ** 2 / np.maximum(w[:, -1], 1)
            ok = (c >= min_leaf) & (cr >= min_leaf)
            gain = np.where(ok, s * s / np.maximum(w, 1) + sr * sr / np.maximum(wr, 1) - whole[:, None], 0.0)
            b = gain.argmax(axis=1)
            g = gain[np.arange(len(mine)), b]
            better = g > np.maximum(best[mine] * (1 + ROUNDING), ROUNDING * whole)       # less is rounding
            mine, b, g = mine[better], b[better], g[better]
            feature[mine], cut[mine], best[mine] = f, b, g
    return feature, cut


@dataclass(frozen=True)
class Forest:
    """What all trees of a run have in common."""
    families: tuple            # (min_samples_leaf, max_features) each
    depths: tuple
    min_splits: tuple
    counts: tuple              # ascending numbers of trees
    n_folds: int
    p: int
    seed: int
    bootstrap: bool
    local_rows: int
    bins: int = BINS

    def number(self, family: int, fold: int, tree: int) -> int:
        # a tree of the same number draws the same rows and features in all families and folds
        return (self.seed << 24) + tree

    def drawn(self, family: int) -> int:
        return max(1, int(self.families[family][1] * self.p))

    def splittable(self, family: int, rows) -> np.ndarray:
        return rows >= max(2 * self.families[family][0], min(self.min_splits))


@dataclass
class Cells:
    """The rows of a fold by code vector: the vectors, place and target of each training row, place of each test row."""
    x: np.ndarray
    train: np.ndarray
    y: np.ndarray
    key: np.ndarray
    test: np.ndarray

    @staticmethod
    def of(rows: Rows, fold: int, bins: int) -> "Cells":
        x, at = cells_of(rows.x, bins)
        train = np.flatnonzero(rows.trains >> fold & 1 == 1)
        train = train[np.argsort(at[train], kind="stable")]         # sums by vector then go through memory in order
        return Cells(x, at[train], rows.y[train], rows.key[train], at[rows.test == fold])

    def drawn(self, number: int, bootstrap: bool) -> tuple[np.ndarray, ...]:
        """Per vector the rows that a tree draws, and the sums of their weights, weighted targets and their squares."""
        w = weights(self.key, number, bootstrap)
        use, n = np.flatnonzero(w), len(self.x)
        at, y, w = self.train[use], self.y[use], w[use]
        wy = w * y
        return np.bincount(at, minlength=n).astype(float), np.bincount(at, w, n), np.bincount(at, wy, n), np.bincount(at, wy * y, n)

    def asked(self) -> tuple[np.ndarray, np.ndarray]:
        """Which vectors have test rows, and each test row's place among these."""
        seen = np.zeros(len(self.x), bool)
        seen[self.test] = True
        return seen, (np.cumsum(seen) - 1)[self.test]


def grow(cells: Cells, draws: tuple[np.ndarray, ...], asked: np.ndarray, family: int, number: int, forest: Forest, node: int = 1,
         above: Sequence[tuple[float, float]] = (), leaf: tuple[float, float] | None = None) -> np.ndarray:
    """Grow the subtree of ``node``; (vector with test rows, depth x min_split) predictions.  ``draws``: ``Cells.drawn``
    of the tree; ``asked``: ``Cells.asked``.

    ``above``: (rows, value) of the node's ancestors from the root down; ``leaf``: (rows, value) of
    the node itself if it is known not to be split (then only test rows are needed)."""
    min_leaf, p = forest.families[family][0], forest.p
    test = cells.x[asked]
    out = np.zeros((len(test), len(forest.depths), len(forest.min_splits)))
    # of each node: its value by min_samples_split, and by which it is not cut off yet
    value, going = np.zeros((1, len(forest.min_splits))), np.ones((1, len(forest.min_splits)), bool)
    live, at = np.arange(len(test)), np.zeros(len(test), np.int64)      # test rows on nodes that go on, and their nodes

    def settle(depth, count, mean):
        """Counts and means of the nodes of this depth."""
        nonlocal value, going
        value = np.where(going, mean[:, None], value)
        going = going & (count[:, None] >= np.array(forest.min_splits)[None, :])
        if depth in forest.depths:
            out[live, forest.depths.index(depth)] = value[at]

    def stay(depth, stop):
        """Test rows ``stop`` go no deeper."""
        ends = value[at[stop]]
        for i, d in enumerate(forest.depths):
            if d > depth:
                out[live[stop], i] = ends

    depth, heap = -1, np.array([node])
    for depth, (count, mean) in enumerate([*above, *([leaf] if leaf else [])]):
        settle(depth, np.array([count]), np.array([mean]))
    depth = len(above)
    if leaf is None:
        train = _Drawn.of(cells.x, draws, forest.bins)
        w, y = np.array([train.wy.real.sum()]), np.array([train.wy.imag.sum()])
    while leaf is None and (len(live) or len(train.pos)):
        k = len(heap)
        rows, squares = train.sums(k)
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = y / w
            spread = squares - y * mean
        settle(depth, rows, mean)
        if depth >= max(forest.depths):
            break
        split = forest.splittable(family, rows) & (spread > ROUNDING * squares)
        if not split.any():
            break
        renumber = np.where(split, np.cumsum(split) - 1, -1)
        heap = heap[split]
        allowed = features_of(number, heap, p, forest.drawn(family))
        train.renumber(renumber, len(heap))
        hist = train.histograms(len(heap), min_leaf > 1)
        feature, cut = choose(iter(hist.transpose(1, 0, 2, 3)), allowed, min_leaf)
        inside = np.flatnonzero(feature >= 0)
        if not len(inside):
            break
        split[split] = feature >= 0
        keep = split[at]
        if not keep.all():
            stay(depth, ~keep)
            live, at = live[keep], at[keep]
        value, going = np.repeat(value[split], 2, axis=0), np.repeat(going[split], 2, axis=0)
        at = renumber[at]
        child = np.full(len(heap), -1)
        child[inside] = 2 * np.arange(len(inside))
        at = child[at] + (test[live, feature[at]] > cut[at])
        left = hist[-2:, feature[inside], inside].cumsum(axis=2)
        whole, left = left[..., -1], left[:, np.arange(len(inside)), cut[inside]]
        w, y = np.stack([left, whole - left], axis=2).reshape(2, -1)
        heap = np.stack([2 * heap[inside], 2 * heap[inside] + 1], axis=1).ravel()
        train.descend(feature, cut, child, len(heap))
        depth += 1
    stay(depth, np.ones(len(live), bool))
    return out.reshape(len(test), len(forest.depths) * len(forest.min_splits))


class _Drawn:
    """The code vectors that a tree draws, with the node of each; those on no node that goes on have the last number
    and go once they are many."""

    def __init__(self, codes: Codes, flat: np.ndarray, wy: np.ndarray, squares: np.ndarray):
        # weight and weighted target; rows and weighted squares: two values a vector, as complex numbers
        self.codes, self.flat, self.wy, self.squares = codes, flat, wy, squares
        self.pos = np.zeros(len(wy), np.int64)

    @staticmethod
    def of(x: np.ndarray, draws: tuple[np.ndarray, ...], bins: int) -> "_Drawn":
        use = np.flatnonzero(draws[0])
        x = x[use]
        rows, w, wy, wyy = (v[use] for v in draws)
        return _Drawn(Codes(x, bins), x, w + 1j * wy, rows + 1j * wyy)

    def sums(self, nodes: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and weighted squares by node."""
        out = np.zeros(nodes + 1, complex)
        np.add.at(out, self.pos, self.squares)
        return out.real[:nodes], out.imag[:nodes]

    def histograms(self, nodes: int, rows: bool) -> np.ndarray:
        """([rows,] weight, weighted target; feature, node, bin) sums."""
        sums, counts = self.codes.empty(nodes + 1), self.codes.empty(nodes + 1, float) if rows else None
        for lo in range(0, len(self.pos), PIECE):
            hi = min(lo + PIECE, len(self.pos))
            self.codes.add(sums, lo, hi, self.pos[lo:hi], self.wy)
            if rows:
                self.codes.add(counts, lo, hi, self.pos[lo:hi], self.squares.real)
        hist = self.codes.histograms(sums, nodes)
        return np.stack([*([self.codes.histograms(counts, nodes)] if rows else []), hist.real, hist.imag])

    def renumber(self, number: np.ndarray, nodes: int) -> None:
        """Nodes get new numbers, those with -1 do not go on."""
        if nodes < len(number):
            self.pos = np.append(np.where(number < 0, nodes, number), nodes)[self.pos]
            self._drop(nodes)

    def descend(self, feature: np.ndarray, cut: np.ndarray, child: np.ndarray, nodes: int) -> None:
        """To the children: the left ones' numbers, -1 where a node is not split."""
        p, gone = self.codes.p, child < 0
        feature, cut = np.append(np.where(gone, 0, feature), 0), np.append(np.where(gone, 255, cut), 255).astype(np.uint8)
        child, first, flat = np.append(np.where(gone, nodes, child), nodes), np.arange(0, PIECE * p, p), self.flat.ravel()
        for lo in range(0, len(self.pos), PIECE):
            now = self.pos[lo:lo + PIECE]
            code = flat[lo * p:(lo + PIECE) * p].take(first[:len(now)] + feature.take(now, mode="clip"), mode="clip")
            now[:] = child.take(now, mode="clip") + (code > cut.take(now, mode="clip"))
        if gone.any():
            self._drop(nodes)

    def _drop(self, nodes: int) -> None:
        keep = self.pos < nodes
        if 4 * np.count_nonzero(keep) < 3 * len(keep):
            self.codes = self.codes.take(keep)
            self.flat, self.wy, self.squares, self.pos = (v[keep] for v in (self.flat, self.wy, self.squares, self.pos))


# large nodes: a level at a time over all blocks -------------------------------------------------------
@dataclass
class Top:
    """The nodes above ``local_rows`` of one tree: heap number -> (rows, weight, sum, feature, bin); feature
    -1: a leaf, None: not known yet.  Children of a split that are missing here are small."""
    nodes: dict[int, list] = field(default_factory=dict)

    def walk(self, x: np.ndarray) -> np.ndarray:
        """The node that each row ends in: a leaf, an unknown node, or a small one."""
        at = np.ones(len(x), np.int64)
        heaps = np.array(sorted(h for h, s in self.nodes.items() if s[3] is not None and s[3] >= 0), np.int64)
        if not len(heaps):
            return at
        feature = np.array([self.nodes[h][3] for h in heaps.tolist()])
        cut = np.array([self.nodes[h][4] for h in heaps.tolist()])
        while True:
            i = np.minimum(np.searchsorted(heaps, at), len(heaps) - 1)
            on = np.flatnonzero(heaps[i] == at)
            if not len(on):
                return at
            i = i[on]
            at[on] = 2 * at[on] + (x[on, feature[i]] > cut[i])

    def above(self, node: int) -> list[tuple[float, float]]:
        path = [node >> d for d in range(node.bit_length() - 1, 0, -1)]
        return [(self.nodes[h][0], self.nodes[h][2] / self.nodes[h][1]) for h in path]


def _level_histograms(batches, tops: dict, forest: Forest):
    """Histograms of the nodes not known yet, per block; key: (family, fold, tree, node)."""
    schema = pa.schema([("family", pa.int32()), ("fold", pa.int32()), ("tree", pa.int32()), ("node", pa.int64()), ("hist", pa.binary())])
    for batch in batches:
        rows = Rows.of(batch, forest.p)
        out = []
        for (family, fold, tree), top in tops.items():
            wanted = np.array([h for h, s in top.nodes.items() if s[3] is None], np.int64)
            if not len(wanted):
                continue
            w = np.where(rows.trains >> fold & 1 == 1, weights(rows.key, forest.number(family, fold, tree), forest.bootstrap), 0.0)
            use = np.flatnonzero(w > 0)
            x, w, wy = rows.x[use], w[use], (w * rows.y)[use]
            at = top.walk(x)
            for h in wanted.tolist():
                r = np.flatnonzero(at == h)
                if len(r):
                    zero = np.zeros(len(r), np.int64)
                    hist = np.stack([histogram(x[r, f], zero, w[r], wy[r], 1, forest.bins, np.ones(len(r)))[:, 0] for f in range(forest.p)])
                    out.append((family, fold, tree, h, hist.tobytes()))
            if len(out) >= 200:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def _level_splits(batches, forest: Forest):
    """Sums of each node's histograms, its split, and the rows of its children."""
    names = ["family", "fold", "tree", "node", "feature", "bin", "stats"]

    def row(key, hist):
        family, fold, tree, node = key
        allowed = features_of(forest.number(family, fold, tree), np.array([node]), forest.p, forest.drawn(family))
        whole = hist[0].sum(axis=1)
        feature, cut = choose((h[:, None] for h in hist), allowed, forest.families[family][0])
        f, b = int(feature[0]), int(cut[0])
        left = hist[f, :, :b + 1].sum(axis=1) if f >= 0 else whole * 0
        return (*key, f, b, [*whole.tolist(), *left.tolist()])

    def record(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
            pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.float64())))], names)

    now, total = None, None
    for batch in batches:
        out = []
        for key, hist in zip(zip(*(batch.column(i).to_pylist() for i in range(4))), batch.column(4).to_pylist()):
            h = np.frombuffer(hist, float).reshape(forest.p, 3, forest.bins)
            if key == now:
                total = total + h
            else:
                if now is not None:
                    out.append(row(now, total))
                now, total = key, h
        if out:
            yield record(out)
    if now is not None:
        yield record([row(now, total)])


def grow_tops(blocks: DataFrame, sizes: dict[int, int], forest: Forest) -> dict[tuple, Top]:
    """The large nodes of every tree of the folds with more than ``local_rows`` training rows.

    One job a level; the driver gets one row per large node."""
    tops = {(fam, fold, t): Top({1: [0, 0, 0, None, 0]}) for fold, n in sizes.items() if n > forest.local_rows
            for fam in range(len(forest.families)) for t in range(forest.counts[-1])}
    for depth in range(max(forest.depths) + 1):
        if not any(s[3] is None for t in tops.values() for s in t.nodes.values()):
            break
        known = blocks.sparkSession.sparkContext.broadcast(tops)     # nodes above local_rows: rows / local_rows a level and tree
        hists = blocks.mapInArrow(lambda it: _level_histograms(it, known.value, forest),
                                  "family int, fold int, tree int, node long, hist binary")
        dealt = hists.repartition("family", "fold", "tree", "node").sortWithinPartitions("family", "fold", "tree", "node")
        for r in dealt.mapInArrow(lambda it: _level_splits(it, forest), "family int, fold int, tree int, node long, feature int, "
                                  "bin int, stats array<double>").collect():
            nodes = tops[r["family"], r["fold"], r["tree"]].nodes
            whole, left = np.array(r["stats"][:3]), np.array(r["stats"][3:])
            last = depth == max(forest.depths) or not forest.splittable(r["family"], whole[0])
            nodes[r["node"]] = [*whole.tolist(), -1 if last else r["feature"], r["bin"]]
            if nodes[r["node"]][3] >= 0:
                for child, s in ((2 * r["node"], left), (2 * r["node"] + 1, whole - left)):
                    if s[0] > forest.local_rows:
                        nodes[child] = [0, 0, 0, None, 0]
        known.unpersist()
    return tops


# small nodes: rows to one task -------------------------------------------------------------------------
_UNIT = "part int, family int, fold int, first int, last int, node long, x binary, y binary, key binary, trains binary, test binary"


def _route(batches, tops: dict, places: dict[tuple, int], parts: int, forest: Forest):
    """The rows of every unit: a group of whole trees, or a small node of one tree.  ``places``: the part of each group
    (family, fold, first, last)."""
    names = [c.split()[0] for c in _UNIT.split(", ")]

    def record(head, rows):
        place = places[head[:4]] if head[:4] in places else int(_mix(head[2] * 31 + head[4])) % parts
        return pa.RecordBatch.from_arrays([*[pa.array([v], t) for v, t in zip((place, *head), (pa.int32(),) * 5 + (pa.int64(),))],
                                           *[pa.array([b], pa.binary()) for b in rows.packed()]], names)

    for batch in batches:
        rows = Rows.of(batch, forest.p)
        for fold in range(forest.n_folds):
            mine = rows.take(np.flatnonzero((rows.trains >> fold & 1 == 1) | (rows.test == fold)))
            if not len(mine.y):
                continue
            for family, _, first, last in (u for u in places if u[1] == fold):
                if (family, fold, first) not in tops:
                    yield record((family, fold, first, last, 1), mine)
                    continue
                for tree in range(first, last):
                    w = weights(mine.key, forest.number(family, fold, tree), forest.bootstrap)
                    top = tops[family, fold, tree]
                    at = top.walk(mine.x)
                    for h in np.unique(at).tolist():
                        leaf = h in top.nodes
                        i = np.flatnonzero((at == h) & ((mine.test == fold) | ((w > 0) & (not leaf))))
                        if len(i):
                            yield record((family, fold, tree, tree + 1, h), mine.take(i))


def _finish(batches, tops: dict, forest: Forest, scale: float = 0.0, packed: bool = False):
    """Predictions of the test rows of every unit, summed over its trees; units come sorted together.  With ``scale``
    units hold all trees of a family, and their mean squared errors by number of trees and set are returned.  With
    ``packed`` units are whole trees, and their sums are returned by pieces of rows (``_SUMS``)."""
    held, now = [], None

    def settle():
        family, fold, first, last, node = now
        squares: dict = dict.fromkeys(forest.counts) if scale else {}
        rows = Rows.of(pa.Table.from_batches(held), forest.p)
        held.clear()
        if not (rows.test == fold).any():
            return              # nothing to predict here
        if packed:
            rows = rows.take(np.argsort(rows.key, kind="stable"))
        test, cells, total = rows.test == fold, Cells.of(rows, fold, forest.bins), 0.0
        asked, place = cells.asked()
        for tree in range(first, last):
            top = tops.get((family, fold, tree))
            s = top.nodes.get(node) if top else None
            number = forest.number(family, fold, tree)
            total = total + grow(cells, cells.drawn(number, forest.bootstrap), asked, family, number, forest, node, top.above(node) if top else (),
                                 (s[0], s[2] / s[1]) if s else None)
            if tree + 1 in squares and not top:
                e = (total / ((tree + 1) * scale))[place] - (rows.y[test] / scale)[:, None]
                squares[tree + 1] = (e * e).mean(axis=0)
        if squares:
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([v], pa.int32()) for v in (family, fold)], pa.array([int(test.sum())], pa.int64()),
                 pa.array([[v for n in forest.counts for v in squares[n].tolist()]], pa.list_(pa.float64()))], ["family", "fold", "n_test", "mse"])
            return
        if packed:
            # rows of a fold lie alike in all its units: those of the first trees bring keys and targets
            key, y = (rows.key[test], rows.y[test]) if first == 0 else (rows.key[:0], rows.y[:0])
            for lo in range(0, len(place), PIECE):
                hi = lo + PIECE
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array([v], pa.int32()) for v in (family, fold, lo // PIECE, first, last)],
                     *[pa.array([v.tobytes()], pa.binary()) for v in (key[lo:hi], y[lo:hi], total[place[lo:hi]])]],
                    ["family", "fold", "piece", "first", "last", "key", "y", "sums"])
            return
        total = total[place]
        n, width = int(test.sum()), len(forest.depths) * len(forest.min_splits)
        counts = np.searchsorted(forest.counts, first, side="right")
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, family, np.int32)), pa.array(np.full(n, fold, np.int32)), pa.array(np.full(n, counts, np.int32)),
                 pa.array(rows.key[test]), pa.array(rows.y[test]),
                 pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(total.ravel()))],
                ["family", "fold", "part", "key", "y", "sums"])

    for batch in batches:
        for i in range(batch.num_rows):
            key = tuple(batch.column(j)[i].as_py() for j in range(1, 6))
            if key != now and held:
                yield from settle()
                held = []
            now = key
            held.append(batch.slice(i, 1))
    if held:
        yield from settle()


_SUMS = "family int, fold int, piece int, first int, last int, key binary, y binary, sums binary"


def _added(batches, forest: Forest, scale: float, errors: bool):
    """The sums of each piece of rows over all its trees, by number of trees and set: predictions (family, fold, key, y,
    p), or their squared errors added up (family, fold, n, squares).  Pieces come sorted by first tree."""
    width, total = len(forest.depths) * len(forest.min_splits), 0.0
    for batch in batches:
        for family, fold, _, first, last, key, y, sums in zip(*(c.to_pylist() for c in batch.columns)):
            if first == 0:
                total, found = 0.0, []
                keys, known = np.frombuffer(key, np.int64), np.frombuffer(y, float) / scale
            total = total + np.frombuffer(sums, float).reshape(-1, width)
            if last in forest.counts:
                found.append(total / (last * scale))
            if last < forest.counts[-1]:
                continue
            n, p = len(keys), np.concatenate(found, axis=1)
            if errors:
                e = p - known[:, None]
                yield pa.RecordBatch.from_arrays([pa.array([family], pa.int32()), pa.array([fold], pa.int32()), pa.array([n], pa.int64()),
                                                  pa.array([(e * e).sum(axis=0).tolist()], pa.list_(pa.float64()))], ["family", "fold", "n", "squares"])
                continue
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, family, np.int32)), pa.array(np.full(n, fold, np.int32)), pa.array(keys), pa.array(known),
                 pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * p.shape[1]), pa.array(p.ravel()))],
                ["family", "fold", "key", "y", "p"])


def _groups(counts: tuple, most: int) -> list[tuple[int, int]]:
    """Trees in groups of at most ``most`` that end with each of ``counts``."""
    groups, at = [], 0
    for n in counts:
        groups += [(i, min(i + most, n)) for i in range(at, n, most)]
        at = n
    return groups


def _together(sums: DataFrame, forest: Forest, scale: float, errors: bool) -> DataFrame:
    """``_SUMS`` of all groups of trees added up."""
    piece = ["family", "fold", "piece"]
    schema = "family int, fold int, n long, squares array<double>" if errors else "family int, fold int, key long, y double, p array<double>"
    return sums.repartition(*piece).sortWithinPartitions(*piece, "first").mapInArrow(lambda it: _added(it, forest, scale, errors), schema)


# the operator ------------------------------------------------------------------------------------------------
def binned_blocks(rows: DataFrame, features: Sequence[str], target: str, n_folds: int, key: str = "row_key", bins: int = BINS,
                  trains: str = "trains", test: str = "test_fold"):
    """Blocks of binned rows, written once; the scale of their targets; per fold the training rows and their mean
    target.  Rows with a null feature are left out; rows without a target train nothing."""
    whole = F.lit(True)
    for c in features:
        whole = whole & F.col(f"`{c}`").isNotNull()
    y = F.col(f"`{target}`").cast("double")
    rows = rows.where(whole).withColumn(trains, F.when(y.isNull(), 0).otherwise(F.col(trains)))
    edges = bin_edges(rows, features, bins)
    in_fold = [F.col(trains).bitwiseAND(F.lit(1 << f)) != 0 for f in range(n_folds)]
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(y)).alias("most"), *[F.count(F.when(b, 1)).alias(f"n{f}") for f, b in enumerate(in_fold)],
                     *[F.avg(F.when(b, y)).alias(f"m{f}") for f, b in enumerate(in_fold)]).first()    # one row
    # targets become integers small enough for exact sums in doubles
    room = 52 - math.ceil(math.log2(max(facts["n"] or 1, 1) + 1)) - 3
    scale = 2.0 ** (min(room, 40) - math.ceil(math.log2(max(float(facts["most"] or 0), 1e-9))))
    blocks = stage(rows.select(*[F.col(f"`{c}`").cast("double").alias(f"f{j}") for j, c in enumerate(features)],
                               F.coalesce(y, F.lit(0.0)).alias("y"), F.col(key).cast("long").alias("key"),
                               F.col(trains).cast("int").alias("trains"), F.coalesce(F.col(test), F.lit(-1)).cast("int").alias("test"))
                   .mapInArrow(lambda it: _pack(it, edges, scale), _PACKED), "tree_blocks")
    sizes = {f: int(facts[f"n{f}"] or 0) for f in range(n_folds)}
    return blocks, scale, sizes, {f: float(facts[f"m{f}"] or 0.0) for f in range(n_folds)}


def _prepared(rows: DataFrame, features: Sequence[str], target: str, grid: dict, n_folds: int, key: str = "row_key", trains: str = "trains",
              test: str = "test_fold", seed: int = 42, bootstrap: bool = True, bins: int = BINS, local_rows: int = LOCAL_ROWS):
    """(blocks, scale, training rows by fold, forest, sets) of a run of ``forest_predictions``."""
    feats = list(features)
    given = {"n_estimators": [100], "max_depth": [5], "min_samples_split": [2], "min_samples_leaf": [1], "max_features": [1.0]} | grid
    blocks, scale, sizes, _ = binned_blocks(rows, feats, target, n_folds, key, bins, trains, test)
    forest = Forest(tuple((int(a), float(b)) for a in given["min_samples_leaf"] for b in given["max_features"]),
                    tuple(sorted(int(d) for d in given["max_depth"])), tuple(sorted(int(m) for m in given["min_samples_split"])),
                    tuple(sorted(int(n) for n in given["n_estimators"])), n_folds, len(feats), seed, bootstrap, local_rows, bins)
    width, sets = len(forest.min_splits), []
    for params in param_grid(given):
        family = forest.families.index((int(params["min_samples_leaf"]), float(params["max_features"])))
        i = forest.depths.index(int(params["max_depth"])) * width + forest.min_splits.index(int(params["min_samples_split"]))
        sets.append((params, f"{family}:p{forest.counts.index(int(params['n_estimators']))}_{i}"))
    return blocks, scale, sizes, forest, sets


def forest_predictions(rows: DataFrame, features: Sequence[str], target: str, grid: dict, n_folds: int,
                       **kw) -> tuple[DataFrame, list[tuple[dict, str]], Forest]:
    """Predictions of every parameter set for the test rows of every fold.

    ``rows``: features, target, ``key`` (a distinct long per row), ``trains`` (bit mask of the folds that the
    row trains) and ``test`` (the fold that tests it, or null).  ``grid``: ``n_estimators``, ``max_depth``,
    ``min_samples_split``, ``min_samples_leaf``, ``max_features``, each a list (defaults 100, 5, 2, 1, 1.0).
    Returns (family, fold, key, y, one column per set of a family), the sets as (parameters,
    "family:column"), and the forest."""
    return _predicted(*_prepared(rows, features, target, grid, n_folds, **kw))


def _units(blocks: DataFrame, tops, groups: list[tuple[int, int]], sizes: dict[int, int], forest: Forest, parts: int) -> DataFrame:
    """The rows of every unit together; units of much work come in the first parts, one in each if there are enough."""
    units = [(family, fold, *g) for family in range(len(forest.families)) for fold in range(forest.n_folds) for g in groups]
    units.sort(key=lambda u: -sizes[u[1]] * (u[3] - u[2]) * forest.drawn(u[0]))
    places = {u: i % parts for i, u in enumerate(units)}
    return blocks.mapInArrow(lambda it: _route(it, tops.value, places, parts, forest), _UNIT) \
        .repartitionById(parts, F.col("part")).sortWithinPartitions("family", "fold", "first", "last", "node")


def _predicted(blocks: DataFrame, scale: float, sizes: dict[int, int], forest: Forest, sets: list[tuple[dict, str]]):
    tops = grow_tops(blocks, sizes, forest)
    width = len(forest.depths) * len(forest.min_splits)
    most = min(GROUP, _share(blocks, sizes, forest))
    groups = _groups(forest.counts, most)
    spark = blocks.sparkSession
    known = spark.sparkContext.broadcast(tops)
    n_units = len(groups) * len(forest.families) * forest.n_folds
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_units // 8 + sum(sizes.values()) // forest.local_rows + 1)
    if not tops and max(sizes.values()) > SPLIT_ROWS:
        parts = n_units
    if not tops:
        sums = _units(blocks, known, groups, sizes, forest, parts).mapInArrow(lambda it: _finish(it, {}, forest, packed=True), _SUMS)
        p = stage(_together(sums, forest, scale, False), "tree_predictions")
        columns = [F.col("p")[j * width + i].alias(f"p{j}_{i}") for j in range(len(forest.counts)) for i in range(width)]
        return p.select("family", "fold", "key", "y", *columns), sets, forest
    sums = _units(blocks, known, groups, sizes, forest, parts).mapInArrow(lambda it: _finish(it, known.value, forest),
                            "family int, fold int, part int, key long, y double, sums array<double>")
    sums = stage(sums, "tree_sums")
    parts_of = [F.coalesce(F.sum(F.when(F.col("part") == j, F.col("sums")[i])), F.lit(0.0)).alias(f"s{j}_{i}")
                for j in range(len(forest.counts)) for i in range(width)]
    wide = sums.groupBy("family", "fold", "key").agg((F.max("y") / scale).alias("y"), *parts_of)
    columns = []
    for j, n in enumerate(forest.counts):
        for i in range(width):
            upto = sum((F.col(f"s{k}_{i}") for k in range(j + 1)), F.lit(0.0))
            columns.append((upto / (n * scale)).alias(f"p{j}_{i}"))
    return wide.select("family", "fold", "key", "y", *columns), sets, forest


def _share(blocks: DataFrame, sizes: dict[int, int], forest: Forest) -> int:
    """How many trees of a family and fold a task takes: all of them while folds are small, or families and folds enough
    for all cores."""
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    tasks = 1 if max(sizes.values()) <= SPLIT_ROWS else -(-cores // (len(forest.families) * forest.n_folds))
    return -(-forest.counts[-1] // tasks)


def forest_grid_scores(rows: DataFrame, features: Sequence[str], target: str, grid: dict, n_folds: int, **kw) -> DataFrame:
    """(grid_idx, params, fold, mse, n_test) of every set of a random-forest grid in every fold."""
    known = rows.where(F.col(f"`{target}`").isNotNull())
    blocks, scale, sizes, forest, sets = _prepared(known, features, target, grid, n_folds, **kw)
    width = len(forest.depths) * len(forest.min_splits)
    if max(sizes.values()) <= forest.local_rows:
        none, most = blocks.sparkSession.sparkContext.broadcast({}), _share(blocks, sizes, forest)
        if most >= forest.counts[-1]:
            parts, whole = len(forest.families) * n_folds, [(0, forest.counts[-1])]
            errors = _units(blocks, none, whole, sizes, forest, parts).mapInArrow(
                lambda it: _finish(it, {}, forest, scale), "family int, fold int, n_test long, mse array<double>")
        else:
            groups = _groups(forest.counts, most)
            parts, values = len(groups) * len(forest.families) * n_folds, range(len(forest.counts) * width)
            sums = _units(blocks, none, groups, sizes, forest, parts).mapInArrow(lambda it: _finish(it, {}, forest, packed=True), _SUMS)
            errors = _together(sums, forest, scale, True).groupBy("family", "fold").agg(
                F.sum("n").alias("n_test"), F.array(*[F.sum(F.col("squares")[i]) / F.sum("n") for i in values]).alias("mse"))
        errors = stage(errors, "tree_errors")
        names = F.array(*[F.lit(f"p{j}_{i}") for j in range(len(forest.counts)) for i in range(width)])
        long = errors.select("family", "fold", "n_test", F.explode(F.arrays_zip(names.alias("name"), "mse")).alias("_e")) \
            .select(F.concat_ws(":", "family", "_e.name").alias("place"), "fold", "n_test", "_e.mse")
    else:
        predicted, _, _ = _predicted(blocks, scale, sizes, forest, sets)
        columns = [c for c in predicted.columns if c[0] == "p"]
        errors = predicted.groupBy("family", "fold").agg(F.count(F.lit(1)).alias("n_test"),
                                                         *[F.avg((F.col(c) - F.col("y")) ** 2).alias(c) for c in columns])
        long = errors.select("family", "fold", "n_test", F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("mse")) for c in columns])).alias("_e")) \
            .select(F.concat_ws(":", "family", "_e.name").alias("place"), "fold", "n_test", "_e.mse")
    wanted = rows.sparkSession.createDataFrame([(i, json.dumps(p, sort_keys=True), c) for i, (p, c) in enumerate(sets)],
                                               "grid_idx int, params string, place string")
    return long.join(F.broadcast(wanted), "place").select("grid_idx", "params", "fold", "mse", "n_test")   # one row per set
