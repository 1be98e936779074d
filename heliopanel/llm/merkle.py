"""Merkle manifest of a table, its hash trees stored in van Emde Boas order.

Leaves are the rows' digests; per group (language) they ascend by id and are hashed in pairs,
level by level, up to the group's subroot; the subroots, in the order of their groups, are
hashed alike up to the root.  A node left alone on a level is hashed alone.

The trees are cut into aligned blocks of ``2 ** HEIGHT`` leaves.  One row of a tier holds one
block: the digests of its subtree in van Emde Boas order (the top half of the levels first,
then each bottom half, each laid out alike), so that an address is arithmetic on (depth,
position) and a path touches few cache lines whatever their size.  The block roots are the
leaves of the next tier, until each group has one block.  Proofs go the other way: a block
hands its own path down to its nodes, which find their siblings in the block by address.

Every shuffle is by (group, block), or by ranges of (group, id), so a group of any size is
spread over all tasks; texts are read once and never shuffled.

Null columns are written ``-`` in a leaf; null groups and null ids come first; repeated ids are
ordered by their leaves (equal rows are interchangeable).  Rows with a null id are leaves like
any other.  An empty table gives an empty manifest and an empty result; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import write_table

HEIGHT = 10
SIZE = 32                       # bytes of a digest
LEFT, RIGHT, ALONE = 1, 0, 2    # where a node's sibling lies
TIER = "grp string, block long, total long, root binary, tree binary"


# one block ------------------------------------------------------------------------------------
def address(levels: int, depth: int, at):
    """Place of node ``at`` (an integer or an array of them) at ``depth`` in a tree of ``levels`` levels."""
    base = 0
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        levels -= top
        depth -= top
        base = base + (1 << top) - 1 + (at >> depth) * ((1 << levels) - 1)
        at = at & ((1 << depth) - 1)
    return base


def height_of(total: int, bits: int) -> int:
    """Levels above the leaves of a block of a tree with ``total`` leaves."""
    return min(bits, (total - 1).bit_length())


def parents(digests: list[bytes]) -> list[bytes]:
    """Digests of the next level: of every two nodes' hexadecimal digests, of the last one's if it is alone."""
    text = b"".join(digests).hex().encode()
    return [sha256(text[i:i + 4 * SIZE]).digest() for i in range(0, len(text), 4 * SIZE)]


def layout(digests: list[bytes], height: int) -> bytes:
    """The block's subtree over ``digests``, ``height`` levels high, in van Emde Boas order."""
    store = np.zeros(((2 << height) - 1, SIZE), np.uint8)
    for depth in range(height, -1, -1):
        store[address(height + 1, depth, np.arange(len(digests)))] = \
            np.frombuffer(b"".join(digests), np.uint8).reshape(-1, SIZE)
        if depth:
            digests = parents(digests)
    return store.tobytes()


def siblings(tree: bytes, height: int, leaves: int, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """From the leaves up: (side, digest) of the siblings of the nodes over leaves ``at``."""
    store = np.frombuffer(tree, np.uint8).reshape(-1, SIZE)
    for depth in range(height, 0, -1):
        other = at ^ 1
        side = np.where(other < leaves, np.where(at & 1, LEFT, RIGHT), ALONE)
        yield side, store[address(height + 1, depth, np.minimum(other, leaves - 1))]
        at, leaves = at >> 1, (leaves + 1) >> 1


# tiers of blocks ---------------------------------------------------------------------------------
def numbered(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Rows with ``at``, their place in the group by ``order`` (nulls first), and ``total``, its rows.

    Ranges of (group, order) are sorted apart and written; a table of one row per range and
    group holds the offsets."""
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())
    rows = write_table(rows, f"{name}-rows")
    keys = [group, *order, "_tie"]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_row", F.monotonically_increasing_id())
    ranged = write_table(ranged.drop("_tie"), f"{name}-ranged").withColumn("_part", F.shiftright("_row", 33))
    starts = ranged.groupBy(group, "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(group, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
                           F.sum("_n").over(whole).alias("total"))
    return ranged.join(starts, [group, "_part"]).withColumn("at", F.col("_row") + F.col("_shift")) \
        .drop("_row", "_part", "_shift")


def _blocks(batches, bits: int):
    """Tier rows; batches hold grp, at, total, digest, sorted by (grp, at)."""
    held: list[pa.RecordBatch] = []

    def flush():
        t = pa.Table.from_batches(held)
        at, total = t["at"].to_numpy(), t["total"].to_numpy()
        digests, groups = t["digest"].to_pylist(), t["grp"].to_pylist()
        edge = [*np.flatnonzero(at & ((1 << bits) - 1) == 0), len(at)]
        for s, e in zip(edge[:-1], edge[1:]):
            n = int(total[s])
            tree = layout(digests[s:e], height_of(n, bits))
            yield groups[s], int(at[s]) >> bits, n, tree[:SIZE], tree

    def record(rows):
        cols = list(zip(*rows)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                                          ["grp", "block", "total", "root", "tree"])

    for batch in batches:
        if not batch.num_rows:
            continue
        starts = np.flatnonzero(batch.column(1).to_numpy() & ((1 << bits) - 1) == 0)
        cut = int(starts[-1]) if len(starts) else 0         # the last block may go on in the next batch
        if len(starts) and (held or cut):
            held.append(batch.slice(0, cut))
            yield record(flush())
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield record(flush())


def tiers(nodes: DataFrame, name: str, bits: int) -> list[DataFrame]:
    """Tables of blocks (``TIER``) over nodes (grp, at, total, digest), each over the roots of the one before."""
    most = nodes.agg(F.max("total")).first()[0] or 0
    out: list[DataFrame] = []
    while most:
        dealt = nodes.select("grp", "at", "total", "digest").repartition("grp", F.shiftright("at", bits)) \
            .sortWithinPartitions("grp", "at")
        out.append(write_table(dealt.mapInArrow(lambda it: _blocks(it, bits), TIER), f"{name}-tier"))
        if most <= 1 << bits:
            break
        most = -(-most >> bits)
        nodes = out[-1].where(F.col("total") > 1 << bits).select(
            "grp", F.col("block").alias("at"), F.shiftright(F.col("total") + ((1 << bits) - 1), bits).alias("total"), F.col("root").alias("digest"))
    return out


def finished(tier: DataFrame, bits: int) -> DataFrame:
    """The blocks that are their group's whole tree."""
    return tier.where(F.col("total") <= 1 << bits)


@dataclass
class Manifest:
    """``rows``: grp, at, total, digest and the callers' columns; ``inner``: tiers of the groups'
    trees; ``outer``: tiers of the tree of subroots (its rows in ``subroots``); ``root``: hexadecimal;
    ``bits``: levels of a block."""
    rows: DataFrame
    inner: list[DataFrame]
    subroots: DataFrame | None
    outer: list[DataFrame]
    root: str | None
    bits: int


def manifest(rows: DataFrame, bits: int = HEIGHT) -> Manifest:
    """The manifest of rows (grp string, id, digest binary, and others that are kept)."""
    placed = numbered(rows, "grp", ["id", "digest"], "merkle")
    inner = tiers(placed, "merkle", bits)
    if not inner:
        return Manifest(placed, [], None, [], None, bits)
    tops = inner[0].where("false")
    for t in inner:
        tops = tops.unionByName(finished(t, bits))
    tops = numbered(tops.select(F.lit("").alias("grp"), F.col("grp").alias("of"), F.col("root").alias("digest")),
                    "grp", ["of"], "merkle-subroots")
    outer = tiers(tops, "merkle-top", bits)
    return Manifest(placed, inner, tops, outer, bytes(outer[-1].select("root").first()[0]).hex(), bits)


# proofs -------------------------------------------------------------------------------------------
def _under_blocks(batches, bits: int):
    """(rows, at, tree, height, leaves, above, subroot) of each run of nodes under one block.

    Rows come sorted by (grp, block, kind): the path above the block, the block, its nodes."""
    above, subroot, tree, total, block = b"", None, None, 0, 0
    for batch in batches:
        kind = batch.column(batch.schema.get_field_index("kind")).to_numpy()
        col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        i = 0
        while i < len(kind):
            if kind[i] == 0:
                above, subroot = col["path"][i].as_py(), col["subroot"][i].as_py()
            elif kind[i] == 1:
                tree, total, block = col["tree"][i].as_py(), col["total"][i].as_py(), col["block"][i].as_py()
            else:
                rest = np.flatnonzero(kind[i:] != 2)
                end = i + int(rest[0]) if len(rest) else len(kind)
                part = batch.slice(i, end - i)
                at = part.column(part.schema.get_field_index("at")).to_numpy() - (block << bits)
                yield part, at, tree, height_of(total, bits), min(1 << bits, total - (block << bits)), above, subroot
                i = end
                continue
            i += 1


def _paths(batches, bits: int):
    for part, at, tree, height, leaves, above, subroot in _under_blocks(batches, bits):
        steps = [np.concatenate([side.astype(np.uint8)[:, None], digest], axis=1)
                 for side, digest in siblings(tree, height, leaves, at)]
        own = np.concatenate(steps, axis=1) if steps else np.zeros((len(at), 0), np.uint8)
        # a group's subroot is the node that the tree above the groups holds for it
        tops = part.column(part.schema.get_field_index("digest")).to_pylist() if subroot is None else [subroot] * part.num_rows
        yield pa.RecordBatch.from_arrays(
            [part.column(part.schema.get_field_index("of")), part.column(part.schema.get_field_index("at")),
             pa.array([row.tobytes() + above for row in own], pa.binary()), pa.array(tops, pa.binary())],
            ["grp", "at", "path", "subroot"])


def _under(blocks: DataFrame, above: DataFrame, nodes: DataFrame, bits: int) -> DataFrame:
    """Blocks, the paths above them and the nodes below them, dealt by block and sorted for ``_under_blocks``."""
    both = above.select(F.lit(0).alias("kind"), "grp", F.col("at").alias("block"), "path", "subroot") \
        .unionByName(blocks.select(F.lit(1).alias("kind"), "grp", "block", "total", "tree"), allowMissingColumns=True) \
        .unionByName(nodes.withColumn("kind", F.lit(2)).withColumn("block", F.shiftright("at", bits)), allowMissingColumns=True)
    return both.repartition("grp", "block").sortWithinPartitions("grp", "block", "kind", "at")


def _descend(blocks: DataFrame, above: DataFrame, nodes: DataFrame, name: str, bits: int) -> DataFrame:
    """Paths to the root (grp, at, path, subroot) of nodes (grp, at, of, digest) under the blocks."""
    out = _under(blocks, above, nodes, bits).mapInArrow(lambda it: _paths(it, bits), "grp string, at long, path binary, subroot binary")
    return write_table(out, name)


def block_paths(m: Manifest) -> DataFrame:
    """grp, at, path, subroot: the path from each block of the first tier to the root.

    A path is a row of 33 bytes a level: the side of the sibling, and its digest."""
    spark = m.rows.sparkSession
    above = spark.createDataFrame([("", 0, b"", None)], "grp string, at long, path binary, subroot binary")
    for i in range(len(m.outer) - 1, 0, -1):
        nodes = m.outer[i - 1].select("grp", F.col("block").alias("at"), F.col("grp").alias("of"), F.col("root").alias("digest"))
        above = _descend(m.outer[i], above, nodes, "merkle-top-paths", m.bits)
    tops = m.subroots.select("grp", "at", "of", "digest")
    tops = _descend(m.outer[0], above.withColumn("subroot", F.lit(None).cast("binary")), tops, "merkle-subroot-paths", m.bits)
    tops = tops.withColumn("at", F.lit(0).cast("long"))
    above = tops.join(finished(m.inner[-1], m.bits).select("grp"), "grp", "left_semi")
    for i in range(len(m.inner) - 1, 0, -1):
        nodes = m.inner[i - 1].where(F.col("total") > 1 << m.bits) \
            .select("grp", F.col("block").alias("at"), F.col("grp").alias("of"), F.col("root").alias("digest"))
        above = _descend(m.inner[i], above, nodes, "merkle-paths", m.bits) \
            .unionByName(tops.join(finished(m.inner[i - 1], m.bits).select("grp"), "grp", "left_semi"))
    return above


def fold(leaf: bytes, sides: list[int], digests: list[bytes]) -> bytes:
    """Root over a leaf (hexadecimal, as all digests here) along its siblings."""
    for side, other in zip(sides, digests):
        leaf = sha256(other + leaf if side == LEFT else leaf + other if side == RIGHT else leaf).hexdigest().encode()
    return leaf


def _proofs(batches, bits: int):
    for part, at, tree, height, leaves, above, subroot in _under_blocks(batches, bits):
        own = [(side.tolist(), digest.tobytes().hex().encode()) for side, digest in siblings(tree, height, leaves, at)]
        step = SIZE + 1
        up_side = [above[i] for i in range(0, len(above), step)]
        up = [above[i + 1:i + step].hex().encode() for i in range(0, len(above), step)]
        col = {n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names) if n in ("digest", "other")}
        proofs, folded, w = [], [], 2 * SIZE
        for r, (leaf, other) in enumerate(zip(col["digest"], col["other"])):
            sides = [s[r] for s, _ in own] + up_side
            digests = [d[r * w:(r + 1) * w] for _, d in own] + up
            proofs.append(sha256(b"".join(d for s, d in zip(sides, digests) if s != ALONE)).hexdigest())
            folded.append(fold((other or leaf).hex().encode(), sides, digests).decode())
        n = part.num_rows
        yield pa.RecordBatch.from_arrays(
            [part.column(part.schema.get_field_index("id")), pa.array([x.hex() for x in col["digest"]]),
             pa.array([subroot.hex()] * n), pa.array(proofs), pa.array(folded)],
            ["doc_id", "leaf", "subroot", "proof_sha256", "folded_root"])


def prove(m: Manifest) -> DataFrame:
    """Per row of the manifest (with id, and ``other``: the digest offered in place of its own, or
    null): doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    schema = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"
    if m.root is None:
        found = m.rows.sparkSession.createDataFrame([], schema)
    else:
        nodes, m_bits = m.rows.select("grp", "at", "id", "digest", "other"), m.bits
        found = _under(m.inner[0], block_paths(m), nodes, m.bits).mapInArrow(lambda it: _proofs(it, m_bits), schema)
    root = F.lit(m.root).cast("string")
    return found.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
                        (F.col("folded_root") == root).alias("verified"))


# documents -------------------------------------------------------------------------------------------
def record(*columns: Column) -> Column:
    """Columns as one text: ``-`` for null, else the UTF-8 byte count, a colon, and the value."""
    texts = [c.cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def document_leaves(docs: DataFrame) -> DataFrame:
    """grp (order-keeping name of the language, null first), id, digest; and ``other``, the digest with
    n_chars one more, where 7 divides the crc32 of the id's decimal text."""
    n = F.col("n_chars").cast("decimal(20,0)")

    def leaf(chars):
        return F.unhex(F.sha2(record(F.col("doc_id"), F.col("source"), F.col("lang"), chars, F.col("text")).cast("binary"), 256))

    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return docs.select(F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("grp"), F.col("doc_id").cast("long").alias("id"),
                       leaf(n).alias("digest"), F.when(touched, leaf(n + 1)).alias("other"))


def tampering(docs: DataFrame, bits: int = HEIGHT) -> DataFrame:
    """Manifest of the documents, and the proof of each, offered as it is or with n_chars changed."""
    return prove(manifest(document_leaves(docs), bits))
