"""Jaccard join of documents on word n-grams, as a blocked sparse matrix product.

The incidence matrix has a row per class of equal documents and a column per n-gram (a 64-bit
hash of ``SHINGLE`` words).  Overlaps are entries of its product with its own transpose.  Never
is all of it formed:

1. Equal sets (size and 128-bit digest) are one class.  The same pass counts n-grams in
   ``BUCKETS`` hash buckets (a few MB, whatever the corpus); by these counts, then by hash, all
   columns are ordered, rare ones first.  Any order is right, a good one keeps columns short.
2. Two sets of sizes a and b link only if they share at least ``bound`` of either size, so the
   first few columns they share lie among each one's first ``size - bound + SHARE``: only those
   are posted.  Columns of up to ``list_size`` rows are multiplied in the tasks that hold them;
   pair counts are summed over the columns, and pairs below ``SHARE`` (or sizes that cannot
   link) are discarded.
3. Columns with more rows belong to large groups.  Each names a hub, and its rows are compared
   with it, which is linear.  Columns whose rows all are in one component then are done.  Others
   that share a row are one cluster.  In it columns are counted exactly and ordered anew, and
   columns of a single row leave their row's allowance: a row with more than a tenth of them can
   link with nothing.  What is posted then is treated as in 2.
4. Columns that are long even then are compared with hubs again.  The rows of those that still
   lie in several components are multiplied block by block: rows of two blocks of like sizes, columns in strips; overlaps
   accumulate strip after strip, and rows drop out as soon as no pair of theirs can reach its
   bound.  Pairs of blocks within the group's main component are left out.  A pair of blocks
   returns a spanning forest of its links.

Every link is confirmed on full sets; nothing is capped.  Step 4's block work grows with the
square of the rows outside the main component of a group whose rows share rare columns and yet
do not link to its hubs.

Null or empty text: empty set, linked with nothing, a component of its own.  Null ids are
compared with nothing and come back with a null component.  Rows of one id have one component
(the links of all their texts).  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_and_text, raw_bytes, text_chunks, write_table
from .components import connected_components
from .wordhash import mix, shingles

SHINGLE = 3
THRESHOLD = 90          # percent
SHARE = 4               # columns that a candidate pair must share among those posted
LIST = 32
BLOCK = 256
STRIP = 8192
SALTS = 16
BUCKETS = 1 << 20
CHUNK = 1 << 16         # buckets of one row of counts
BROADCAST_IDS = 1_000_000
_SECOND = np.uint64(0xA5A5A5A5A5A5A5A5)


# bounds ---------------------------------------------------------------------------------------
def bound(size):
    """Elements that a set must share with any set that it links with."""
    return -(-THRESHOLD * size // 100)


def may_link(a, b):
    """Whether sets of these sizes can link at all."""
    return 100 * np.minimum(a, b) >= THRESHOLD * np.maximum(a, b)


def linked(common, a, b):
    return 100 * common >= THRESHOLD * (a + b - common)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum()) if len(a) else 0


# passes over the texts ---------------------------------------------------------------------------
def _bucket(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(44)).astype(np.int64)


def _signed(values) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def _measured(batches):
    """Size and digest of each set; at the end of the task its n-grams by bucket, a row a chunk."""
    names = ["doc_id", "n_shingles", "d1", "d2", "chunk", "counts"]
    weight = np.zeros(BUCKETS, np.int64)
    for part in text_chunks(batches):
        sets = [shingles(t, SHINGLE) for t in raw_bytes(part)]
        weight += np.bincount(_bucket(np.concatenate(sets)), minlength=BUCKETS)
        none = pa.nulls(len(sets), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array([len(s) for s in sets], pa.int64()), _signed([mix(s).sum(dtype=np.uint64) for s in sets]),
             _signed([mix(s ^ _SECOND).sum(dtype=np.uint64) for s in sets]), none, pa.nulls(len(sets), pa.binary())], names)
    chunks, packed = [], []
    for c in range(0, BUCKETS, CHUNK):
        used = np.flatnonzero(weight[c:c + CHUNK])
        if len(used):
            chunks.append(c // CHUNK)
            packed.append(used.astype("<u2").tobytes() + weight[c + used].astype("<u4").tobytes())
    none = pa.nulls(len(chunks), pa.int64())
    yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(chunks, pa.int32()), pa.array(packed, pa.binary())], names)


def _added(batches):
    """Counts of each chunk, summed."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            n = len(counts) // 6
            into = total.setdefault(chunk, np.zeros(CHUNK, np.int64))
            into[np.frombuffer(counts, "<u2", n)] += np.frombuffer(counts, "<u4", n, 2 * n)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
                                     ["chunk", "counts"])


def column_weights(counts: DataFrame) -> np.ndarray:
    """How many n-grams fall into each bucket, of rows (chunk, counts).  Tasks' rows are summed by chunk, in
    parts, then once more: a row of 512 KB a chunk (8 MB in all) reaches the driver."""
    parts = counts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(4))).repartition("chunk", "salt").select("chunk", "counts")
    weight = np.zeros(BUCKETS, np.int64)
    for r in parts.mapInArrow(_added, "chunk int, counts binary").repartition("chunk").mapInArrow(_summed, "chunk int, counts binary").collect():
        weight[r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = np.frombuffer(r["counts"], np.int64)
    return np.minimum(weight, 2**31 - 1).astype(np.int32)


def _summed(batches):
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            total[chunk] = total.get(chunk, 0) + np.frombuffer(counts, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
                                     ["chunk", "counts"])


def _posted(batches, weight: np.ndarray):
    for part in text_chunks(batches):
        sizes, firsts = [], []
        for text in raw_bytes(part):
            s = shingles(text, SHINGLE)
            need = bound(len(s))
            firsts.append(s[np.lexsort((s, weight[_bucket(s)]))[:len(s) - need + min(SHARE, need)]])
            sizes.append(len(s))
        at = np.concatenate([[0], np.cumsum([len(f) for f in firsts])]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(at), _signed(np.concatenate(firsts)))],
            ["id", "n", "values"])


def _whole(batches):
    for part in text_chunks(batches):
        sets = [shingles(t, SHINGLE).tobytes() for t in raw_bytes(part)]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["id", "set"])


# short columns: pairs and their counts ---------------------------------------------------------------
def _column_pairs(batches, list_size: int):
    """(a, b, small, shared) of the pairs of every column; rows (value, id, n) come sorted by value."""
    value, ids, n = (np.zeros(0, np.int64) for _ in range(3))
    for batch in batches:
        if not batch.num_rows:
            continue
        old = min(len(value), list_size)            # a column's earlier rows
        value, ids, n = (np.concatenate([x[len(x) - old:], batch.column(i).to_numpy()]) for i, x in enumerate((value, ids, n)))
        left, right = [], []
        for d in range(1, list_size):
            i = np.flatnonzero(value[d:] == value[:-d]) if d < len(value) else np.zeros(0, np.int64)
            i = i[i + d >= old]                     # pairs of old rows were given before
            if not len(i):
                if d > old:
                    break
                continue
            left.append(i)
            right.append(i + d)
        if not left:
            continue
        i, j = np.concatenate(left), np.concatenate(right)
        ok = may_link(n[i], n[j]) & (ids[i] != ids[j])
        i, j = i[ok], j[ok]
        a, b, small = np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j]), np.minimum(n[i], n[j])
        order = np.lexsort((b, a))
        a, b, small = a[order], b[order], small[order]
        edge = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(a[edge]), pa.array(b[edge]), pa.array(small[edge]),
                                          pa.array(np.diff(np.append(edge, len(a))))], ["a", "b", "small", "shared"])


def short_column_pairs(lists: DataFrame, list_size: int) -> DataFrame:
    """Candidate pairs (a < b) of rows (value, id, n) of columns of at most ``list_size`` rows."""
    dealt = lists.select("value", "id", "n").repartition("value").sortWithinPartitions("value", "id")
    counts = dealt.mapInArrow(lambda it: _column_pairs(it, list_size), "a long, b long, small long, shared long")
    # a set of size s shares at least bound(s) columns, of which the first SHARE are posted
    need = F.least(F.lit(SHARE), F.ceil(THRESHOLD * F.col("small") / 100))
    return counts.groupBy("a", "b").agg(F.max("small").alias("small"), F.sum("shared").alias("shared")) \
        .where(F.col("shared") >= need).select("a", "b")


def _confirmed(batches):
    for batch in batches:
        a, b, one, two = (batch.column(i) for i in range(4))
        ok = []
        for i in range(batch.num_rows):
            x, y = np.frombuffer(one[i].as_buffer(), np.uint64), np.frombuffer(two[i].as_buffer(), np.uint64)
            ok.append(bool(linked(overlap(x, y), len(x), len(y))))
        ok = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([a.filter(ok), b.filter(ok)], ["u", "v"])


def confirm(pairs: DataFrame, sets: DataFrame, hubs: bool = False) -> DataFrame:
    """Links (u, v) among pairs (a, b), on full sets.  With ``hubs``, an a may have any number of pairs."""
    first = sets.select(F.col("id").alias("a"), F.col("set").alias("one"))
    keys = ["a"]
    if hubs:
        pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
        first = first.join(pairs.select("a").distinct(), "a", "left_semi") \
            .withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
        keys.append("salt")
    both = pairs.join(first, keys).join(sets.select(F.col("id").alias("b"), F.col("set").alias("two")), "b")
    return both.select("a", "b", "one", "two").mapInArrow(_confirmed, "u long, v long")


# long columns ----------------------------------------------------------------------------------------
def clusters(rows: DataFrame) -> DataFrame:
    """id, cluster: columns (value) that share a row (id) are one cluster, and so are their rows."""
    first = rows.groupBy("id").agg(F.min("value").alias("first"))
    same = rows.join(first, "id").where("value != first").select(F.col("first").alias("u"), F.col("value").alias("v"))
    of = connected_components(same)
    return first.join(of, F.col("first") == F.col("node"), "left").select("id", F.coalesce("component", "first").alias("cluster"))


def _columns(batches):
    """Rows (value, id, n) of every column of the sets; a column's number also tells its cluster."""
    for batch in batches:
        cluster, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for i in range(batch.num_rows):
            grams = np.frombuffer(batch.column(2)[i].as_buffer(), np.uint64)
            value = mix(grams + mix(cluster[i:i + 1].view(np.uint64)))
            yield pa.RecordBatch.from_arrays([_signed(value), pa.array(np.full(len(value), ids[i])), pa.array(np.full(len(value), len(value)))],
                                             ["value", "id", "n"])


def exact_postings(members: DataFrame, sets: DataFrame) -> DataFrame:
    """value, id, n, df: what must be posted of the clusters' rows, by exact counts in the cluster."""
    columns = members.join(sets, "id").select("cluster", "id", "set").mapInArrow(_columns, "value long, id long, n long")
    df = columns.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    own = Window.partitionBy("id")
    need = F.ceil(THRESHOLD * F.col("n") / 100)
    # columns of a single row come first and are not posted
    room = F.col("n") - need + F.least(F.lit(SHARE), need) - (F.col("n") - F.count("*").over(own))
    return columns.join(df, "value").withColumn("rank", F.row_number().over(own.orderBy("df", "value"))) \
        .withColumn("room", room).where("rank <= room").select("value", "id", "n", "df")


def _forest(ids: np.ndarray, sets: list[np.ndarray], label: np.ndarray):
    """Star edges of the components of the links between rows of different labels."""
    size = np.array([len(s) for s in sets])
    column, row = np.concatenate(sets), np.repeat(np.arange(len(ids)), size)
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    new = np.concatenate([[True], column[1:] != column[:-1]])
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    column, row = np.unique(column[shared], return_inverse=True)[1], row[shared]
    rest = np.bincount(row, minlength=len(ids))         # columns still to come, per row
    need = -(-THRESHOLD * (size[:, None] + size[None, :]) // (100 + THRESHOLD))
    open_ = (label[:, None] != label[None, :]) & may_link(size[:, None], size[None, :]) \
        & (np.minimum(rest[:, None], rest[None, :]) >= need)
    common = np.zeros(open_.shape, np.int64)
    for lo in range(0, int(column.max()) + 1 if len(column) else 0, STRIP):
        alive = np.flatnonzero(open_.any(axis=1))
        if not len(alive):
            break
        s, e = np.searchsorted(column, [lo, lo + STRIP])
        place = np.full(len(ids), -1)
        place[alive] = np.arange(len(alive))
        here = place[row[s:e]] >= 0
        grid = np.zeros((len(alive), STRIP), np.float32)
        grid[place[row[s:e]][here], column[s:e][here] - lo] = 1
        common[np.ix_(alive, alive)] += (grid @ grid.T).astype(np.int64)
        rest = rest - np.bincount(row[s:e], minlength=len(ids))
        open_ &= common + np.minimum(rest[:, None], rest[None, :]) >= need
    link = open_ & linked(common, size[:, None], size[None, :])
    root = np.arange(len(ids))
    while True:
        least = np.minimum(root, np.where(link, root[None, :], len(ids)).min(axis=1, initial=len(ids)))
        if (least == root).all():
            break
        root = least
    keep = root != np.arange(len(ids))
    return ids[root[keep]], ids[keep]


def _block_links(batches):
    """Links of every pair of blocks; rows (pair, id, label, set) come sorted by pair."""
    held: list[pa.RecordBatch] = []

    def settle():
        t = pa.Table.from_batches(held).combine_chunks()
        pair, ids, label = (t[c].to_numpy() for c in ("pair", "id", "label"))
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in t["set"]]
        edge = [0, *(np.flatnonzero(pair[1:] != pair[:-1]) + 1), len(pair)]
        for s, e in zip(edge[:-1], edge[1:]):
            u, v = _forest(ids[s:e], sets[s:e], label[s:e])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    for batch in batches:
        if not batch.num_rows:
            continue
        pair = batch.column(0).to_numpy()
        turns = np.flatnonzero(pair[1:] != pair[:-1]) + 1
        if held and held[-1].column(0)[-1].as_py() != pair[0]:
            yield from settle()
            held = []
        if len(turns):                              # the last pair may go on
            held.append(batch.slice(0, int(turns[-1])))
            yield from settle()
            held = [batch.slice(int(turns[-1]))]
        else:
            held.append(batch)
    if held:
        yield from settle()


def block_links(rows: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    """Links among rows (group, id, n, label) of a group with different labels, by blocks of like sizes."""
    tally = rows.groupBy("group", "label").agg(F.count("*").alias("rows")) \
        .groupBy("group").agg(F.max_by("label", F.struct("rows", "label")).alias("main"))
    # sets link only within a band of sizes or with the next band
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / THRESHOLD)) + 1e-9).cast("int")
    placed = rows.join(tally, "group").withColumn("other", F.col("label") != F.col("main")).withColumn("band", band)
    counts = placed.groupBy("group", "other", "band").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    blocks = counts.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    one = blocks.where("other").select("group", F.struct("band", "block", "other").alias("one"))
    two = blocks.select("group", F.struct("band", "block", "other").alias("two"))
    pairs = one.join(two, "group").where((F.abs(F.col("one.band") - F.col("two.band")) <= 1)
                                         & (~F.col("two.other") | (F.col("one") <= F.col("two"))))
    sides = pairs.withColumn("pair", F.xxhash64("group", "one", "two")) \
        .select("group", "pair", F.explode(F.array_distinct(F.array("one", "two"))).alias("side")) \
        .select("group", "pair", "side.band", "side.block", "side.other")
    keys = ["group", "other", "band"]
    dealt = placed.join(counts, keys).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")) \
        .join(sides, [*keys, "block"]).select("pair", "id", "label")
    dealt = dealt.join(sets, "id").select("pair", "id", "label", "set").repartition("pair").sortWithinPartitions("pair", "id")
    return dealt.mapInArrow(_block_links, "u long, v long")


def hub_links(posted: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of the rows (value, id, n) of long columns with their columns' hubs: the rows that lie in most of them."""
    weight = posted.groupBy("id").agg(F.count("*").alias("weight"))
    hubs = posted.join(weight, "id").groupBy("value").agg(F.max_by(F.struct("id", "n"), F.struct("weight", -F.col("id"))).alias("hub"))
    salted = hubs.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    near = posted.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(salted, ["value", "salt"]) \
        .where(F.col("id") != F.col("hub.id")) \
        .where(100 * F.least("n", "hub.n") >= THRESHOLD * F.greatest("n", "hub.n")) \
        .select(F.col("hub.id").alias("a"), F.col("id").alias("b")).distinct()
    return write_table(confirm(write_table(near, "hub-pairs"), sets, hubs=True), "hub-links")


def open_columns(posted: DataFrame, of: DataFrame) -> DataFrame:
    """value, id, n, label of the columns whose rows lie in several of the components ``of`` (node, component)."""
    labelled = write_table(posted.join(of, F.col("id") == F.col("node"), "left")
                           .select("value", "id", "n", F.coalesce("component", "id").alias("label")), "labelled")
    mixed = labelled.groupBy("value").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high")
    return write_table(labelled.join(mixed.select("value"), "value", "left_semi"), "open-columns")


def between(pairs: DataFrame, of: DataFrame) -> DataFrame:
    """The pairs (a, b) that lie in different components."""
    for c in ("a", "b"):
        pairs = pairs.join(of.select(F.col("node").alias(c), F.col("component").alias(f"_{c}")), c, "left")
    return pairs.where(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b")


# the operator -----------------------------------------------------------------------------------------
def links(texts: DataFrame, heads: DataFrame, weight: np.ndarray, list_size: int = LIST, block: int = BLOCK) -> DataFrame:
    """Links (u, v) between the classes named by ``heads`` (id)."""
    known = texts.sparkSession.sparkContext.broadcast(weight)           # 4 BUCKETS bytes
    drawn = texts.mapInArrow(lambda it: _posted(it, known.value), "id long, n long, values array<long>")
    posted = drawn.join(heads, "id", "left_semi").select("id", "n", F.explode("values").alias("value"))
    posted = write_table(posted, "ngram-postings")
    df = posted.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    posted = write_table(posted.join(df, "value"), "ngram-columns")
    pairs = write_table(short_column_pairs(posted.where(F.col("df") <= list_size), list_size), "ngram-pairs")
    hot = posted.where(F.col("df") > list_size).select("value", "id", "n")

    wanted = write_table(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(hot.select("id")).distinct(), "wanted")
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    sets = write_table(texts.withColumnRenamed("doc_id", "id").join(wanted, "id", "left_semi")
                       .select("id", "text").mapInArrow(_whole, "id long, set binary"), "ngram-sets")
    stars = hub_links(hot, sets)
    rest = open_columns(hot, write_table(connected_components(stars), "hub-components"))
    members = write_table(clusters(rest.select("value", "id")), "ngram-clusters")
    exact = write_table(exact_postings(members, sets), "exact-postings")
    more = short_column_pairs(exact.where(F.col("df") <= list_size), list_size)

    hot = exact.where(F.col("df") > list_size).select("value", "id", "n")
    stars = stars.union(hub_links(hot, sets))
    of = write_table(connected_components(stars), "hub-components")
    rest = open_columns(hot, of)
    group = clusters(rest.select("value", "id")).withColumnRenamed("cluster", "group")
    rows = write_table(rest.select("id", "n", "label").distinct().join(group, "id"), "open-groups")
    left = write_table(between(pairs.union(more).distinct(), of), "candidates")
    return confirm(left, sets).union(stars).union(block_links(rows, sets, block))


def _spread(rows: DataFrame, small: DataFrame, keys: list[str], by: str, how: str = "inner") -> DataFrame:
    """Rows joined with the one row of their key, a key of very many rows dealt over SALTS tasks."""
    salted = small.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).join(salted, [*keys, "_salt"], how).drop("_salt")


def _of_unique_ids(texts: DataFrame, **sizes) -> DataFrame:
    measured = write_table(texts.mapInArrow(_measured, "doc_id long, n_shingles long, d1 long, d2 long, chunk int, counts binary"), "ngram-sizes")
    weight = column_weights(measured.where("chunk is not null").select("chunk", "counts"))
    rows = measured.where("chunk is null").select("doc_id", "n_shingles", "d1", "d2")
    usable = rows.where("doc_id is not null and n_shingles > 0")
    keys = ["n_shingles", "d1", "d2"]
    classes = write_table(usable.groupBy(*keys).agg(F.min("doc_id").alias("id"), F.count("*").alias("copies")), "ngram-classes")
    found = links(texts.where("doc_id is not null"), classes.select("id"), weight, **sizes)
    of = connected_components(found)
    named = classes.where("copies > 1").drop("copies")
    member = _spread(rows, named, keys, "doc_id", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("id", "doc_id")).alias("class_id"))
    of = of.where("node != component").select(F.col("node").alias("class_id"), "component")
    return _spread(member, of, ["class_id"], "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "class_id").alias("component_id"))


def components(docs: DataFrame, **sizes) -> DataFrame:
    """doc_id, n_shingles, component_id per document; ``list_size`` and ``block`` may be given."""
    texts = id_and_text(docs)
    if not texts.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count():
        return _of_unique_ids(texts, **sizes)
    # rows of repeated ids: components of the rows by numbers of their own, joined where they share an id
    rows = write_table(texts.withColumn("row", F.monotonically_increasing_id()), "ngram-rows")
    found = _of_unique_ids(rows.select(F.when(F.col("doc_id").isNotNull(), F.col("row")).alias("doc_id"), "text"), **sizes)
    found = write_table(found.select(F.col("doc_id").alias("row"), "n_shingles", F.col("component_id").alias("part")), "ngram-row-parts")
    member = write_table(rows.select("row", "doc_id").join(found, "row"), "ngram-members")
    held = member.where("doc_id is not null").groupBy("doc_id", "part").agg(F.count("*").alias("rows"))
    first = held.groupBy("doc_id").agg(F.min("part").alias("first"))
    same = _spread(held, first, ["doc_id"], "part").where("first != part").select(F.col("first").alias("u"), F.col("part").alias("v"))
    whole = connected_components(same)
    least = member.where("doc_id is not null").groupBy("part").agg(F.min("doc_id").alias("least"))
    least = least.join(whole, F.col("part") == F.col("node"), "left").select("part", "least", F.coalesce("component", "part").alias("whole"))
    names = least.groupBy("whole").agg(F.min("least").alias("component_id"))
    named = _spread(least, names, ["whole"], "part").select("part", "component_id")
    out = _spread(member.where("doc_id is not null"), named, ["part"], "row").select("doc_id", "n_shingles", "component_id")
    return out.union(found.where("row is null").select("row", "n_shingles", F.lit(None).cast("long")))
