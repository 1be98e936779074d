"""Near-duplicate documents by bottom-k sketches from one hash function.

1. A document's set holds the 64-bit hashes of its distinct five-word shingles.  Equal sets
   (same size, same 128-bit digest) form a class; only one row per class goes on.
2. A class's sketch is its ``K`` least hashes.  Two sets of the wanted similarity share at
   least ``FLOOR`` of a sketch (for sets that fit into it, the threshold itself, exactly;
   else 5.5 standard deviations below it).  So of each sketch, ordered from the rarest value
   of the corpus to the most frequent, only the first ``size - needed + 1`` values need be
   posted: two such sets share one of them.  Values that occur once are dropped.
3. Inverted lists of up to ``LIST`` classes are compared in the tasks that hold them: the
   union sketch (the K least of both) estimates the similarity, and pairs under the floor
   end there.  What remains is confirmed on the full sets.
4. Longer lists belong to large groups of copies.  Lists that share a class make a cluster.
   In it every class is compared, on full sets, with one hub (the class whose sketch is most
   frequent); those that link are one component already.  The rest are compared in blocks,
   on full sets, skipping what the triangle inequality of the Jaccard distance rules out.
   A block pair returns a spanning forest of its links, never its pairs.
5. Components of the links, then of the classes' documents.

No candidate is dropped for the size of its list.  Full sets are made only for classes that
a list or a cluster asks for, in a second pass over their texts.

Null or empty text: empty set, linked with nothing, a component of its own.  Rows with a
null doc_id are compared with nothing and come back with a null component, kept.  Repeated
rows of an id are kept or dropped together: the links of all their texts are the id's.  An empty table gives an empty result; other
columns are ignored by ``near_duplicates`` and carried by ``drop_near_duplicates``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_and_text, raw_bytes, text_chunks, write_table
from .components import connected_components
from .wordhash import mix, shingles

SHINGLE = 5
THRESHOLD = 85          # percent
K = 64
SIGMAS = 5.5
FLOOR = THRESHOLD / 100 - SIGMAS * math.sqrt(THRESHOLD / 100 * (1 - THRESHOLD / 100) / K)
WHOLE = K * THRESHOLD // 100        # a set up to this size links only with sets that fit into a sketch
LIST = 64
BLOCK = 256
SALTS = 16
BROADCAST_IDS = 1_000_000
PAIRS_AT_ONCE = 20_000


def linked(common, size_a, size_b):
    return 100 * common >= THRESHOLD * (size_a + size_b - common)


# sets and sketches ---------------------------------------------------------------------------
def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _sketched(batches):
    for part in text_chunks(batches):
        sizes, one, two, heads = [], [], [], []
        for text in raw_bytes(part):
            s = shingles(text, SHINGLE)
            sizes.append(len(s))
            one.append(int(mix(s).sum(dtype=np.uint64)))
            two.append(int(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)))
            heads.append(np.sort(s)[:K])
        offsets = np.concatenate([[0], np.cumsum([len(h) for h in heads])]).astype(np.int32)
        flat = np.concatenate(heads) if heads else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(sizes, pa.int64()), _long(np.array(one, np.uint64)), _long(np.array(two, np.uint64)),
             pa.ListArray.from_arrays(pa.array(offsets), _long(flat))], ["doc_id", "n_shingles", "d1", "d2", "sketch"])


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, 128-bit digest of the set, and its K least hashes."""
    return id_and_text(docs).mapInArrow(
        _sketched, "doc_id long, n_shingles long, d1 long, d2 long, sketch array<long>")


def _sets(batches):
    for part in text_chunks(batches):
        sets = [shingles(t, SHINGLE).tobytes() for t in raw_bytes(part)]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["id", "set"])


def full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """id, set (sorted hashes) of the wanted documents: one more pass over the texts."""
    ids = write_table(ids.distinct(), "wanted")
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = id_and_text(docs).join(wanted, F.col("doc_id") == F.col("id"), "left_semi")
    rows = texts.mapInArrow(_sets, "id long, set binary")
    return write_table(rows, "sets")


def _repeats(docs: DataFrame) -> bool:
    """True if some doc_id occurs on several rows."""
    return bool(id_and_text(docs).where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count())


# grouped rows in a task ------------------------------------------------------------------------
def _groups(batches, key: str):
    """Record batches of whole groups: rows come sorted by ``key``; the last group is carried over."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        last = int(np.flatnonzero(k != k[-1])[-1]) + 1 if (k != k[-1]).any() else 0
        if held and (last or held[-1].column(held[-1].schema.get_field_index(key))[-1].as_py() != k[0]):
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = [batch.slice(last)]
        elif last:
            yield pa.Table.from_batches([batch.slice(0, last)])
            held = [batch.slice(last)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _runs(keys: np.ndarray):
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    return zip(edge[:-1], edge[1:])


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of each pair of sketches (rows of K sorted hashes, padded) by the union sketch."""
    pad = np.uint64(2**64 - 1)
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    again = np.zeros(both.shape, bool)
    again[:, 1:] = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != pad)
    fresh = np.cumsum(~again & (both != pad), axis=1)
    common = (again & (fresh <= K)).sum(axis=1)
    return common / np.maximum(np.minimum(K, fresh[:, -1]), 1)


def _near_pairs(batches):
    """Surviving pairs (a < b) of every list; rows: value, id, n_shingles, sketch."""
    for t in _groups(batches, "value"):
        t = t.combine_chunks()
        ids, sizes = t["id"].to_numpy(), t["n_shingles"].to_numpy()
        lists = t["sketch"].chunk(0)
        at = lists.offsets.to_numpy()
        flat = lists.values.to_numpy().view(np.uint64)
        heads = np.full((len(ids), K), 2**64 - 1, np.uint64)
        for i, (s, e) in enumerate(zip(at[:-1], at[1:])):
            heads[i, :e - s] = flat[s:e]
        left, right = [], []

        def flush():
            a, b = np.concatenate(left), np.concatenate(right)
            left.clear()
            right.clear()
            small, big = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
            fits = 100 * small >= THRESHOLD * big
            a, b = a[fits], b[fits]
            ok = estimate(heads[a], heads[b]) >= FLOOR
            a, b = ids[a[ok]], ids[b[ok]]
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        waiting = 0
        for s, e in _runs(t["value"].to_numpy()):
            i, j = np.triu_indices(e - s, 1)
            if len(i):
                left.append(i + s)
                right.append(j + s)
                waiting += len(i)
            if waiting >= PAIRS_AT_ONCE:
                yield flush()
                waiting = 0
        if waiting:
            yield flush()


def _confirmed(batches):
    """Links among pairs: rows sorted by a, the row with b null holding a's own set."""
    own, mine = None, None
    for batch in batches:
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        sets = batch.column(2)
        u, v = [], []
        for i in range(len(a)):
            s = np.frombuffer(sets[i].as_buffer(), np.uint64)
            if b[i] is None:
                own, mine = a[i], s
            elif own == a[i] and linked(_common(mine, s), len(mine), len(s)):
                u.append(a[i])
                v.append(b[i])
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _common(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum()) if len(a) else 0


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (u, v) among candidate pairs (a, b), on full sets."""
    # the partners of one class are spread over SALTS tasks; its own set goes where partners are
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    with_b = pairs.join(sets, pairs["b"] == sets["id"]).select("a", "salt", "b", "set")
    own = sets.join(pairs.select("a", "salt").distinct(), F.col("id") == F.col("a")) \
        .select("a", "salt", F.lit(None).cast("long").alias("b"), "set")
    rows = own.union(with_b).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return rows.select("a", "b", "set").mapInArrow(_confirmed, "u long, v long")


# large groups ------------------------------------------------------------------------------------
def _against_hub(batches):
    for batch in batches:
        cluster, ids, sets, hub, hub_sets = (batch.column(i) for i in range(5))
        share = []
        for i in range(batch.num_rows):
            a = np.frombuffer(sets[i].as_buffer(), np.uint64)
            b = np.frombuffer(hub_sets[i].as_buffer(), np.uint64)
            c = _common(a, b)
            share.append((c, len(a) + len(b) - c))
        common, union = zip(*share) if share else ((), ())
        yield pa.RecordBatch.from_arrays([cluster, ids, sets, hub, pa.array(common, pa.int64()), pa.array(union, pa.int64())],
                                         ["cluster", "id", "set", "hub", "common", "union"])


def _forest(ids: np.ndarray, sets: list[np.ndarray]):
    """Star edges of the components of links among the sets."""
    n, size = len(ids), np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    column = np.cumsum(np.concatenate([[False], values[1:] != values[:-1]]))
    often = np.bincount(column)[column] > 1
    owner, column = owner[often], np.unique(column[often], return_inverse=True)[1]
    common = np.zeros((n, n), np.float64)
    width = 8192
    for lo in range(0, int(column.max()) + 1 if len(column) else 0, width):
        s, e = np.searchsorted(column, [lo, lo + width])
        grid = np.zeros((n, width), np.float32)
        grid[owner[s:e], column[s:e] - lo] = 1
        common += grid @ grid.T
    link = linked(common, size[:, None], size[None, :])
    label = ids.copy()
    while True:
        least = np.where(link, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        new = np.minimum(label, least)
        if (new == label).all():
            break
        label = new
    keep = label != ids
    return label[keep], ids[keep]


def _block_links(batches):
    for t in _groups(batches, "pair"):
        ids, keys = t["id"].to_numpy(), t["pair"].to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in t["set"]]
        for s, e in _runs(keys):
            u, v = _forest(ids[s:e], sets[s:e])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def clusters(hot: DataFrame) -> DataFrame:
    """id, cluster, weight: long lists that share a class are one cluster."""
    first = hot.groupBy("id").agg(F.min("value").alias("first"), F.sum(F.log("df")).alias("weight"))
    edges = hot.join(first, "id").where("value != first").select(F.col("first").alias("u"), F.col("value").alias("v"))
    of = connected_components(edges.distinct())
    return first.join(of, first["first"] == of["node"], "left") \
        .select("id", F.coalesce("component", "first").alias("cluster"), "weight")


def large_group_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links within clusters: to the hub, then in blocks by distance from it."""
    salts = F.array(*[F.lit(i) for i in range(SALTS)])
    hubs = members.groupBy("cluster").agg(F.max_by("id", F.struct("weight", -F.col("id"))).alias("hub"))
    hub_sets = hubs.join(sets, hubs["hub"] == sets["id"]).select("cluster", "hub", F.col("set").alias("hub_set"),
                                                                  F.explode(salts).alias("salt"))
    rows = members.join(sets, "id").select("cluster", "id", "set", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt")) \
        .join(hub_sets, ["cluster", "salt"]).select("cluster", "id", "set", "hub", "hub_set")
    far = write_table(rows.mapInArrow(
        _against_hub, "cluster long, id long, set binary, hub long, common long, union long"), "hub-distances")
    near = 100 * F.col("common") >= THRESHOLD * F.col("union")
    step = 1 - THRESHOLD / 100
    distance = 1 - F.col("common") / F.col("union")
    far = far.withColumn("band", F.when(near, 0).otherwise(1 + F.floor((distance - step - 1e-9) / step)).cast("int"))
    star = far.where("band = 0 and id != hub").select(F.col("hub").alias("u"), F.col("id").alias("v"))

    counts = far.groupBy("cluster", "band").agg(F.count("*").alias("n"))
    blocks = counts.select("cluster", "band", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / BLOCK).cast("int") - 1)).alias("block"),
                           F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    a, b = blocks.alias("a"), blocks.alias("b")
    pairs = a.join(b, (F.col("a.cluster") == F.col("b.cluster"))
                   & (F.struct("a.band", "a.block") <= F.struct("b.band", "b.block"))
                   & (F.col("b.band") - F.col("a.band") <= 1) & (F.col("b.band") > 0))
    pairs = pairs.select(F.col("a.cluster").alias("cluster"),
                         F.xxhash64("a.cluster", "a.band", "a.block", "b.band", "b.block").alias("pair"),
                         F.explode(F.array_distinct(F.array(F.struct("a.band", "a.block"), F.struct("b.band", "b.block")))).alias("side")) \
        .select("cluster", "pair", "side.band", "side.block")
    sizes = blocks.select("cluster", "band", "blocks").distinct()
    placed = far.join(sizes, ["cluster", "band"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = placed.join(pairs, ["cluster", "band", "block"]).select("pair", "id", "set") \
        .repartition("pair").sortWithinPartitions("pair", "id")
    return star.union(dealt.mapInArrow(_block_links, "u long, v long"))


# the operator -------------------------------------------------------------------------------------
def postings(classes: DataFrame) -> DataFrame:
    """id, n_shingles, value, df: of each sketch the values that must be posted, rarest first."""
    values = classes.select("id", "n_shingles", F.size("sketch").alias("size"), F.explode("sketch").alias("value"))
    df = values.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    shared = values.join(df, "value")
    own = Window.partitionBy("id")
    order = own.orderBy("df", "value")
    floor = F.when(F.col("n_shingles") <= WHOLE, THRESHOLD / 100).otherwise(FLOOR)
    # the values that occur once come first; they link nothing
    room = F.col("size") - F.ceil(floor * F.col("size") - 1e-9) + 1 - (F.col("size") - F.count("*").over(own))
    return shared.withColumn("rank", F.row_number().over(order)).withColumn("room", room) \
        .where("rank <= room").select("id", "n_shingles", "value", "df")


def links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (u, v) between classes."""
    posted = write_table(postings(classes), "postings")
    lists = posted.where(f"df <= {LIST}").select("id", "value").join(classes.select("id", "n_shingles", "sketch"), "id") \
        .repartition("value").sortWithinPartitions("value", "id").select("value", "id", "n_shingles", "sketch")
    pairs = write_table(lists.mapInArrow(_near_pairs, "a long, b long").distinct(), "near-pairs")
    members = write_table(clusters(posted.where(f"df > {LIST}")), "clusters")
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(members.select("id"))
    sets = full_sets(docs, wanted)
    return confirm(pairs, sets).union(large_group_links(members, sets))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per document."""
    return _of_repeated_ids(docs) if _repeats(docs) else _of_unique_ids(docs)


def _spread(rows: DataFrame, small: DataFrame, key: str, by: str) -> DataFrame:
    """Rows joined with the one row of their key, a key of very many rows salted by another column."""
    salted = small.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    return rows.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).join(salted, [key, "salt"]).drop("salt")


def _of_repeated_ids(docs: DataFrame) -> DataFrame:
    """Every row under a number of its own; then the components that share an id become one."""
    rows = write_table(id_and_text(docs).withColumn("row", F.monotonically_increasing_id()), "rows")
    found = write_table(_of_unique_ids(rows.select(F.when(F.col("doc_id").isNotNull(), F.col("row")).alias("doc_id"), "text")),
                        "row-components")
    parts = found.select(F.col("doc_id").alias("row"), "n_shingles", F.col("component_id").alias("part"))
    member = write_table(rows.select("row", "doc_id").join(parts, "row"), "row-members")
    held = member.select("doc_id", "part").distinct()
    first = held.groupBy("doc_id").agg(F.min("part").alias("first"), F.max("part").alias("last")).where("first < last")
    same = _spread(held, first, "doc_id", "part").where("first != part").select(F.col("first").alias("u"), F.col("part").alias("v"))
    joined = connected_components(same)
    least = member.groupBy("part").agg(F.min("doc_id").alias("least"))
    least = least.join(joined, F.col("part") == F.col("node"), "left") \
        .select("part", "least", F.coalesce("component", "part").alias("whole"))
    names = least.groupBy("whole").agg(F.min("least").alias("component_id"))
    named = _spread(least, names, "whole", "part").select("part", "component_id")
    out = _spread(member, named, "part", "row").select("doc_id", "n_shingles", "component_id",
                                                       (F.col("doc_id") == F.col("component_id")).alias("kept"))
    return out.union(found.where("doc_id is null"))


def _of_unique_ids(docs: DataFrame) -> DataFrame:
    drawn = write_table(sketches(docs), "sketches")
    usable = drawn.where("doc_id is not null and n_shingles > 0")
    keys = ["n_shingles", "d1", "d2"]
    same = usable.groupBy(*keys).agg(F.min("doc_id").alias("id"), F.count("*").alias("copies"))
    copies = write_table(same.where("copies > 1").drop("copies"), "classes")     # at most half as many as documents
    salted = copies.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    member = drawn.drop("sketch").withColumn("salt", salt).join(salted, [*keys, "salt"], "left") \
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("id", "doc_id")).alias("class_id"))
    member = write_table(member, "members")
    heads = member.where("doc_id = class_id and n_shingles > 0").select(F.col("doc_id").alias("id")).distinct()
    classes = write_table(usable.join(heads, F.col("doc_id") == F.col("id"), "left_semi")
                          .select(F.col("doc_id").alias("id"), "n_shingles", "sketch"), "class-sketches")
    found = connected_components(links(docs, classes))
    # components are keyed by class: a class of very many copies is salted like above
    of = found.where("node != component").select(F.col("node").alias("class_id"), "component",
                                                 F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("salt"))
    out = member.withColumn("salt", salt).join(of, ["class_id", "salt"], "left")
    component = F.coalesce("component", "class_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents with one of each component left, with their own columns."""
    gone = write_table(near_duplicates(docs).where("not kept").select("doc_id").distinct(), "dropped")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
