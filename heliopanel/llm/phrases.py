"""Phrase collocations of two and three words, counted by stripes.

A stripe belongs to a word (the prefix) of a language and is an associative counter of what
comes next: entries (second, third word) with the number of places, an empty word standing for
the end of the piece.  Tasks make one stripe a word from each slice of texts and stripes are
merged elementwise, in any order.  A merged stripe holds all that is asked of it: its sum is the
word's count, sums over the third word are the counts of pairs, entries are those of triples,
and the greatest entry of a pair is the longest phrase that starts with it.

A first pass counts words by 65,536 hash buckets.  Words of a bucket with more than
``STRIPE_WORDS`` occurrences have their stripe dealt over as many parts as its share asks for (by
a hash of the next two words), so that no part grows with the corpus.  Merging holds one part and
a buffer of ``BUFFER`` entries.

Null language: ``und``.  Null or empty texts have no words.  Ids are not used, so repeated rows
count each; an empty table gives an empty result; other columns are ignored.  Long texts go in
slices cut at a piece's end; memory follows the longest piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import raw_bytes, text_chunks, write_table
from .wordhash import mix

LEAST = 10              # occurrences of a candidate
INSIDE = 50             # percent of a phrase's places inside a longer one, from which it is dropped
TOP = 2000
BUCKETS = 1 << 16
STRIPE_WORDS = 1 << 20
SLICE_BYTES = 8 << 20
BUFFER = 1 << 20
SALTS = 8
TOP_SALTS = 64
LINE_END = pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string())

_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# entries of a stripe: lines "second third", and their counts (one byte each, or eight)
STRIPE = "lang string, word string, part int, parts int, next string, n binary"


# texts to stripes ----------------------------------------------------------------------------
def words_of(text: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words, each word's number among them, and the number of breaks before it."""
    data = np.frombuffer(text, np.uint8)
    cut = _BREAK[data]
    word = ~(cut | _BLANK[data])
    edge = np.flatnonzero(np.diff(word.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    start, end = edge[::2], edge[1::2]
    piece = np.cumsum(cut)[start]
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=offsets[1:])
    letters = _LOWER[data[word]]
    words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(letters)).dictionary_encode()
    return words.dictionary.cast(pa.string()), words.indices.to_numpy().astype(np.int64), piece


def slices(text: bytes, limit: int = SLICE_BYTES) -> Iterator[bytes]:
    """The text in slices of about ``limit`` bytes that end with a break."""
    at = 0
    while len(text) - at > limit:
        end = at + limit
        while end < len(text):
            gap = np.flatnonzero(_BREAK[np.frombuffer(text, np.uint8, min(limit, len(text) - end), end)])
            if len(gap):
                end += int(gap[0]) + 1
                break
            end += limit
        yield text[at:end]
        at = min(end, len(text))
    if at < len(text):
        yield text[at:]


def texts_by_language(batches) -> Iterator[tuple[str, bytes]]:
    """(language, texts joined by a break) of every slice of the batches."""
    for part in text_chunks(batches, limit=SLICE_BYTES):
        by: dict[str, list[bytes]] = {}
        for lang, text in zip(part.column(0).to_pylist(), raw_bytes(part)):
            by.setdefault(lang, []).append(text)
        for lang, texts in by.items():
            for s in slices(b"\n".join(texts)):
                yield lang, s


def _hashes(words: pa.Array) -> np.ndarray:
    return np.array([zlib.crc32(w) for w in words.cast(pa.binary()).to_pylist()], np.uint64)


def _buckets(lang: str, hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes + np.uint64(zlib.crc32(lang.encode()) << 32)) % np.uint64(BUCKETS)).astype(np.int64)


def _weights(batches):
    """Words by bucket, and by language (bucket -1)."""
    bucket, langs = np.zeros(BUCKETS, np.int64), {}

    def rows(names, at, n):
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(at, pa.int32()), pa.array(n, pa.int64())],
                                          ["lang", "bucket", "n"])

    for lang, text in texts_by_language(batches):
        words, codes, _ = words_of(text)
        n = np.bincount(codes, minlength=len(words))
        np.add.at(bucket, _buckets(lang, _hashes(words)), n)
        langs[lang] = langs.get(lang, 0) + len(codes)
        if len(langs) > 10_000:
            yield rows(list(langs), [-1] * len(langs), list(langs.values()))
            langs = {}
    if langs:
        yield rows(list(langs), [-1] * len(langs), list(langs.values()))
    used = np.flatnonzero(bucket)
    yield rows([None] * len(used), used, bucket[used])


def _counted(keys: tuple[np.ndarray, ...], sizes: tuple[int, ...], n: np.ndarray | None = None):
    """The distinct rows of the key columns (each below its size) in order, and their sums of ``n`` (or counts)."""
    first, rest, width = keys[0], keys[1:], sizes[0]
    back = []
    for k, size in zip(rest, sizes[1:]):
        if width * size >= 2**62:                   # renumber what was joined so far
            known, first = np.unique(first, return_inverse=True)
            back.append(known)
            width = len(known)
        else:
            back.append(None)
        first = first * size + k
        width *= size
    if n is None:
        found, total = np.unique(first, return_counts=True)
    else:
        order = np.argsort(first, kind="stable")
        first = first[order]
        edge = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])) if len(first) else np.zeros(0, np.int64)
        found, total = first[edge], np.add.reduceat(n[order], edge) if len(edge) else n[:0]
    out = []
    for size, known in zip(sizes[:0:-1], back[::-1]):
        out.append(found % size)
        found = found // size
        if known is not None:
            found = known[found]
    return (found, *out[::-1]), total


def pack(starts: np.ndarray, second: pa.Array, third: pa.Array, n: np.ndarray) -> list[pa.Array]:
    """``next`` and ``n`` of stripes whose entries begin at ``starts``."""
    ends = np.append(starts, len(n)).astype(np.int32)
    lines = pc.binary_join_element_wise(second, third, " ")
    wide = len(n) > 0 and n.max() > 255
    counts = n.astype("<i8" if wide else np.uint8)
    size = pa.py_buffer((ends * counts.itemsize).astype(np.int32))
    return [pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), lines), "\n"),
            pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, size, pa.py_buffer(counts)])]


def unpack(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Of all entries: their row, numbers of the second and third word, count; and the words by number
    (number 0 is the empty word)."""
    lines = pc.binary_join_element_wise(t["next"].cast(pa.large_string()), *LINE_END).combine_chunks()
    if isinstance(lines, pa.ChunkedArray):
        lines = lines.chunk(0)
    at = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset:lines.offset + len(lines) + 1]
    data = np.frombuffer(lines.buffers()[2], np.uint8)[at[0]:at[-1]]
    mark = (data == 32) | (data == 10)              # a blank and a line end by turns
    place = np.flatnonzero(mark)
    offsets = np.zeros(len(place) + 2, np.int64)
    np.cumsum(np.diff(place, prepend=-1) - 1, out=offsets[2:])
    words = pa.LargeStringArray.from_buffers(len(place) + 1, pa.py_buffer(offsets), pa.py_buffer(data[~mark])).dictionary_encode()
    code = words.indices.to_numpy()[1:].astype(np.int64)
    entries = np.diff(np.searchsorted(place, at - at[0])) // 2
    row = np.repeat(np.arange(len(entries)), entries)

    counts = t["n"].cast(pa.large_binary()).combine_chunks()
    if isinstance(counts, pa.ChunkedArray):
        counts = counts.chunk(0)
    at = np.frombuffer(counts.buffers()[1], np.int64)[counts.offset:counts.offset + len(counts) + 1]
    raw = np.frombuffer(counts.buffers()[2], np.uint8)
    width = np.diff(at) // np.maximum(entries, 1)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(entries) - entries, entries)
    first = at[:-1][row] + inside * width[row]
    n = raw[first].astype(np.int64)
    wide = np.flatnonzero(width[row] == 8)
    n[wide] = np.ascontiguousarray(raw[first[wide, None] + np.arange(8)]).view("<i8").ravel()
    return row, code[::2], code[1::2], n, words.dictionary.cast(pa.string())


def _stripes(batches, parts: np.ndarray | None):
    """One stripe a word (and part) from each slice; ``parts`` of the buckets, or None if all are 1."""
    for lang, text in texts_by_language(batches):
        words, code, piece = words_of(text)
        if not len(code):
            continue
        end = len(words)
        second, third = np.full(len(code), end), np.full(len(code), end)
        second[:-1] = np.where(piece[1:] == piece[:-1], code[1:], end)
        third[:-2] = np.where(piece[2:] == piece[:-2], code[2:], end)
        (a, b, c), n = _counted((code, second, third), (end, end + 1, end + 1))
        share = part = np.zeros(len(a), np.int64)
        if parts is not None:
            h = _hashes(words)
            share = parts[_buckets(lang, h)][a]
            h = np.append(h, np.uint64(0))
            part = (mix(h[b] * np.uint64(0x9E3779B97F4A7C15) + h[c]) % share.astype(np.uint64)).astype(np.int64)
            order = np.lexsort((part, a))
            a, b, c, n, share, part = (x[order] for x in (a, b, c, n, share, part))
        starts = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (part[1:] != part[:-1])]))
        names = pa.concat_arrays([words, pa.array([""])])
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(starts), pa.string()), words.take(pa.array(a[starts])),
             pa.array(part[starts], pa.int32()), pa.array(np.maximum(share[starts], 1), pa.int32()),
             *pack(starts, names.take(pa.array(b)), names.take(pa.array(c)), n)],
            ["lang", "word", "part", "parts", "next", "n"])


# merging stripes -----------------------------------------------------------------------------------
def merged(t: pa.Table) -> tuple[pa.Table, tuple, np.ndarray, pa.Array]:
    """Stripes of equal (lang, word, part), which lie together, summed elementwise: the stripes' keys, and
    their entries as (stripe, second, third), counts, and the words that the numbers stand for."""
    new = np.zeros(len(t), bool)
    new[0] = True
    for name in ("lang", "word", "part"):
        col = t[name].combine_chunks()
        new[1:] |= pc.not_equal(col.slice(1), col.slice(0, len(t) - 1)).to_numpy(zero_copy_only=False)
    stripe = np.cumsum(new) - 1
    row, second, third, n, names = unpack(t)
    keys, n = _counted((stripe[row], second, third), (int(stripe[-1]) + 1, len(names), len(names)), n)
    return t.select(["lang", "word", "part", "parts"]).filter(pa.array(new)), keys, n, names


def _facts(heads: pa.Table, keys, n, names, least: int) -> pa.RecordBatch:
    """Counts of words, pairs and triples of whole stripes.  Those of a stripe in one part are final, so
    what stays below ``least`` goes; triples are final in any case."""
    row, second, third = keys
    whole = heads["parts"].to_numpy() == 1
    total = np.zeros(len(heads), np.int64)
    np.add.at(total, row, n)
    (prow, psecond), pn = _counted((row, second), (len(heads), len(names)), n)
    top = np.zeros(len(pn), np.int64)
    place = np.cumsum(np.concatenate([[False], (row[1:] != row[:-1]) | (second[1:] != second[:-1])]))
    np.maximum.at(top, place, np.where(third > 0, n, 0))
    w = np.flatnonzero(~whole | (total >= least))
    p = np.flatnonzero((psecond > 0) & (~whole[prow] | (pn >= least)))
    t = np.flatnonzero((third > 0) & (n >= least))
    rows = pa.array(np.concatenate([w, prow[p], row[t]]))
    empty = pa.nulls(len(w), pa.string())
    return pa.RecordBatch.from_arrays(
        [heads["lang"].combine_chunks().take(rows), heads["word"].combine_chunks().take(rows),
         pa.concat_arrays([empty, names.take(pa.array(np.concatenate([psecond[p], second[t]])))]),
         pa.concat_arrays([empty, pa.nulls(len(p), pa.string()), names.take(pa.array(third[t]))]),
         pa.array(np.concatenate([total[w], pn[p], n[t]]), pa.int64()),
         pa.array(np.concatenate([np.zeros(len(w), np.int64), top[p], np.zeros(len(t), np.int64)]), pa.int64())],
        ["lang", "w1", "w2", "w3", "n", "top"])


def _merge(batches, least: int):
    """Facts of stripes that come sorted by (lang, word, part)."""
    held, entries = [], 0

    def settle(last: bool):
        nonlocal held, entries
        heads, keys, n, names = merged(pa.Table.from_batches(held))
        done = len(heads) if last else len(heads) - 1       # the last stripe may go on
        if done:
            use = keys[0] < done
            yield _facts(heads.slice(0, done), tuple(k[use] for k in keys), n[use], names, least)
        rest = keys[0] >= done
        held = [] if last else [pa.RecordBatch.from_arrays(
            [*[heads[c].combine_chunks().slice(done) for c in ("lang", "word", "part", "parts")],
             *pack(np.zeros(1, np.int64), names.take(pa.array(keys[1][rest])), names.take(pa.array(keys[2][rest])), n[rest])],
            held[0].schema.names)]
        entries = 0

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            entries += batch.column(4).nbytes // 12          # about the bytes of an entry
        if entries >= BUFFER:
            yield from settle(False)
    if held:
        yield from settle(True)


# the operator -----------------------------------------------------------------------------------------
def _spread(rows: DataFrame, small: DataFrame, keys: list[str], by: Column) -> DataFrame:
    """Rows joined with the one row of their key, a key of very many rows dealt over SALTS tasks.

    Never by a broadcast: Spark sizes either side by its packed files, and the copies of ``small`` not at all."""
    salted = small.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)]))).hint("merge")
    return rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).join(salted, [*keys, "_salt"]).drop("_salt")


def facts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Merged stripes (lang, w1, w2, w3, n, top; null words end a shorter phrase), and lang, n of all words."""
    texts = docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    weights = texts.mapInArrow(_weights, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    weights = write_table(weights, "phrase-weights")
    heavy = weights.where(F.col("lang").isNull() & (F.col("n") > STRIPE_WORDS)).collect()       # at most BUCKETS rows
    parts = None
    if heavy:
        parts = np.ones(BUCKETS, np.int64)
        for r in heavy:
            parts[r["bucket"]] = -(-r["n"] // STRIPE_WORDS)
    dealt = texts.mapInArrow(lambda it: _stripes(it, parts), STRIPE) \
        .repartition("lang", "word", "part").sortWithinPartitions("lang", "word", "part")
    found = dealt.mapInArrow(lambda it: _merge(it, least), "lang string, w1 string, w2 string, w3 string, n long, top long")
    return write_table(found, "phrase-facts"), weights.where(F.col("lang").isNotNull()).select("lang", "n")


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) in exact arithmetic."""
    wide = lambda x: f"cast({x} as decimal(15,0))"
    return F.expr(f"cast((cast(1000000 as decimal(7,0)) * ({wide(a)} * {wide(a)})) div ({wide(left)} * {wide(right)}) as long)")


def candidates(found: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, phrase, a, l, r, score of the phrases that are left."""
    words = found.where("w2 is null").groupBy("lang", "w1").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    pairs = found.where("w2 is not null and w3 is null").groupBy("lang", "w1", "w2") \
        .agg(F.sum("n").alias("a"), F.max("top").alias("top")).where(F.col("a") >= least)
    triples = found.where("w3 is not null").select("lang", "w1", "w2", "w3", F.col("n").alias("a"))
    ends = triples.groupBy("lang", "w2", "w3").agg(F.max("a").alias("back")).withColumnsRenamed({"w2": "w1", "w3": "w2"})
    pairs = _spread(pairs, words.withColumnRenamed("f", "l"), ["lang", "w1"], F.col("w2"))
    pairs = _spread(pairs, words.select("lang", F.col("w1").alias("w2"), F.col("f").alias("r")), ["lang", "w2"], F.col("w1"))
    pairs = write_table(pairs.join(ends.hint("merge"), ["lang", "w1", "w2"], "left"), "phrase-pairs")

    longer = F.greatest("top", F.coalesce("back", F.lit(0)))
    two = pairs.where(~((longer >= least) & (100 * longer >= INSIDE * F.col("a")))) \
        .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score("a", "l", "r").alias("score"))
    left = pairs.select("lang", "w1", "w2", F.col("a").alias("a12"), F.col("l").alias("f1"))
    right = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("a23"), F.col("r").alias("f3"))
    three = _spread(_spread(triples, left, ["lang", "w1", "w2"], F.col("w3")), right, ["lang", "w2", "w3"], F.col("w1"))
    one, other = _score("a", "f1", "a23"), _score("a", "a12", "f3")
    early = F.col("one") <= F.col("other")
    three = three.withColumns({"one": one, "other": other}).select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(early, F.col("f1")).otherwise(F.col("a12")).alias("l"),
        F.when(early, F.col("a23")).otherwise(F.col("f3")).alias("r"), F.least("one", "other").alias("score"))
    return two.unionByName(three)


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases by score."""
    found, n = facts(docs, least)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = candidates(found, least).withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(TOP_SALTS)))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(n.hint("merge"), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
