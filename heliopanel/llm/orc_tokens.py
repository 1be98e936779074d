"""Token ids in ORC files: sorted by document, with row indexes and Bloom filters on the id.

Ids are an ORC integer list, which the format stores run-length encoded.  Files hold
ascending document ids, stripes can be read in parallel, and the minimum, maximum and Bloom
filter of ``doc_id`` let a reader skip stripes and row groups.

Texts are sorted (by ranges of doc_id, so no task gets more than its share) before they are
encoded, as texts are smaller than ids.  Null texts count as empty and get the end id alone;
repeated rows are written each, equal ids in the order of their texts' hashes; null ids come
first; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import id_and_text, raw_bytes, text_chunks, write_table
from .wordhash import WHITE, word_hashes

END_ID = 1
KEEP = 3_000_000        # words a worker remembers, about 40 bytes each
BATCH = 256
MARK = "<|endoftext|>"
CHUNK_BYTES = 4 << 20
ROWS_PER_FILE = 200_000
ROWS_PER_INDEX = 1000
STRIPE_BYTES = 16 << 20
SCHEMA = "doc_id long, ids array<int>"
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CLOSING, LETTER = np.zeros(256, bool), np.zeros(256, bool)
CLOSING[list(b".,!?;:")] = True
LETTER[97:123] = True
FILE_OF_PART = "-c([0-9]+)[.][^-]*$"       # at the end of the name, as a group of its uuid may look the same


class WordCoder:
    """The library's encoding, word by word.

    The vocabulary's rules never join across white space, and always part a closing mark from a letter
    before it, so a text's ids are those of its words and closing marks in turn.  Each distinct one is
    encoded by the library once: its ids stay in one array, found by a 64-bit hash and a checksum.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark's tasks are the parallelism
        self.library = Tokenizer.from_file(path)
        self.mark = self.library.token_to_id(MARK)
        self.forget()

    def forget(self) -> None:
        self.hashes, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.first, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _library(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word.  Many go through the library as one text, a special token between them."""
        texts = [w.decode("utf-8", "replace") for w in words]
        if self.mark is None or any("<|" in t for t in texts):
            return [np.array(e.ids, np.int32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        out = []
        for i in range(0, len(texts), BATCH):
            joined = self.library.encode_batch_fast([MARK.join(texts[i:i + BATCH])], add_special_tokens=False)[0]
            ids = np.array(joined.ids, np.int32)
            cut = np.flatnonzero(ids == self.mark)
            out += [ids[a:b] for a, b in zip(np.append(0, cut + 1).tolist(), np.append(cut, len(ids)).tolist())]
        return out

    def _codes(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each of the distinct words begin in ``ids``, and how many there are."""
        if len(self.hashes) > KEEP or len(self.ids) > 4 * KEEP:
            self.forget()
        raw = words.buffers()[2].to_pybytes()
        at = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
        bytes_ = np.frombuffer(raw, np.uint8)
        length = np.diff(at)
        # the words in lines, to be hashed; the checksum is of their length and both ends
        lines = np.full(int(length.sum()) + len(words), 10, np.uint8)
        lines[np.arange(at[0], at[-1]) - at[0] + np.repeat(np.arange(len(words)), length)] = bytes_[at[0]:at[-1]]
        hashes = word_hashes(lines.tobytes())
        checks = ((length << 16) | (bytes_[at[:-1]].astype(np.int64) << 8) | bytes_[at[1:] - 1]).astype(np.uint32)
        place = np.searchsorted(self.hashes, hashes)
        there = np.minimum(place, max(len(self.hashes) - 1, 0))
        taken = self.hashes[there] == hashes if len(self.hashes) else np.zeros(len(words), bool)
        known = taken & (self.checks[there] == checks) if len(self.hashes) else taken
        first, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        first[known], size[known] = self.first[there[known]], self.size[there[known]]
        missing = np.flatnonzero(~known)
        if len(missing):
            found = self._library([raw[a:b] for a, b in zip(at[missing].tolist(), at[missing + 1].tolist())])
            size[missing] = [len(f) for f in found]
            first[missing] = len(self.ids) + np.cumsum(size[missing]) - size[missing]
            self.ids = np.concatenate([self.ids, *found])
            new = missing[~taken[missing] & (length[missing] <= 64)]      # words of one hash are not kept twice
            new = new[np.unique(hashes[new], return_index=True)[1]]
            to = place[new]
            self.hashes, self.checks = np.insert(self.hashes, to, hashes[new]), np.insert(self.checks, to, checks[new])
            self.first, self.size = np.insert(self.first, to, first[new]), np.insert(self.size, to, size[new])
        return first, size

    def _encode(self, texts: list[bytes], lower: bool) -> list[bytes]:
        data = np.frombuffer(b"\n".join(texts), np.uint8)
        word = ~WHITE[data]
        edge = np.flatnonzero(np.diff(word.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
        start, end = edge[::2], edge[1::2]
        if not len(start):
            return [b""] * len(texts)
        letters = LOWER[data[word]] if lower else data[word]
        upto = np.cumsum(end - start)
        closing = (end - start > 1) & CLOSING[letters[upto - 1]] & LETTER[letters[np.maximum(upto - 2, 0)]]
        parts = np.arange(1, len(start) + 1) + np.cumsum(closing)           # parts up to each word's end
        offsets = np.zeros(int(parts[-1]) + 1, np.int64)
        offsets[parts] = upto
        offsets[parts[closing] - 1] = upto[closing] - 1
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(letters)]) \
            .dictionary_encode()
        first, size = self._codes(words.dictionary)
        which = words.indices.to_numpy()
        n = size[which]
        upto = np.cumsum(n)
        ids = self.ids[np.repeat(first[which] - (upto - n), n) + np.arange(int(upto[-1]))].astype("<i4").tobytes()
        # parts before each text's end
        ends = np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts]))
        parts = np.append(0, parts)[np.append(0, ends)]
        at = 4 * np.append(0, upto)[parts]
        return [ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        # the vocabulary's rules lower-case; doing so first lets words share an entry (its special
        # tokens are matched before that rule, so texts that may hold one are left alone)
        special = [i for i, t in enumerate(texts) if b"<|" in t]
        if not special:
            return self._encode(texts, True)
        out = self._encode([b"" if b"<|" in t else t for t in texts], True)
        for i, ids in zip(special, self._encode([texts[i] for i in special], False)):
            out[i] = ids
        return out


@lru_cache(maxsize=2)
def worker_coder(path: str) -> WordCoder:
    return WordCoder(path)


def _encoded(batches, path: str):
    coder, end = worker_coder(path), np.array([END_ID], "<i4").tobytes()
    for part in text_chunks(batches, limit=CHUNK_BYTES):
        ids = [x + end for x in coder.encode(raw_bytes(part))]
        offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
        values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(ids))])
        yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), values)],
                                         ["doc_id", "ids"])


def write_tokens(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Encode every whole text, append the end id and write ORC files in ascending doc_id."""
    rows = id_and_text(docs).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    (ordered.mapInArrow(lambda it: _encoded(it, tokenizer), SCHEMA).write
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.create.index", "true").option("orc.row.index.stride", str(ROWS_PER_INDEX))
     .option("orc.stripe.size", str(STRIPE_BYTES)).option("compression", "zstd")
     .option("maxRecordsPerFile", str(ROWS_PER_FILE)).orc(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, ids, and the file each row lies in.  Filters on doc_id reach the files' indexes."""
    return spark.read.schema(SCHEMA).orc(path).select("doc_id", "ids", F.col("_metadata.file_name").alias("file"))


def _checksums(batches):
    for part in batches:
        ids = part.column(1)
        at = ids.offsets.to_numpy()
        raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False).astype("<u4"))).cast("B")
        crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(np.diff(at), pa.int64()),
                                          pa.array(crc, pa.int64())], ["doc_id", "file", "n_tokens", "ids_crc32"])


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the files.

    Running sums go within a file (its rows are bounded by the writer), and over the files'
    totals (one row per file).
    """
    rows = write_table(read_tokens(spark, path).mapInArrow(
        _checksums, "doc_id long, file string, n_tokens long, ids_crc32 long"), "token-checksums")
    number = [F.regexp_extract("file", p, 1).cast("long") for p in ("^part-([0-9]+)", FILE_OF_PART)]
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("in_file"))
    before = Window.orderBy(*number).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    files = files.select("file", (F.sum("in_file").over(before) - F.col("in_file")).alias("file_start"))
    inside = Window.partitionBy("file").orderBy("doc_id", "n_tokens", "ids_crc32") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("upto", F.sum("n_tokens").over(inside)).join(files, "file") \
        .select("doc_id", (F.col("file_start") + F.col("upto") - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32")
