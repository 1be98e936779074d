"""Byte-level BPE as a reduction over a tree.

Encoding is a monoid: the code of a concatenation is computed from the codes of its halves.

* Inside one match of the split pattern the elements are token lists.  ``join`` re-encodes
  a window of tokens around the border and widens it (doubling) until the tokens outside
  are proven final.  The proof is local: a token list is the BPE code of its bytes exactly
  when every two neighbours are the code of their own concatenation, so it suffices to look
  at the two pairs at the window's edges.
* Across matches the elements are lists of matches.  A match that ends two or more code
  points before the left text's end cannot change (the pattern looks at most that far);
  the rest is matched again together with the right text until a match ends where one of
  the right text's own matches ends, and from there on nothing can change.

Decoding concatenates token bytes up the same tree.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, raw_bytes, text_chunks

#: code points of a text leaf, tokens of a decoding leaf, matches and pairs kept in a worker
LEAF_CHARS = 1 << 14
LEAF_TOKENS = 1 << 14
KEEP = 200_000


class ByteBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern)
        self.token = {i: b for b, i in ranks.items()}
        self._matches: dict[str, bytes] = {}
        self._parts: dict[bytes, tuple] = {}
        self._pairs: dict[tuple, tuple] = {}

    # one match ---------------------------------------------------------------------------
    def merge(self, data: bytes) -> tuple[int, ...]:
        """Code of a short byte string from the ranks: the lowest pair first, leftmost of equals."""
        if len(data) > 48:
            return self._merge_heap(data)
        rank, parts = self.ranks.get, [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return tuple(self.ranks[p] for p in parts)

    def _merge_heap(self, data: bytes) -> tuple[int, ...]:
        n, rank = len(data), self.ranks.get
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            j = end[i]
            if j < n and (r := rank(data[i:end[j]])) is not None:
                heapq.heappush(heap, (r, i, end[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            r, i, stop = heapq.heappop(heap)
            j = end[i]
            if j < 0 or j >= n or end[j] != stop:
                continue
            end[i], end[j] = stop, -1
            if stop < n:
                before[stop] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(self.ranks[data[i:end[i]]])
            i = end[i]
        return tuple(out)

    def _pair(self, a: int, b: int) -> tuple[int, ...]:
        got = self._pairs.get((a, b))
        if got is None:
            if len(self._pairs) >= KEEP:
                self._pairs.clear()
            got = self._pairs[a, b] = self.merge(self.token[a] + self.token[b])
        return got

    def join(self, left: tuple, right: tuple) -> tuple:
        """Code of the concatenation of two coded byte strings."""
        if not left or not right:
            return left + right
        mid = self._pair(left[-1], right[0])
        if len(mid) == 2 and mid == (left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            left_ok = i == len(left) or self._pair(left[-i - 1], mid[0]) == (left[-i - 1], mid[0])
            right_ok = j == len(right) or self._pair(mid[-1], right[j]) == (mid[-1], right[j])
            if left_ok and right_ok:
                return left[:-i] + mid + right[j:]
            if not left_ok:
                i = min(2 * i, len(left))
            if not right_ok:
                j = min(2 * j, len(right))
            mid = self.merge(b"".join(self.token[t] for t in left[-i:] + right[:j]))

    def encode_match(self, data: bytes) -> tuple[int, ...]:
        """Code of one match: halves, recursively, then their join."""
        known = self.ranks.get(data)
        if known is not None and len(data) == 1:
            return (known,)
        got = self._parts.get(data)
        if got is None:
            half = len(data) // 2
            got = self.join(self.encode_match(data[:half]), self.encode_match(data[half:]))
            if len(data) <= 64:
                if len(self._parts) >= KEEP:
                    self._parts.clear()
                self._parts[data] = got
        return got

    # a whole text --------------------------------------------------------------------------
    def matches(self, text: str) -> list[str]:
        """Matches of the split pattern, from halves of the text."""
        if len(text) <= LEAF_CHARS:
            return self.split.findall(text)
        half = len(text) // 2
        return self.join_matches(self.matches(text[:half]), self.matches(text[half:]))

    def join_matches(self, left: list[str], right: list[str]) -> list[str]:
        keep, after = len(left), 0
        while keep and after < 2:
            keep -= 1
            after += len(left[keep])
        # ``after`` counts from the start of match ``keep``; the one before it ends there
        tail = "".join(left[keep:])
        border, k, again = len(tail), 0, []
        for m in self.split.finditer(tail + "".join(right)):
            again.append(m[0])
            while border < m.end():
                border += len(right[k])
                k += 1
            if border == m.end():
                break
        return left[:keep] + again + right[k:]

    def encode_bytes(self, text: str) -> bytes:
        """Ids of the whole text as little-endian unsigned 32-bit integers."""
        known, pieces = self._matches, self.matches(text)
        try:
            return b"".join([known[p] for p in pieces])
        except KeyError:
            pass
        if len(known) >= KEEP:
            known.clear()
        out = []
        for p in pieces:
            code = known.get(p)
            if code is None:
                code = b"".join([i.to_bytes(4, "little") for i in self.encode_match(p.encode("utf-8"))])
                if len(p) <= 64:
                    known[p] = code
            out.append(code)
        return b"".join(out)

    def decode(self, ids) -> bytes:
        """Bytes of an id sequence."""
        if len(ids) <= LEAF_TOKENS:
            return b"".join([self.token[i] for i in ids])
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file (a fixed size, whatever the corpus)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def worker_coder(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(read_ranks(path), pattern)


def _encoded(batches: Iterator[pa.RecordBatch], path: str, pattern: str):
    coder = worker_coder(path, pattern)
    for part in text_chunks(batches):
        ids = [coder.encode_bytes(b.decode("utf-8", "replace")) for b in raw_bytes(part)]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])


def _digested(batches: Iterator[pa.RecordBatch], path: str, pattern: str):
    coder = worker_coder(path, pattern)
    for part in text_chunks(batches):
        rows = []
        for b in raw_bytes(part):
            ids = coder.encode_bytes(b.decode("utf-8", "replace"))
            back = coder.decode(memoryview(ids).cast("I"))
            rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()))
        n, a, b = zip(*rows)
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()),
                                          pa.array(b, pa.string())],
                                         ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids binary (little-endian unsigned 32-bit) of every whole text.

    Null or empty text: no ids.  Repeated rows are coded each; an empty table gives none;
    columns other than doc_id and text are ignored.
    """
    return id_and_text(docs).mapInArrow(lambda it: _encoded(it, path, pattern), "doc_id long, ids binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode, decode the ids, digest both.

    The ids of a text live only inside the task that makes them.  Edge cases as in ``encode``.
    """
    return id_and_text(docs).mapInArrow(
        lambda it: _digested(it, path, pattern),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def decode(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, data binary: the bytes that the ids stand for (null ids: no bytes)."""
    def run(batches):
        coder = worker_coder(path, pattern)
        for part in batches:
            out = [coder.decode(memoryview(x or b"").cast("I")) for x in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.binary())], ["doc_id", "data"])
    return coded.select("doc_id", F.col("ids")).mapInArrow(run, "doc_id long, data binary")
