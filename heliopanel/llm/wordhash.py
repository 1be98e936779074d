"""Vectorised 64-bit hashes of words and word windows over UTF-8 bytes.

Words are maximal runs of bytes outside ``\\x20\\x09-\\x0D``.  A word's hash is a polynomial
over randomised byte values, taken as a difference of prefix sums modulo 2**64 (the base is
odd, so it has an inverse), then mixed.  No Python object is made per word.
"""

from __future__ import annotations

import numpy as np

SEGMENT = 1 << 20
WHITE = np.zeros(256, bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: ASCII upper case hashed as lower case
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "b" not in _POWERS or len(_POWERS["b"]) < n:
        size = max(n, SEGMENT + 1)
        for name, base in (("b", _BASE), ("i", pow(_BASE, -1, 1 << 64))):
            step = np.full(size, base, np.uint64)
            step[0] = 1
            _POWERS[name] = np.cumprod(step)
    return _POWERS["b"], _POWERS["i"]


def _segment(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    word = ~WHITE[data]
    edge = np.flatnonzero(np.diff(word.astype(np.int8), prepend=0, append=0))
    start, end = edge[::2], edge[1::2]
    power, inverse = _powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * power[:len(data)], out=prefix[1:])
    return mix((prefix[end] - prefix[start]) * inverse[start])


def word_hashes(text: bytes, lower: bool = False) -> np.ndarray:
    """Hash of every word of ``text``, in order.  Long texts go in pieces cut at white space."""
    table = _BYTE_LOWER if lower else _BYTE
    data = np.frombuffer(text, np.uint8)
    if len(data) <= SEGMENT:
        return _segment(data, table)
    out, at = [], 0
    while at < len(data):
        end = min(at + SEGMENT, len(data))
        while end < len(data):
            gap = np.flatnonzero(WHITE[data[end:end + SEGMENT]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + SEGMENT, len(data))
        out.append(_segment(data[at:end], table))
        at = end
    return np.concatenate(out)


def windows(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every window of ``k`` words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for j in range(1, k):
        out += words[j:j + n] * np.uint64(pow(_BASE, 3 * j, 1 << 64))
    return mix(out)


def shingles(text: bytes, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the text's ``k``-word windows, ASCII letters in lower case.

    Fewer than ``k`` words make one shingle of the whole sequence; no word makes none.
    """
    words = word_hashes(text, lower=True)
    if len(words) == 0:
        return words
    if len(words) < k:
        return windows(words, len(words)) + np.uint64(len(words))
    grams = np.sort(windows(words, k))
    keep = np.ones(len(grams), bool)
    np.not_equal(grams[1:], grams[:-1], out=keep[1:])
    return grams[keep]
