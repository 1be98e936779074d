"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Learning, on at most ``TRAIN_DOCS`` labelled rows (a documented bound; chosen by a hash of
their ids):

* Near copies among them count once.  A word or word beginning is *telling* if documents
  marked toxic hold it far more often than chance allows and others much less
  often; a toxic document's tokens with a telling feature are its labelled tokens.
* A two-state chain (ordinary, toxic) with hashed word, prefix and suffix features is fitted
  to windows of labelled tokens by gradient ascent on the conditional likelihood.
* A logistic curve maps a document's largest marginal and its expected number of toxic
  tokens to a score, fitted on the same rows.

Scoring covers every token of every whole text.  The forward and backward recursions are
products of 2 x 2 matrices, hence associative: tokens lie in blocks of ``BLOCK`` that advance
together, block products are chained along each text, and a second pass fills in the blocks.

Null text counts as empty; texts without tokens get the score of no evidence; repeated rows
are scored each; an empty table gives an empty table; without labelled rows of both kinds
every score is the same.  Other columns, lang and source among them, are never read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, id_and_text, raw_bytes, text_chunks
from .wordhash import shingles

TRAIN_DOCS = 4000
TRAIN_WINDOWS = 10          # telling places of a labelled document that train the chain, drawn at random if it has more
BUCKETS = 1 << 16
BLOCK = 64
WINDOW = 8
KEEP = 300_000
EVIDENCE = 0.1
EDGES = ".,;:!?\"'()[]{}<>-_*#%&|$/\\…«»“”„’‘"
TOKEN = re.compile(rb"[^\x20\x09-\x0D]+")


def features(token: str) -> list[str]:
    """Features of a lower-case token without edge punctuation."""
    out = [f"w={token}"]
    out += [f"p{k}={token[:k]}" for k in (3, 4, 5, 6, 7) if len(token) > k]
    out += [f"s{k}={token[-k:]}" for k in (3,) if len(token) > k]
    return out


def normal(raw: bytes) -> str:
    return raw.decode("utf-8", "replace").lower().strip(EDGES)


def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode()) % BUCKETS


@dataclass
class Chain:
    """Weights of a toxic token's features (an ordinary token's are 0) and log transitions."""

    weights: np.ndarray
    bias: float
    step: np.ndarray            # [from, to], 0 = ordinary, 1 = toxic
    curve: tuple[float, float, float]

    def __post_init__(self):
        self._known: dict[bytes, float] = {}

    def __getstate__(self):
        return {**self.__dict__, "_known": {}}

    def potential(self, raw: bytes) -> float:
        token = normal(raw)
        return self.bias + float(sum(self.weights[_bucket(f)] for f in features(token))) if token else self.bias

    def potentials(self, tokens: list[bytes]) -> np.ndarray:
        known = self._known
        if len(known) > KEEP:
            known.clear()
        for t in set(tokens):
            if t not in known:
                known[t] = self.potential(t)
        out = np.array([known[t] for t in tokens])
        for t in [t for t in set(tokens) if len(t) > 64]:
            del known[t]
        return out

    def score(self, top: np.ndarray, expected: np.ndarray) -> np.ndarray:
        a, b, c = self.curve
        return 1 / (1 + np.exp(-(a + b * top + c * np.log1p(expected))))


def marginals(step: np.ndarray, potential: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """P(toxic) of every token of texts with the given token counts (each starts from ordinary)."""
    lengths = np.asarray(lengths, np.int64)
    n_blocks = -(-lengths // BLOCK)
    lanes = int(n_blocks.sum())
    if lanes == 0:
        return np.zeros(0)
    text = np.repeat(np.arange(len(lengths)), n_blocks)
    nth = np.arange(lanes) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    token_text = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.arange(len(potential)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    lane = (np.cumsum(n_blocks) - n_blocks)[token_text] + inside // BLOCK
    slot = inside % BLOCK
    there = np.zeros((BLOCK, lanes), bool)
    there[slot, lane] = True
    clipped = np.clip(potential, -30, 30)
    toxic = np.ones((BLOCK, lanes))
    plain = np.ones((BLOCK, lanes))
    toxic[slot, lane] = np.exp(np.minimum(clipped, 0))
    plain[slot, lane] = np.exp(-np.maximum(clipped, 0))
    (t00, t01), (t10, t11) = np.exp(step)

    # product of each block: rows are the state before it
    p = np.zeros((2, 2, lanes))
    p[0, 0] = p[1, 1] = 1
    for k in range(BLOCK):
        a = (p[:, 0] * t00 + p[:, 1] * t10) * plain[k]
        b = (p[:, 0] * t01 + p[:, 1] * t11) * toxic[k]
        norm = (a + b).max(axis=0)
        here = there[k]
        p[:, 0] = np.where(here, a / norm, p[:, 0])
        p[:, 1] = np.where(here, b / norm, p[:, 1])

    # chain along each text: state before each block, and what follows each block
    ahead = np.zeros((2, lanes))
    behind = np.full((2, lanes), 0.5)
    ahead[0] = 1.0
    order = np.argsort(nth, kind="stable")
    edge = np.searchsorted(nth[order], np.arange(int(nth.max()) + 2))
    for k in range(1, len(edge) - 1):
        now = order[edge[k]:edge[k + 1]]
        v = ahead[0, now - 1] * p[0][:, now - 1] + ahead[1, now - 1] * p[1][:, now - 1]
        ahead[:, now] = v / v.sum(axis=0)
    left = n_blocks[text] - 1 - nth
    order = np.argsort(left, kind="stable")
    edge = np.searchsorted(left[order], np.arange(int(left.max()) + 2))
    for k in range(1, len(edge) - 1):
        now = order[edge[k]:edge[k + 1]]
        v = p[:, 0, now + 1] * behind[0, now + 1] + p[:, 1, now + 1] * behind[1, now + 1]
        behind[:, now] = v / v.sum(axis=0)

    forward = np.zeros((BLOCK, 2, lanes))
    v = ahead
    for k in range(BLOCK):
        a = (v[0] * t00 + v[1] * t10) * plain[k]
        b = (v[0] * t01 + v[1] * t11) * toxic[k]
        total = a + b
        v = np.where(there[k], np.stack([a / total, b / total]), v)
        forward[k] = v
    out = np.zeros((BLOCK, lanes))
    v = behind
    for k in range(BLOCK - 1, -1, -1):
        a, b = forward[k, 0] * v[0], forward[k, 1] * v[1]
        out[k] = b / (a + b)
        x, y = plain[k] * v[0], toxic[k] * v[1]
        before = np.stack([t00 * x + t01 * y, t10 * x + t11 * y])
        v = np.where(there[k], before / before.sum(axis=0), v)
    return out[slot, lane]


# learning --------------------------------------------------------------------------------------------
def distinct_texts(rows: list[tuple[bytes, int]]) -> list[tuple[bytes, int]]:
    """One of each group of near copies: half of a small sketch seen in an earlier text."""
    seen: set[int] = set()
    out = []
    for text, label in rows:
        head = np.sort(shingles(text))[:16].tolist()
        if head and 2 * sum(h in seen for h in head) > len(head):
            continue
        seen.update(head)
        out.append((text, label))
    return out


def telling_features(rows: list[tuple[list[str], int]], level: float = 12.0) -> set[str]:
    """Features that toxic documents hold beyond chance (log likelihood ratio) and others much less."""
    share = max(sum(y for _, y in rows), 1) / max(len(rows), 1)
    yes, no = Counter(), Counter()
    for tokens, y in rows:
        (yes if y else no).update({f for t in set(tokens) if t for f in features(t) if f[0] != "s"})
    out = set()
    for f, k in yes.items():
        other = no[f]
        rate = k / (k + other)
        gain = k * math.log(rate / share) + (other * math.log((1 - rate) / (1 - share)) if other else 0.0)
        if rate >= 0.6 and gain >= level:
            out.add(f)
    return out


def fit(rows: list[tuple[bytes, int]], rounds: int = 60, seed: int = 3) -> Chain:
    """Fit the chain and the score curve to (text, toxic) rows."""
    rows = distinct_texts(rows)
    flat = Chain(np.zeros(BUCKETS), -8.0, np.log(np.array([[0.99, 0.01], [0.5, 0.5]])), (-3.0, 0.0, 0.0))
    docs = [([normal(t) for t in TOKEN.findall(text)], y) for text, y in rows]
    n_toxic = sum(y for _, y in docs)
    if not 0 < n_toxic < len(docs):
        return flat
    telling = telling_features(docs)
    marked: dict[str, bool] = {}

    def is_marked(t: str) -> bool:
        if t not in marked:
            marked[t] = bool(t) and any(f in telling for f in features(t))
        return marked[t]

    rng = np.random.default_rng(seed)
    tokens: list[str] = []
    labels: list[int] = []
    lengths: list[int] = []
    for words, y in docs:
        tags = [int(bool(y) and is_marked(w)) for w in words]
        # around what looks telling (in ordinary documents too), and around a few other places
        centres = [i for i, w in enumerate(words) if is_marked(w)]
        if len(centres) > TRAIN_WINDOWS:
            centres = rng.choice(centres, TRAIN_WINDOWS, replace=False).tolist()
        centres += rng.integers(0, len(words), 2).tolist() if words else []
        for c in centres:
            lo, hi = max(0, c - WINDOW), min(len(words), c + WINDOW + 1)
            tokens += words[lo:hi]
            labels += tags[lo:hi]
            lengths.append(hi - lo)
    if not tokens:
        return flat
    length = np.array(lengths)
    target = np.array(labels, float)
    # features as flat index lists; one bucket more is the bias
    of = {w: [_bucket(f) for f in features(w)] if w else [] for w in set(tokens)}
    counts = np.array([len(of[w]) for w in tokens])
    index = np.array([b for w in tokens for b in of[w]], np.int64)
    row = np.repeat(np.arange(len(tokens)), counts)
    first = np.zeros(len(tokens), bool)
    first[np.cumsum(length) - length] = True
    before = np.where(first, 0.0, np.concatenate([[0.0], target[:-1]]))
    weights, bias, step = np.zeros(BUCKETS), -2.0, np.log(np.array([[0.95, 0.05], [0.7, 0.3]]))
    speed_w, speed_b, speed_s = np.full(BUCKETS, 1e-6), 1e-6, np.full((2, 2), 1e-6)
    observed = np.array([[((1 - before) * (1 - target)).sum(), ((1 - before) * target).sum()],
                         [(before * (1 - target)).sum(), (before * target).sum()]])
    for _ in range(rounds):
        potential = np.bincount(row, weights[index], len(tokens)) + bias
        p = marginals(step, potential, length)
        # pair expectations from the marginals of neighbours, exact for the chain's toxic share
        q = np.where(first, 0.0, np.concatenate([[0.0], p[:-1]]))
        pair = _pairs(step, potential, p, q, first)
        grad_w = np.bincount(index, (target - p)[row], BUCKETS) - 0.05 * weights
        grad_b = float((target - p).sum())
        grad_s = observed - pair - 0.05 * step
        speed_w += grad_w ** 2
        speed_b += grad_b ** 2
        speed_s += grad_s ** 2
        weights += 0.5 * grad_w / np.sqrt(speed_w)
        bias += 0.3 * grad_b / math.sqrt(speed_b)
        step += 0.1 * grad_s / np.sqrt(speed_s)
    chain = Chain(weights, bias, step, (-3.0, 0.0, 0.0))
    top, expected = zip(*(_evidence(chain, [t for t, _ in rows[i:i + 256]]) for i in range(0, len(rows), 256)))
    chain.curve = _curve(np.concatenate(top), np.concatenate(expected), np.array([y for _, y in rows], float))
    return chain


def _pairs(step, potential, p, q, first) -> np.ndarray:
    """Expected transition counts, given the marginals of both ends.

    The joint of two neighbours is the one with these marginals and the chain's odds ratio.
    """
    ratio = math.exp(step[0, 0] + step[1, 1] - step[0, 1] - step[1, 0])
    if abs(ratio - 1) < 1e-9:
        both = p * q
    else:
        s = 1 + (p + q) * (ratio - 1)
        both = (s - np.sqrt(np.maximum(s * s - 4 * ratio * (ratio - 1) * p * q, 0))) / (2 * (ratio - 1))
    both = np.where(first, 0.0, both)
    return np.array([[(1 - p - q + both).sum(), (p - both).sum()], [(q - both).sum(), both.sum()]])


def _curve(top: np.ndarray, expected: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps."""
    x = np.column_stack([np.ones(len(y)), top, np.log1p(expected)])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (y - p) - 0.05 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3)
        w = w + np.linalg.solve(hess, grad)
    return tuple(float(v) for v in w)


# scoring ------------------------------------------------------------------------------------------------
def _tagged(chain: Chain, texts: list[bytes]):
    words = [t.split() for t in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    p = marginals(chain.step, chain.potentials([w for ws in words for w in ws]), lengths)
    return p, lengths


def _evidence(chain: Chain, texts: list[bytes]):
    p, lengths = _tagged(chain, texts)
    return _summary(p, lengths)


def _summary(p: np.ndarray, lengths: np.ndarray):
    """Largest marginal, and expected number of toxic tokens among those with evidence, per text."""
    top, expected = np.zeros(len(lengths)), np.zeros(len(lengths))
    text = np.repeat(np.arange(len(lengths)), lengths)
    np.maximum.at(top, text, p)
    some = p >= EVIDENCE
    np.add.at(expected, text[some], p[some])
    return top, expected


def _spans(text: bytes, p: np.ndarray) -> list[dict]:
    """Runs of tokens likelier toxic than not: code-point offsets and the largest marginal."""
    out, at, count, last = [], 0, 0, -2
    sure = set(np.flatnonzero(p >= 0.5).tolist())
    for i, m in enumerate(TOKEN.finditer(text) if sure else ()):
        if i not in sure:
            continue
        start = count + len(text[at:m.start()].decode("utf-8", "replace"))
        end = start + len(m[0].decode("utf-8", "replace"))
        at, count = m.end(), end
        if last == i - 1:
            out[-1]["end"] = end
            out[-1]["p"] = max(out[-1]["p"], float(p[i]))
        else:
            out.append({"start": start, "end": end, "p": float(p[i])})
        last = i
    return out


def _scored(batches, chain):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))
    for part in text_chunks(batches):
        texts = raw_bytes(part)
        p, lengths = _tagged(chain.value, texts)
        score = chain.value.score(*_summary(p, lengths))
        ends = np.cumsum(lengths)
        spans = [_spans(t, p[e - n:e]) for t, e, n in zip(texts, ends, lengths)]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score), pa.array(spans, kind)], ["doc_id", "score", "spans"])


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, score, spans array<struct<start, end, p>> of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)     # fixed size: the hashed weights
    return id_and_text(docs).mapInArrow(
        lambda it: _scored(it, shared), "doc_id long, score double, spans array<struct<start long, end long, p double>>")


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS) -> Chain:
    """Fit on at most ``limit`` labelled rows outside the held-out quarter."""
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out()) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = bounded_sample(known, F.xxhash64(F.col("doc_id").cast("long")), limit)
    texts = id_and_text(docs).join(F.broadcast(picked), "doc_id").select("doc_id", "text", "toxic").dropDuplicates(["doc_id"])
    rows = sorted((r["doc_id"], r["text"].encode(), int(r["toxic"] == 1)) for r in texts.collect())
    return fit([(t, y) for _, t, y in rows])


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted, spans."""
    return score(docs, train(docs, labels)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")
