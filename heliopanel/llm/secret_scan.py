"""Secret scan: every rule in one deterministic automaton, one pass over a text's bytes.

``find_secrets`` returns the spans themselves, ``redact_secrets`` rewrites the texts.
Null text counts as empty; empty texts have no spans; an empty table gives an empty table;
repeated rows are scanned each for itself; extra columns are carried by ``redact_secrets``
and ignored by ``find_secrets``.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import Combined, Rule
from .common import id_and_text, raw_bytes, text_chunks

# The three base rules of the contract, in the order it lists them.
BASE = (
    Rule("assign", "[A-Za-z0-9+/_.=-]+", head="(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?",
         min_body=12, ignore_case=True),
    Rule("access", "AKIA[A-Z0-9]+", min_length=18),
    Rule("hex", "[0-9a-f]{16,}", min_length=16),
)
# Public formats of further credentials.
MORE = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", min_length=40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", min_length=20),
    Rule("stripe", "[rs]k_(live|test)_[A-Za-z0-9]+", min_length=24),
    Rule("google", "AIza[A-Za-z0-9_-]+", min_length=39),
    Rule("jwt", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", min_length=30),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + MORE


@lru_cache(maxsize=4)
def compiled(rules: tuple[Rule, ...] = RULES) -> Combined:
    return Combined(list(rules))


def _code_points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte offsets to code-point offsets; the text is decoded once, from span to span."""
    if not spans or data.isascii():
        return spans
    places = sorted({p for s, _, e in spans for p in (s, e)})
    at, count, of = 0, 0, {}
    for p in places:
        count += len(data[at:p].decode("utf-8", "replace"))
        at = p
        of[p] = count
    return [(of[s], i, of[e]) for s, i, e in spans]


def _scan(batches, rules):
    machine = compiled(rules)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for part in text_chunks(batches):
        rows = []
        for data in raw_bytes(part):
            rows.append([{"kind": rules[i].kind, "start": s, "end": e}
                         for s, i, e in _code_points(data, machine.spans(data))])
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, kind)], ["doc_id", "spans"])


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, spans array<struct<kind, start, end>> (code points, by start then rule order)."""
    return id_and_text(docs).mapInArrow(lambda it: _scan(it, rules),
                                        "doc_id long, spans array<struct<kind string, start long, end long>>")


def _redacted(batches, rules, at):
    machine = compiled(rules)
    for part in text_chunks(batches):
        texts = []
        for data, here in zip(raw_bytes(part), part.column(at).is_valid().to_pylist()):
            out, done = [], 0
            for s, i, e in machine.spans(data) if here else ():
                if s >= done:
                    out += [data[done:s], f"[{rules[i].kind}]".encode()]
                done = max(done, e)
            texts.append(b"".join([*out, data[done:]]).decode("utf-8", "replace") if here else None)
        cols = list(part.columns)
        cols[at] = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_arrays(cols, part.schema.names)


def redact_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The same rows and columns with every secret in ``text`` replaced by ``[kind]``.

    Overlapping spans become the mark of the first; a null text stays null.
    """
    at = docs.columns.index("text")
    return docs.mapInArrow(lambda it: _redacted(it, rules, at), docs.schema)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns, from the spans."""
    base = [r.kind for r in BASE]
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda spans: F.concat_ws(",", F.transform(spans, one))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))
