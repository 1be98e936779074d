"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Every text is measured once.  Each (language, source) has, per signal, a sketch of the
signal's distribution: counts over a fixed logarithmic grid (relative error ``GAMMA - 1``).
Sketches merge by adding counts, in any order and with the same result, so the sketch of a
hot source is pre-aggregated in every task, and the sketches of a language and of the whole
corpus are sums of the finer ones.  A group with fewer than ``min_docs`` usable documents
takes its language's thresholds, a small language the corpus's.  A document is kept if it
passes the two fixed base rules and all its signals lie within its group's fences.

Nulls: null text counts as empty (and fails the base rules), null lang or source as ''.
Repeated rows are measured each; an empty table gives an empty table; other columns are
ignored by ``verdicts`` and carried by ``quality_filter``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import raw_bytes, text_chunks, write_table
from .wordhash import windows, word_hashes

# Fixed values of the contract.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
REPEAT_SHARE = 0.5

GAMMA = 1.02
SMALLEST = 1e-3
SALTS = 16
BROADCAST_GROUPS = 50_000

_GAPS = bytes([32, 9, 10, 11, 12, 13]) + bytes(range(0x80, 0xC0))
_UPPER = bytes(range(65, 91))
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]


@dataclass(frozen=True)
class Signal:
    """A ratio of counts; fences lie ``spread`` interquartile ranges plus ``slack`` beyond the quartiles."""

    name: str
    value: str
    slack: float
    low: bool = False


SPREAD = 3.0
SIGNALS = (
    Signal("symbols", "n_symbols / n_words", 0.15),
    Signal("word_length", "word_chars / n_words", 2.0, low=True),
    Signal("dup_lines", "n_dup_lines / greatest(n_lines, 1)", 0.40),
    Signal("repeats", "n_repeat_words / n_words", 0.40),
    Signal("upper", "n_upper / word_chars", 0.25),
)


def measure(data: bytes) -> tuple[int, ...]:
    """The counts of one whole text, in the order of ``COUNTS``."""
    words = word_hashes(data)
    lines = [x for x in data.split(b"\n") if x.strip()]
    repeats = 0
    grams = windows(words, 3)
    if len(grams) > 1:
        order = np.sort(grams)
        twice = order[1:][order[1:] == order[:-1]]
        if len(twice):
            at = np.minimum(np.searchsorted(twice, grams), len(twice) - 1)
            inside = np.zeros(len(words), bool)
            found = np.flatnonzero(twice[at] == grams)
            for k in range(3):
                inside[found + k] = True
            repeats = int(inside.sum())
    return (len(words), len(data.translate(None, _GAPS)), len(data) - len(data.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeats, len(lines), len(data) - len(data.translate(None, _UPPER)))


def _measured(batches, text: str, carry_text: bool):
    for part in text_chunks(batches, text):
        rows = [measure(b or b"") for b in raw_bytes(part, text)]
        counts = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], COUNTS)
        names = [n for n in part.schema.names if carry_text or n != text]
        yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(n)) for n in names), counts],
                                         [*names, "counts"])


_COUNTS_TYPE = "struct<" + ", ".join(f"{c}: bigint" for c in COUNTS) + ">"


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every whole text."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("lang"),
                        F.coalesce("source", F.lit("")).alias("source"),
                        F.coalesce("text", F.lit("")).alias("text"))
    return plain.mapInArrow(lambda it: _measured(it, "text", False),
                            f"doc_id long, lang string, source string, counts {_COUNTS_TYPE}") \
        .select("doc_id", "lang", "source", "counts.*")


def base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > int(100 * REPEAT_SHARE) * F.col("n_words"))


def sketches(counts: DataFrame) -> DataFrame:
    """lang, source, signal, bucket, n: grid counts of the documents that pass the base rules."""
    pairs = ", ".join(f"'{s.name}', double({s.value})" for s in SIGNALS)
    return (counts.where(~base_failed()).selectExpr("lang", "source", f"stack({len(SIGNALS)}, {pairs}) as (signal, x)")
            .withColumn("bucket", F.when(F.col("x") < SMALLEST, F.lit(0)).otherwise(
                F.ceil(F.log(F.col("x") / SMALLEST) / math.log(GAMMA)).cast("int") + 1))
            .groupBy("lang", "source", "signal", "bucket").agg(F.count(F.lit(1)).alias("n")))


def merge(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Coarser sketches: the sum of finer ones."""
    return sketch.groupBy(*by, "signal", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, by: list[str], probabilities: dict[str, float]) -> DataFrame:
    """Quantiles per group and signal.  A window holds one group's grid, at most a few hundred rows."""
    keys = [*by, "signal"]
    w = Window.partitionBy(*keys).orderBy("bucket")
    total = Window.partitionBy(*keys)
    ranked = sketch.withColumn("upto", F.sum("n").over(w)).withColumn("all", F.sum("n").over(total))
    first = [F.min(F.when(F.col("upto") >= p * F.col("all"), F.col("bucket"))).alias(q)
             for q, p in probabilities.items()]
    value = lambda b: F.when(F.col(b) == 0, 0.0).otherwise(
        F.pow(F.lit(GAMMA), F.col(b) - 1) * (2 * SMALLEST / (1 + GAMMA)))
    return ranked.groupBy(*keys).agg(F.max("all").alias("n_docs"), *first) \
        .select(*keys, "n_docs", *[value(q).alias(q) for q in probabilities])


def thresholds(sketch: DataFrame, min_docs: int = 200, spread: float = SPREAD) -> DataFrame:
    """One row per (lang, source) that has a sketch: fences ``<signal>_low/high``."""
    levels = []
    for by in (["lang", "source"], ["lang"], []):
        q = quantiles(merge(sketch, by) if len(by) < 2 else sketch, by, {"q1": 0.25, "q3": 0.75})
        fences = []
        for s in SIGNALS:
            here = F.col("signal") == s.name
            width = spread * (F.col("q3") - F.col("q1")) + s.slack
            fences.append(F.max(F.when(here, F.col("q3") + width)).alias(f"{s.name}_high"))
            fences.append(F.max(F.when(here & F.lit(s.low), F.col("q1") - width)).alias(f"{s.name}_low"))
        n = F.max("n_docs").alias("n_docs")
        levels.append((q.groupBy(*by) if by else q.groupBy()).agg(n, F.struct(*fences).alias("fences")))
    fine, lang, corpus = levels
    fine = fine.withColumnsRenamed({"n_docs": "n0", "fences": "f0"})
    lang = lang.withColumnsRenamed({"n_docs": "n1", "fences": "f1"})
    corpus = corpus.withColumnsRenamed({"n_docs": "n2", "fences": "f2"})
    both = fine.join(lang, "lang", "left").join(F.broadcast(corpus))     # the corpus level is one row
    pick = F.when(F.col("n0") >= min_docs, F.col("f0")).when(F.col("n1") >= min_docs, F.col("f1")).otherwise(F.col("f2"))
    return both.select("lang", "source", "n0", pick.alias("fences"))


def fit(counts: DataFrame, min_docs: int = 200) -> DataFrame:
    """The thresholds as a small written table, salted copies for hot groups included."""
    return write_table(thresholds(sketches(counts), min_docs), "quality-thresholds")


def with_fences(rows: DataFrame, fences: DataFrame, lang: str, source: str, salt: F.Column) -> DataFrame:
    """Add the group's fences.  Few groups are broadcast; many are joined on salted keys."""
    f = fences.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), F.col("fences").alias("_fences"))
    on = (F.coalesce(rows[lang], F.lit("")) == F.col("_lang")) & (F.coalesce(rows[source], F.lit("")) == F.col("_source"))
    if fences.count() <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(f), on, "left").drop("_lang", "_source")
    f = f.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    return rows.join(f, on & (salt == F.col("_salt")), "left").drop("_lang", "_source", "_salt")


def within() -> F.Column:
    """True if every signal lies within the fences (a group without a sketch has none)."""
    ok = F.lit(True)
    for s in SIGNALS:
        ok &= ~F.coalesce(F.expr(s.value) > F.col(f"_fences.{s.name}_high"), F.lit(False))
        ok &= ~F.coalesce(F.expr(s.value) < F.col(f"_fences.{s.name}_low"), F.lit(False))
    return ok


def verdicts(docs: DataFrame, min_docs: int = 200) -> DataFrame:
    """doc_id, the base counts, base_failed and kept, one row per document."""
    counts = write_table(measured(docs), "quality-counts")
    rows = with_fences(counts, fit(counts, min_docs), "lang", "source", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    failed = base_failed()
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"),
                       F.when(failed, F.lit(False)).otherwise(within()).alias("kept"))


def quality_filter(docs: DataFrame, min_docs: int = 200) -> DataFrame:
    """The documents that the rules keep, with their own columns.

    Counts are taken twice (for the sketches, and beside each row for the verdict), so that
    no text is shuffled and a row needs no unique id.
    """
    fences = fit(measured(docs), min_docs)
    names = docs.columns
    width = len(names)
    plain = docs.toDF(*[f"c{i}" for i in range(width)])
    text = f"c{names.index('text')}"
    schema = ", ".join(f"c{i} {docs.schema[i].dataType.simpleString()}" for i in range(width))
    rows = plain.mapInArrow(lambda it: _measured(it, text, True), f"{schema}, counts {_COUNTS_TYPE}") \
        .select("*", "counts.*")
    joined = with_fences(rows, fences, f"c{names.index('lang')}", f"c{names.index('source')}",
                         F.pmod(F.xxhash64(F.col(text)), F.lit(SALTS)))
    kept = joined.where(~base_failed() & within())
    return kept.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
