"""Corpus pipeline: quality rules, near-duplicates, secrets, mixing, and byte-level BPE.

Each stage takes (spark, docs, sf_dir), works on every document that the one before it left,
and returns a DataFrame, which is written as Parquet and read again for the next.  All but
the last return the columns of ``documents``:

* ``quality``: documents that fail the base rules or their group's adaptive fences go.
* ``near_dedup``: of every component of near-duplicates the document of the least id stays.
* ``secrets``: secrets in the texts are replaced by their kind; ``n_chars`` follows.
* ``mixing``: sources are mixed to temperature weights, so a document comes as often as the
  mixture reads it.
* ``byte_bpe``: one row per reading with the digests of its ids and of the decoded bytes.

Edge cases are those of the operators: null and empty texts fail the base rules and go;
an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliopanel.llm import byte_bpe, mixing, near_dedup, quality, secret_scan
from heliopanel.llm.common import table, write_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact_secrets(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality", quality_rules), ("near_dedup", near_duplicates), ("secrets", secrets),
          ("mixing", mix_sources), ("byte_bpe", encode)]

#: SQL cannot state BPE or the near-duplicate components at this size; tests/llm/test_pipeline.py
#: holds the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
