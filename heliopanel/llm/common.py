"""Small helpers shared by the training-data operators.

Texts reach Python as Arrow batches; ``text_chunks`` cuts them into slices of a few MB so
that a worker's memory depends on the slice (or on the longest single text), never on the
partition.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by a path that Spark's own readers resolve."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only a local session may go without it: there a scratch folder is set.  On a cluster a
    missing setting is an error, since executors could not see a local folder.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) \
        or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="heliopanel-llm-")
        sc.setCheckpointDir(d)
    return d


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_sample(rows: DataFrame, key: F.Column, wanted: int) -> DataFrame:
    """The ``wanted`` distinct rows of the least keys (hashes of the row); all of them if there
    are fewer.

    Rows first pass a filter on the key, so that tasks do not send their own ``wanted`` least
    rows each: the least power of two under which ``wanted`` distinct keys lie.  Copies share
    a key and count once there, so the sample is full however often rows are repeated."""
    bits = 40
    place = F.pmod(key, F.lit(1 << bits))
    keys = rows.select(key.alias("key"), place.alias("place")).distinct()
    # one row per number of binary digits
    digits = F.when(F.col("place") == 0, 0).otherwise(F.length(F.bin("place")))
    below = 0
    for d, n in sorted(keys.groupBy(digits.alias("digits")).count().collect()):
        below += n
        if below >= wanted:
            rows = rows.where(place < (1 << d))
            break
    return rows.distinct().orderBy(place, key).limit(wanted)


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone (null text: empty); other columns cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    col = batch.column(batch.schema.get_field_index(name))
    return col.cast(pa.large_string()) if pa.types.is_string(col.type) else col


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts together hold about ``limit`` bytes (at least one row)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.frombuffer(text_column(batch, column).buffers()[1], np.int64)
        off = text_column(batch, column).offset
        sizes = sizes[off:off + batch.num_rows + 1]
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(sizes, sizes[at] + limit, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def raw_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of each text of the batch."""
    col = text_column(batch, column)
    return pa.Array.from_buffers(pa.large_binary(), len(col), col.buffers(), offset=col.offset).to_pylist()
