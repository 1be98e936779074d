"""Streaming request scoring (H3): file-source stream -> per-micro-batch scoring -> sink.

The per-request work is stateless (features come from joins against static forecast and
history tables), so each micro-batch is scored with the batch functions inside
``foreachBatch``; output goes to ``<output>/batch_id=<n>`` with overwrite, which makes a
replayed batch idempotent after a failure.  The checkpoint lives under the cluster's
shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..session import checkpoint_dir


def request_stream(spark: SparkSession, source_dir: str, schema, fmt: str = "parquet",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(source_dir)


def start_scoring(stream: DataFrame, score: Callable[[DataFrame], DataFrame], output_dir: str,
                  name: str = "score_requests", checkpoint: str | None = None,
                  available_now: bool = True) -> StreamingQuery:
    spark = stream.sparkSession
    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), "streams", name)

    def sink(batch: DataFrame, batch_id: int) -> None:
        score(batch).write.mode("overwrite").parquet(os.path.join(output_dir, f"batch_id={batch_id}"))

    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt).queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
