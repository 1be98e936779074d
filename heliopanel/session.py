"""Session settings shared by the library, the tests and the bench."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC clock (calendar features and DuckDB parity),
# ANSI semantics (bad timestamps raise, as in the reference), AQE for runtime
# broadcast / skew / partition-coalescing decisions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partition sizing: AQE coalesces shuffle output towards 128 MB partitions (fits an
    # executor core's share of memory without spilling on wide rows) and splits skewed join
    # partitions; scans are cut at 128 MB per task.  Cluster jobs set the initial
    # spark.sql.shuffle.partitions high (e.g. 2-3x total cores) and let AQE coalesce.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, app: str = "heliopanel",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable part of BASE_CONF to an existing session."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and derived tables: the cluster's ``spark.checkpoint.dir``.

    A local session without one gets a scratch folder; on a cluster that is an error, since
    executors could not see a folder of the driver's machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if not named:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
            named = tempfile.mkdtemp(prefix="heliopanel-ckpt-")
        sc.setCheckpointDir(named)
    return named or sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never a local checkpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


_MATERIALIZED: dict[tuple, tuple[str, tuple]] = {}


def materialize(df: DataFrame, name: str, key: object = None, partition_by: tuple = (),
                cluster_by: tuple = ()) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Used where a derived table (e.g. the hourly panel aggregated from raw events) feeds
    several branches of a plan: without it every branch would re-scan and re-aggregate the
    raw table.  Parquet keeps column pruning and filter pushdown on the re-reads, and the
    files survive executor loss (no local checkpoint).  Memoised per application, name, key
    and state of the source files (paths, sizes, times), so appended data is seen; a table
    that is written anew for the same name and key replaces the older one.
    """
    import uuid

    spark = df.sparkSession
    k = (spark.sparkContext.applicationId, name, key)
    version = _source_version(df)
    if k not in _MATERIALIZED or _MATERIALIZED[k][1] != version:
        stale = _MATERIALIZED.pop(k, None)
        path = os.path.join(checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")
        if cluster_by:
            df = df.sortWithinPartitions(*cluster_by)
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        _MATERIALIZED[k] = (path, version)
        if stale:
            _remove(spark, stale[0])
    return spark.read.parquet(_MATERIALIZED[k][0])


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _source_version(df: DataFrame) -> tuple:
    """(path, length, modification time) of every file that ``df`` reads."""
    spark, out = df.sparkSession, []
    for name in sorted(df.inputFiles()):
        fs, p = _file_system(spark, name)
        state = fs.getFileStatus(p)
        out.append((name, state.getLen(), state.getModificationTime()))
    return tuple(out)


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Stage boundary in a chain of operators that read their input twice (a small
    per-key/day table plus the main pass): write once, re-read by every later branch, so
    scans grow linearly with the chain instead of doubling per operator."""
    import uuid
    return materialize(df, name, uuid.uuid4().hex)
