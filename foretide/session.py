"""Session settings and lineage cuts."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# A key with more rows than this is split over several tasks instead of going through one.
HOT_ROWS = ("foretide.hot.rows", 5_000_000)
# Rows one task gets from a split key.
CHUNK_ROWS = ("foretide.chunk.rows", 1_000_000)
# Rows one task gets from a shuffle of small keys.
TASK_ROWS = ("foretide.task.rows", 100_000)
# Spark's own switch that removes an execution's shuffle files when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: str = "*", memory: str = "8g") -> SparkSession:
    """A session for tests and benches; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("foretide")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Narrow shuffled rows grow wide in the feature plans: keep all local cores busy.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def setting(spark: SparkSession, entry: tuple[str, int]) -> int:
    name, default = entry
    return int(spark.conf.get(name, str(default)))


def run_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the cluster's `spark.checkpoint.dir`, else one of a local session."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = os.path.join(tempfile.gettempdir(), f"foretide-checkpoints-{os.getpid()}")
    return folder


def stable(df: DataFrame) -> DataFrame:
    """Write df to the checkpoint folder so that later stages all see the same rows.

    Needed where a value depends on the physical partition (range chunks): a lost executor must
    not lead to a second, different split. The folder is the cluster's `spark.checkpoint.dir`.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(run_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Write df once as Parquet in the folder that executors share, and read that from here on.

    For tables of the input's size: a checkpoint keeps every row as it lies in memory, which takes several times the disk
    of compressed columns. Nothing reads the shuffles of the write afterwards, so they go with its end.
    """
    spark = df.sparkSession
    path = f"{run_folder(spark)}/written-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, keys, rows: int) -> DataFrame:
    """df of so many rows, hashed by keys into tasks of about TASK_ROWS rows.

    The session's number of shuffle partitions does not grow with the input, and adaptive execution joins them by the
    bytes of the narrow rows shuffled, down to one for each core; where that gives tasks that small, df stays as it is.
    """
    spark = df.sparkSession
    parts = math.ceil(rows / setting(spark, TASK_ROWS))
    sure = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(parts, *keys) if parts > sure else df
