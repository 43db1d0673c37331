"""Landing of raw documents as a file stream, and results with a counted envelope.

A run takes the files that arrived since the last one (available now) and ends. The stream's progress and the sink's own
log, both beside the landed rows, make every file land once, also when a run is broken off and repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from foretide.operators.quality import DataProblem

_LANDED = "document string, file string, changed timestamp"
_ENVELOPE = "rows_count long"


def land(spark: SparkSession, source: str, path: str, files: int = 1000, lines: bool = False) -> int:
    """Land the new files of a folder, `files` at a time, unchanged; returns how many documents came.

    A file is one document; with `lines` each of its lines is one.
    """
    text = spark.readStream.format("text").option("wholetext", not lines).option("maxFilesPerTrigger", files).load(source)
    rows = text.select(
        F.col("value").alias("document"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("changed")
    )
    query = (
        rows.writeStream.format("parquet").option("path", f"{path}/documents").option("checkpointLocation", f"{path}/progress")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def landed(spark: SparkSession, path: str) -> DataFrame:
    """(document, file, changed) of everything that landed."""
    return spark.read.schema(_LANDED).parquet(f"{path}/documents")


def write_counted(df: DataFrame, path: str) -> int:
    """Rows as JSON lines and, once they are all written, an envelope with their number; returns it."""
    counted = Observation()
    df.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(f"{path}/rows")
    n = counted.get["n"]
    df.sparkSession.createDataFrame([(n,)], _ENVELOPE).coalesce(1).write.mode("overwrite").json(f"{path}/envelope")
    return n


def read_counted(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of a counted result; raises when there are not as many as its envelope says."""
    rows = spark.read.schema(schema).json(f"{path}/rows")
    told = spark.read.schema(_ENVELOPE).json(f"{path}/envelope").first().rows_count
    found = rows.count()
    if found != told:
        raise DataProblem(f"{path}: {found} rows, the envelope says {told}")
    return rows
