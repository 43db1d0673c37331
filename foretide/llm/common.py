"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Text bytes that one numpy step works on; bounds a task's memory however many rows a batch has.
STEP_BYTES = 2 << 20
# Rows of one Arrow batch of documents: Spark's default of 10 000 is tens of MB of text, held in the JVM and in Python.
BATCH_ROWS = 500
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """From here on, the session's Arrow batches have at most BATCH_ROWS rows. A lower setting of the session stays."""
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def keyed_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text) alone, null text as the empty text: further columns of any name do not matter."""
    return docs.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(text), F.lit("")).alias(text))


def remainder(key: str, by: int) -> Column:
    """crc32 of the key as text, modulo `by`; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % by


def in_steps(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows of about `limit` text bytes; one longer text is a step of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum([0, *sizes])
        start = 0
        for row in range(1, batch.num_rows + 1):
            if row == batch.num_rows or ends[row + 1] - ends[start] > limit:
                yield batch.slice(start, row - start)
                start = row
