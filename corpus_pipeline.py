"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and reread as the next one's
docs: toxic documents go, repeated lines go, one document of each near-duplicate class stays, byte strings of earlier
documents go, the rest is packed. All but the last keep the columns of documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foretide.llm import lines, minhash, packing, suffix, toxicity
from foretide.llm.common import small_batches
from foretide.session import run_folder

# Documents that score at least this are toxic.
TOXIC = 0.3
ORACLE_SQL = None  # a trained field, hashing and byte strings: tested against brute force instead


def _whole(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text): the whole row under one name, so that further columns cannot clash."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def _columns(found: DataFrame, docs: DataFrame) -> DataFrame:
    return found.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below TOXIC, by a field fitted on all labels. Null and empty texts stay."""
    small_batches(spark)
    crf = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), F.lit(True))
    return toxicity.keep_clean(docs, crf, TOXIC)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs; a document that loses all its lines goes."""
    return lines.drop_repeats(docs)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each near-duplicate class. Rows without doc_id stay."""
    small_batches(spark)
    found = minhash.classes(docs.select("doc_id", "text"))
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct()
    whole = _whole(docs)
    return _columns(whole.join(gone, whole.doc_id == gone.gone, "left_anti"), docs)


def without_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without byte strings of earlier documents; a document that loses all its bytes goes.

    A character that loses some of its bytes goes as a whole.
    """
    small_batches(spark)
    found = suffix.removed(docs, readable=True).select("doc_id", (F.size("starts") > 0).alias("cut"), "kept", "row", "has_text")
    found = found.where(~F.col("cut") | (F.col("kept") != ""))
    row = lambda c: F.col("row").getField(c)
    columns = {c: row(c) for c in docs.columns} | {
        "doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType),
        "text": F.when(F.col("has_text"), F.col("kept")),
    }
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col("cut"), F.length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(row("n_chars"))
    return found.select(*[columns[c].alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 1024 ids."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("minhash_near_dedup", one_of_each_class),
    ("suffix_array_dedup", without_repeated_strings),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what lies between them is written to the shared checkpoint folder.

    Rows that share a doc_id are judged by their own text in the toxicity and line stages, go or stay together in the
    near-duplicate stage, and are one document in the string stage; an empty table gives no piece.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{run_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
