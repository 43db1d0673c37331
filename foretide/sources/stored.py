"""Stored keyed tables: Parquet in buckets of the key's hash, of which an upsert rewrites only those it changes.

A bucket is a partition folder, so reading the buckets a batch touches is partition pruning and writing them back is a
dynamic partition overwrite. Buckets whose rows stay the same are not written: a batch that runs twice changes no file.
Keys, number of buckets and schema lie in a small JSON file beside the buckets.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foretide.functions import scalars as S
from foretide.operators import keyed as K
from foretide.operators import quality as Q
from foretide.session import stable

# Stored rows, new rows and keys -> rows to store.
Merge = Callable[[DataFrame, DataFrame, list[str]], DataFrame]

_BUCKET = "bucket"
_ABOUT = "_keyed"


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(_BUCKET)


def _checked(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    Q.require_columns(df, keys, label)
    return Q.require_unique(Q.require_filled(df, keys, label=label), keys, label)


def create(df: DataFrame, path: str, keys, buckets: int = 64) -> None:
    """Store df, whose keys must be filled and unique, in a new folder. A bucket should hold what one task can take."""
    keys = list(keys)
    if _BUCKET in df.columns:
        raise Q.DataProblem(f"{path}: a column is named {_BUCKET}")
    rows = _checked(df, keys, path).select("*", _bucket(keys, buckets))
    rows.repartition(buckets, _BUCKET).write.partitionBy(_BUCKET).parquet(path)
    about = df.sparkSession.createDataFrame([(keys, buckets, df.schema.json())], "keys array<string>, buckets int, fields string")
    about.coalesce(1).write.json(f"{path}/{_ABOUT}")


def _about(spark: SparkSession, path: str) -> tuple[list[str], int, T.StructType]:
    found = spark.read.schema("keys array<string>, buckets int, fields string").json(f"{path}/{_ABOUT}").first()
    return found.keys, found.buckets, T.StructType.fromJson(json.loads(found.fields))


def _buckets(spark: SparkSession, path: str) -> DataFrame:
    _, _, schema = _about(spark, path)
    return spark.read.schema(T.StructType([*schema, T.StructField(_BUCKET, T.IntegerType())])).parquet(path)


def read(spark: SparkSession, path: str, required=()) -> DataFrame:
    """The stored rows, after a check of the wanted columns and of the keys."""
    keys, _, _ = _about(spark, path)
    rows = Q.require_columns(_buckets(spark, path).drop(_BUCKET), list(required), path)
    return _checked(rows, keys, path)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """A stored table of daily snapshots: valid days and upper-case teams, rows without a day left out."""
    rows = read(spark, path, ["date_snapshot", "team_abbrev"])
    clean = rows.withColumns({"date_snapshot": S.day("date_snapshot"), "team_abbrev": S.upper_code("team_abbrev")})
    return clean.filter(F.col("date_snapshot").isNotNull())


def _digests(rows: DataFrame) -> DataFrame:
    """What a bucket holds, whatever the order of its rows."""
    mark = F.xxhash64(*[c for c in rows.columns if c != _BUCKET])
    return rows.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(mark).alias("x"), F.sum(mark.cast("decimal(38,0)")).alias("s"))


def apply(path: str, batch: DataFrame, merge: Merge) -> int:
    """Merge a batch into the stored table; returns how many buckets were written.

    The batch has the stored columns (others are left out) and filled keys; `merge` sees the touched buckets only.
    """
    spark = batch.sparkSession
    keys, buckets, schema = _about(spark, path)
    Q.require_columns(batch, keys, "batch")
    fields = [(F.col(f.name) if f.name in batch.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    fresh = Q.require_filled(stable(batch.select(*fields)), keys, label="batch")
    touched = [r[_BUCKET] for r in fresh.select(_bucket(keys, buckets)).distinct().collect()]  # at most the number of buckets
    old = _buckets(spark, path).where(F.col(_BUCKET).isin(touched))
    merged = stable(merge(old.drop(_BUCKET), fresh, keys).select(*schema.names, _bucket(keys, buckets)))
    before, after = _digests(old).alias("a"), _digests(merged).alias("b")
    same = before.join(after, [_BUCKET, "n", "x", "s"]).select(_BUCKET)
    changed = [r[_BUCKET] for r in _digests(merged).join(same, _BUCKET, "left_anti").select(_BUCKET).collect()]
    if changed:
        rows = merged.where(F.col(_BUCKET).isin(changed)).repartition(len(changed), _BUCKET)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_BUCKET).parquet(path)
    return len(changed)


def upsert(path: str, batch: DataFrame, tie=()) -> int:
    """New rows replace stored rows of their key."""
    return apply(path, batch, lambda old, new, keys: K.upsert(old, new, keys, tie))


def insert_absent(path: str, batch: DataFrame) -> int:
    """Rows of keys that are not stored yet."""
    return apply(path, batch, lambda old, new, keys: K.insert_absent(old, new.dropDuplicates(keys), keys))


def merge_filled(path: str, batch: DataFrame) -> int:
    """Filled fields of new rows win, empty ones keep what is stored. The batch has a row per key at most."""
    return apply(path, Q.require_unique(batch, _about(batch.sparkSession, path)[0], "batch"), K.merge_filled)


def update(path: str, batch: DataFrame, fields) -> int:
    """Fields of stored rows that the batch names; other keys are not added."""
    return apply(path, batch, lambda old, new, keys: K.set_where_found(old, Q.require_unique(new, keys, "batch"), keys, list(fields)))
