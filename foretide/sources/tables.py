"""Tabular readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foretide import fixed
from foretide.functions.scalars import day
from foretide.operators.quality import DataProblem, first_existing, require_columns


def read_csv(spark: SparkSession, path: str, schema, columns=None) -> DataFrame:
    """CSV with header and a declared schema; bad cells become NULL."""
    df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    return df.select(*columns) if columns else df


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path can be read on the cluster's file system."""
    try:
        spark.read.format("binaryFile").load(path).select("path").limit(1).collect()
        return True
    except Exception as error:  # Spark reports a missing path as an analysis error
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise


def first_path(spark: SparkSession, candidates) -> str:
    """First existing path of several."""
    for path in candidates:
        if exists(spark, path):
            return path
    raise DataProblem(f"none of {list(candidates)} exists")


def date_range(df: DataFrame, candidates=fixed.DATE_COLUMNS):
    """(first, last) valid day of the first of several date columns that df has."""
    found = day(F.col(first_existing(df, candidates)).cast("string"))
    first, last = df.agg(F.min(found), F.max(found)).first()
    if first is None:
        raise DataProblem("no valid day")
    return first, last


def first_date_range(spark: SparkSession, paths, reader, candidates=fixed.DATE_COLUMNS):
    """date_range() of the first existing table: the finished one, else the matches."""
    return date_range(reader(first_path(spark, paths)), candidates)


def seasons_in_scope(seasons: DataFrame, first: int, last: int | None = None, column: str = "saison") -> DataFrame:
    """Rows whose season lies between first and last, both included; without last up to the latest season."""
    season = F.col(column).try_cast("long")
    scope = season >= first if last is None else season.between(first, last)
    found = seasons.filter(scope)
    if found.isEmpty():
        raise DataProblem(f"no season from {first} to {'the latest' if last is None else last}")
    return found


def read_optional(spark: SparkSession, path: str, reader) -> tuple[DataFrame | None, str | None]:
    """(table, None), or (None, reason) when the file is missing."""
    return (reader(path), None) if exists(spark, path) else (None, "file_missing")


def read_odds(spark: SparkSession, path: str) -> DataFrame:
    """Price document {bookmaker, ..., rows: [...]} -> one row per price."""
    text = spark.read.option("wholetext", True).text(path).withColumnRenamed("value", "document")
    return odds_rows(text, "document")


def odds_rows(df: DataFrame, document: str) -> DataFrame:
    """Rows of price documents held as text; raises when a document lacks a key or its rows are no list."""
    keys = F.json_object_keys(document)
    listed = F.get_json_object(document, "$.rows").startswith("[")
    lacking = F.array_except(F.array(*[F.lit(k) for k in fixed.ODDS_ENVELOPE]), keys)
    broken = df.filter(keys.isNull() | (F.size(lacking) > 0) | ~F.coalesce(listed, F.lit(False)))
    if not broken.isEmpty():
        raise DataProblem("price document without its keys or with rows that are no list")
    numbers = ("threshold", "odds_decimal", "implied_probability")
    fields = ", ".join(f"{c}: string" for c in fixed.ODDS_ROW)
    parsed = F.from_json(document, f"struct<rows: array<struct<{fields}>>>")
    rows = df.select(F.explode(parsed["rows"]).alias("r")).select("r.*")
    return rows.withColumns({c: F.col(c).try_cast("double") for c in numbers})


def write_table(df: DataFrame, path: str, form: str = "parquet") -> None:
    """Full overwrite as parquet, CSV with header, or JSON lines."""
    writer = df.write.mode("overwrite")
    writer.option("header", True).csv(path) if form == "csv" else writer.format(form).save(path)


def write_dated(df: DataFrame, path: str, column: str = "run_date") -> None:
    """Replace only the dated partitions present in df."""
    require_columns(df, [column])
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def land_raw(df: DataFrame, path: str, keys) -> None:
    """Keep fetched documents unchanged next to the parsed table, by landing keys."""
    df.write.mode("append").partitionBy(*keys).json(path)
