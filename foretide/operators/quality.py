"""Blocking checks, audits and profiles. Checks return counts from one aggregation and raise on failure."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


class DataProblem(ValueError):
    """A blocking check failed."""


def require_columns(df: DataFrame, columns, label: str = "table") -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise DataProblem(f"{label}: missing columns {missing}")
    return df


def first_existing(df: DataFrame, candidates, required: bool = True) -> str | None:
    """First of several accepted column names that the table has."""
    for name in candidates:
        if name in df.columns:
            return name
    if required:
        raise DataProblem(f"none of {list(candidates)} present")
    return None


def rename_legacy(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename old -> new where only the old column exists."""
    return df.withColumnsRenamed({o: n for o, n in names.items() if o in df.columns and n not in df.columns})


def with_missing(df: DataFrame, defaults: dict) -> DataFrame:
    """Create absent optional columns with a default value (a literal or a typed Column)."""
    absent = {c: v if isinstance(v, Column) else F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def known_first(df: DataFrame, front) -> DataFrame:
    """Known columns in a fixed order, every other column after them."""
    lead = [c for c in front if c in df.columns]
    return df.select(*lead, *[c for c in df.columns if c not in lead])


def duplicates(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def require_unique(df: DataFrame, keys, label: str = "table") -> DataFrame:
    bad = duplicates(df, keys).limit(10).collect()
    if bad:
        raise DataProblem(f"{label}: duplicate keys {list(keys)}, e.g. {[r.asDict() for r in bad]}")
    return df


def join_many_to_one(left: DataFrame, right: DataFrame, keys, label: str = "lookup") -> DataFrame:
    """Left join that first checks that the right side has one row per key."""
    return left.join(require_unique(right, keys, label), list(keys), "left")


@dataclass
class Dropped:
    """What a cleaning pass left out, counted by the pass itself.

    The counts are those of the first action that reads all the cleaned rows, and wait for it.
    """

    before: Observation = field(default_factory=Observation)
    after: Observation = field(default_factory=Observation)

    def unkeyed(self, df: DataFrame, keys) -> DataFrame:
        """Rows with all keys."""
        lacking = reduce(or_, [F.col(k).isNull() for k in keys])
        watched = df.observe(self.before, F.count(F.lit(1)).alias("rows"), F.count_if(lacking).alias("unkeyed"))
        return watched.dropna(subset=list(keys))

    def unplaced(self, df: DataFrame, columns) -> DataFrame:
        """Rows, one for each key by now, with all columns."""
        gone = {f"without_{c}": F.count_if(F.col(c).isNull()) for c in columns}
        lacking = reduce(or_, [F.col(c).isNull() for c in columns])
        watched = df.observe(
            self.after, F.count(F.lit(1)).alias("rows"), F.count_if(lacking).alias("unplaced"), *[m.alias(n) for n, m in gone.items()]
        )
        return watched.dropna(subset=list(columns))

    @property
    def counts(self) -> dict[str, int]:
        """rows read; unkeyed, copies of a key and unplaced rows left out; per column rows without it; rows kept."""
        first, last = dict(self.before.get), dict(self.after.get)
        rows, unkeyed, unplaced = first["rows"], first["unkeyed"], last.pop("unplaced")
        single = last.pop("rows")
        return {"rows": rows, "unkeyed": unkeyed, "copies": rows - unkeyed - single, "unplaced": unplaced, "kept": single - unplaced} | last


def null_counts(df: DataFrame, columns) -> DataFrame:
    """One row: how many rows lack each column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def require_filled(df: DataFrame, columns, text=(), label: str = "table") -> DataFrame:
    """No NULL in `columns` and no empty text in `text`."""
    tests = {c: F.col(c).isNull() for c in columns} | {f"{c} (empty)": F.trim(F.col(c)) == "" for c in text}
    return require_none(df, tests, label)


def violations(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """One row with the number of rows breaking each rule."""
    return df.agg(*[F.count_if(F.coalesce(t, F.lit(False))).alias(n) for n, t in tests.items()])


def require_none(df: DataFrame, tests: dict[str, Column], label: str = "table") -> DataFrame:
    bad = {k: v for k, v in violations(df, tests).first().asDict().items() if v}
    if bad:
        raise DataProblem(f"{label}: {bad}")
    return df


def require_rows(df: DataFrame, label: str = "table") -> DataFrame:
    if df.isEmpty():
        raise DataProblem(f"{label}: no rows")
    return df


def require_at_least(df: DataFrame, column: str, n: int, label: str = "table") -> DataFrame:
    """At least n distinct values of a column."""
    found = df.agg(F.count_distinct(column).alias("n")).first()["n"]
    if found < n:
        raise DataProblem(f"{label}: {found} distinct {column}, need {n}")
    return df


def require_binary(df: DataFrame, column: str) -> DataFrame:
    return require_none(df, {f"{column} not 0/1": ~F.col(column).isin(0, 1)}, "target")


def examples(df: DataFrame, bad: Column, columns, n: int = 10) -> DataFrame:
    """A few offending rows for a report."""
    return df.filter(bad).select(*columns).orderBy(*columns).limit(n)


def missing_from(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Distinct keys absent from a dimension."""
    return df.select(key).distinct().join(dimension.select(key).distinct(), key, "left_anti")


def require_members(groups: DataFrame, rows: DataFrame, key: str, label: str = "table") -> DataFrame:
    """The groups (played matches, say), each of which must have rows; raises with examples of those that have none."""
    bad = missing_from(groups, rows, key).orderBy(key).limit(10).collect()
    if bad:
        raise DataProblem(f"{label}: no rows for {key} {[r[key] for r in bad]}")
    return groups


def coverage(df: DataFrame, conditions: dict[str, Column], keys=()) -> DataFrame:
    """Share of rows for which each condition holds."""
    shares = [F.avg(F.coalesce(c, F.lit(False)).cast("double")).alias(n) for n, c in conditions.items()]
    return df.groupBy(*keys).agg(*shares) if keys else df.agg(*shares)


def _distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n): how often each value (as text, or null) stands in each column.

    Every Arrow batch passes on its different values with their counts, so a row is never repeated per column.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, column in zip(batch.schema.names, batch.columns, strict=True):
                found = pc.value_counts(column)
                names = pa.array([name] * len(found), pa.string())
                yield pa.RecordBatch.from_arrays([names, found.field("values"), found.field("counts")], ["column", "value", "n"])

    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return texts.mapInArrow(count, "column string, value string, n long").groupBy("column", "value").agg(F.sum("n").alias("n"))


def profile(df: DataFrame, columns, exact: bool = True, quantiles=()) -> DataFrame:
    """(column, rows, filled, distinct_values, least, greatest) per column; least and greatest as text.

    Without `exact` everything comes from one aggregation: distinct values are a sketch's estimate (about 2 % off), and
    `quantiles` gives number columns an array of quantiles of the same kind, null for others. With it, distinct values
    are counted by value and quantiles are not given.
    """
    columns, quantiles = list(columns), list(quantiles)
    numbers = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    at = F.array(*[F.lit(q) for q in quantiles]) if quantiles else None

    def measures(i: int, c: str) -> list[Column]:
        found = [F.count(F.lit(1)), F.count(c), F.min(c).cast("string"), F.max(c).cast("string")]
        if not exact:
            found.append(F.approx_count_distinct(c, 0.02))
            if quantiles:
                found.append(F.percentile_approx(F.col(c).cast("double"), at, 10_000) if c in numbers else F.lit(None).cast("array<double>"))
        return [m.alias(f"m{k}_{i}") for k, m in enumerate(found)]

    names = ["rows", "filled", "least", "greatest"] + ([] if exact else ["distinct_values"] + (["quantiles"] if quantiles else []))
    one = df.agg(*[m for i, c in enumerate(columns) for m in measures(i, c)])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"m{k}_{i}").alias(n) for k, n in enumerate(names)]) for i, c in enumerate(columns)
    ]))
    table = one.select(stacked.alias("s")).select("s.*")
    if not exact:
        return table
    distinct = _distinct_counts(df, columns).groupBy("column").agg(F.count("value").alias("distinct_values"))
    return table.join(distinct, "column", "left").withColumn("distinct_values", F.coalesce("distinct_values", F.lit(0)))


def complete_groups(df: DataFrame, group: str, member: str, expected: int) -> DataFrame:
    """Distinct members per group and whether the group is complete."""
    counts = df.groupBy(group).agg(F.count_distinct(member).alias("members"))
    return counts.withColumn("complete", (F.col("members") == expected).cast("int"))


def resolve_features(df: DataFrame, wanted, forbidden) -> tuple[list[str], list[str], list[str]]:
    """(usable, missing, forbidden) among the wanted feature names."""
    banned = [c for c in wanted if c in set(forbidden)]
    usable = [c for c in wanted if c in df.columns and c not in banned]
    missing = [c for c in wanted if c not in df.columns and c not in banned]
    return usable, missing, banned


def require_no_leak(features, forbidden, target: str, date: str) -> list[str]:
    bad = sorted(set(features) & (set(forbidden) | {target, date}))
    if bad:
        raise DataProblem(f"forbidden features {bad}")
    return list(features)


def useful_features(train: DataFrame, features, at_least: int = 5) -> list[str]:
    """Features with at least two different values in the training rows (one aggregation)."""
    spread = train.agg(
        *[F.min(c).alias(f"lo_{i}") for i, c in enumerate(features)],
        *[F.max(c).alias(f"hi_{i}") for i, c in enumerate(features)],
    ).first()
    kept = [c for i, c in enumerate(features) if spread[f"lo_{i}"] is not None and spread[f"lo_{i}"] < spread[f"hi_{i}"]]
    if len(kept) < at_least:
        raise DataProblem(f"only {len(kept)} usable features, need {at_least}")
    return kept
