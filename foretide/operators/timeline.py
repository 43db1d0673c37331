"""Operators along an entity's timeline: gaps, episodes, streaks, earlier seasons, as-of lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foretide.functions.scalars import clip
from foretide.operators.ordered import (
    HotKeys,
    find_hot,
    last_seen,
    over_order,
    previous,
    running_count,
    running_max,
    running_sum,
)


def days_since_previous(df, keys, order, date, name, season=None, hot=None) -> DataFrame:
    """Whole days since the previous row of the key; NULL on the first row and, with `season`, across seasons."""
    frames = [previous("__prev_date", date)] + ([previous("__prev_season", season)] if season else [])
    out = over_order(df, keys, order, frames, hot)
    gap = F.date_diff(F.col(date), F.col("__prev_date"))
    if season:
        gap = F.when(F.col("__prev_season") == F.col(season), gap)
    return out.withColumn(name, gap).drop("__prev_date", "__prev_season")


def run_since(df, keys, order, reset, name, hot=None) -> DataFrame:
    """Consecutive rows up to and including this one without `reset` (a boolean column); 0 on a reset row."""
    hot = find_hot(df, list(keys)) if hot is None else hot
    out = over_order(df, keys, order, [running_count("__n", current=True)], hot)
    out = over_order(out, keys, order, [last_seen("__at", F.when(reset, F.col("__n")), current=True)], hot)
    return out.withColumn(name, F.col("__n") - F.coalesce("__at", F.lit(0))).drop("__n", "__at")


def current_streaks(df, keys, order, hit, hits_name, misses_name, hot=None) -> DataFrame:
    """Length of the hit run and of the miss run that end just before this row."""
    hot = find_hot(df, list(keys)) if hot is None else hot
    out = over_order(df, keys, order, [running_count("__n")], hot)
    spot = F.col("__n") + 1
    out = over_order(
        out,
        keys,
        order,
        [
            last_seen("__miss", F.when(F.coalesce(F.col(hit), F.lit(0)) != 1, spot)),
            last_seen("__hit", F.when(F.col(hit) == 1, spot)),
        ],
        hot,
    )
    return out.withColumns(
        {
            hits_name: F.col("__n") - F.coalesce("__miss", F.lit(0)),
            misses_name: F.col("__n") - F.coalesce("__hit", F.lit(0)),
        }
    ).drop("__n", "__miss", "__hit")


def two_season_streaks(df, keys, order, season, hit, names, long_run=5, hot=None) -> DataFrame:
    """Longest hit run, longest miss run, number of runs that reached `long_run`, and row count,
    over the earlier rows of this season and the one before it.

    Runs may cross from one season to the next but start afresh where the two-season span starts.
    Each row is therefore shown to its own season and, without its other columns, to the next one;
    inside (key, shown season) the span is simply "all earlier rows".
    """
    longest, longest_miss, long_runs, rows = names
    hot = find_hot(df, list(keys)) if hot is None else hot
    own = [c for c in df.columns if c not in (*keys, *order, season, hit)]
    payload = F.struct(*own) if own else F.struct(F.lit(1).alias("__one"))
    kind = df.select(payload.alias("p")).schema["p"].dataType
    views = F.array(
        F.struct(F.col(season).alias("span"), F.lit(True).alias("own"), payload.alias("kept")),
        F.struct(
            (F.col(season) + 1).cast(df.schema[season].dataType).alias("span"),
            F.lit(False).alias("own"),
            F.lit(None).cast(kind).alias("kept"),
        ),
    )
    spread = df.select(*keys, *order, season, hit, F.explode(views).alias("__view"))
    spread = spread.select(
        *keys, *order, season, hit, F.col("__view.span").alias("__span"), F.col("__view.own").alias("__own"),
        F.col("__view.kept").alias("__kept"),
    )

    group = [*keys, "__span"]
    is_hit = F.coalesce(F.col(hit), F.lit(0)) == 1
    out = over_order(spread, group, order, [running_count("__n", current=True)], hot)
    out = over_order(
        out,
        group,
        order,
        [
            last_seen("__miss", F.when(~is_hit, F.col("__n")), current=True),
            last_seen("__hit", F.when(is_hit, F.col("__n")), current=True),
        ],
        hot,
    )
    run = F.col("__n") - F.coalesce("__miss", F.lit(0))
    out = over_order(
        out,
        group,
        order,
        [
            running_max(longest, run),
            running_max(longest_miss, F.col("__n") - F.coalesce("__hit", F.lit(0))),
            running_sum(long_runs, (run == long_run).cast("int")),
            running_count(rows),
        ],
        hot,
    )
    out = out.filter("__own")
    return out.select(
        *keys,
        *order,
        season,
        hit,
        *[F.col(f"__kept.{c}").alias(c) for c in own],
        *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names],
    )


def previous_season_means(df, keys, season, means: dict[str, str], count: tuple[str, str], hot=None) -> DataFrame:
    """Means over all rows of the season before, per key, with the number of those rows.

    Small keys: a value range frame inside the shuffle the other player windows use, no join.
    Hot keys: one row per (key, season) is aggregated first and looked up.
    """
    name, counted = count
    hot = find_hot(df, list(keys)) if hot is None else hot

    def by_range(part):
        w = Window.partitionBy(*keys).orderBy(season).rangeBetween(-1, -1)
        found = {n: F.avg(c).over(w) for n, c in means.items()}
        seen = F.count(counted).over(w)
        return part.withColumns(found | {name: F.when(seen > 0, seen)})

    if not hot.found:
        return by_range(df)
    hot_rows, cold_rows = hot.split(df)
    summary = (
        hot_rows.groupBy(*keys, season)
        .agg(F.count(counted).alias(name), *[F.avg(c).alias(n) for n, c in means.items()])
        .withColumn(season, (F.col(season) + 1).cast(df.schema[season].dataType))
    )
    looked_up = hot_rows.join(summary, [*keys, season], "left")
    return looked_up.select(*df.columns, *means, name).unionByName(by_range(cold_rows).select(*df.columns, *means, name))


def episodes(df, keys, order, starts, name, hot=None) -> DataFrame:
    """Number of episode starts up to and including this row."""
    return over_order(df, keys, order, [running_sum(name, starts, current=True)], hot)


def as_of(left: DataFrame, snapshots: DataFrame, by: str, left_date: str, snapshot_date: str, fields, suffix="") -> DataFrame:
    """Latest snapshot at or before the left date, per `by`.

    The answer depends only on (by, date), so the lookup runs once per distinct pair, over pairs
    and snapshots in one ordering; the wide left table is joined by equality afterwards.
    """
    pairs = left.select(F.col(by).alias("__by"), F.col(left_date).alias("__day")).distinct()
    names = [f if f != snapshot_date else snapshot_date for f in fields]
    found = F.struct(*[F.col(f).alias(f"f{i}") for i, f in enumerate(names)])
    right = snapshots.select(F.col(by).alias("__by"), F.col(snapshot_date).alias("__day"), found.alias("__found"))
    kind = right.schema["__found"].dataType
    tagged = right.withColumn("__side", F.lit(0)).unionByName(
        pairs.withColumn("__found", F.lit(None).cast(kind)).withColumn("__side", F.lit(1))
    )
    line = over_order(
        tagged.filter(F.col("__by").isNotNull() & F.col("__day").isNotNull()),
        ["__by"],
        ["__day", "__side"],
        [last_seen("__last", "__found", current=True)],
    )
    hits = line.filter(F.col("__side") == 1).select(
        F.col("__by").alias(by),
        F.col("__day").alias(left_date),
        *[F.col(f"__last.f{i}").alias(f"{f}{suffix}") for i, f in enumerate(names)],
    )
    return left.join(hits, [by, left_date], "left")


def sides(matches: DataFrame, home: dict[str, str], away: dict[str, str], keep, flag: str) -> DataFrame:
    """Two rows per match, one seen from each side: explode of two structs, one scan and no union."""
    one = lambda names, mark: F.struct(
        *[F.col(source).alias(target) for target, source in names.items()], F.lit(mark).alias(flag)
    )
    return matches.select(*keep, F.explode(F.array(one(home, 1), one(away, 0))).alias("__side")).select(
        *keep, "__side.*"
    )


def clipped_gap(c, default, low, high):
    return clip(F.coalesce(c, F.lit(default)), low, high)


__all__ = [
    "HotKeys", "as_of", "clipped_gap", "current_streaks", "days_since_previous", "episodes",
    "previous_season_means", "run_since", "sides", "two_season_streaks",
]
