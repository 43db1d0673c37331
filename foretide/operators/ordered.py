"""Frames over rows in time order: rolling means, running sums, previous values, ranks.

Every frame looks only at earlier rows unless it says `current=True`, so a feature never sees the
outcome of its own row.

A plain window sends all rows of a key to one task. That is right while keys are small, and wrong
when one key (a very active entity, one team of 32, one match day) holds a large part of the table.
`over_order` therefore counts rows per key first (a map-side combined count) and

* keys below `foretide.hot.rows` go through an ordinary window: one shuffle, any number of frames;
* larger keys are cut into contiguous chunks by a range shuffle on (key, order). Each chunk gets
  what it needs from earlier ones: the last n rows for a rolling frame, and the sum / maximum /
  last value of all earlier chunks for a running frame. No task ever holds a whole hot key.

`order` must be a total order inside each key (end it with an id).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foretide.session import CHUNK_ROWS, HOT_ROWS, setting, stable

# Up to this many hot keys are broadcast; more are joined by a shuffle, whose large partitions Spark splits.
BROADCAST_KEYS = 20_000

_CHUNK, _POS, _BLOCK, _HOME = "__ord_chunk", "__ord_pos", "__ord_block", "__ord_home"


@dataclass(frozen=True)
class Frame:
    """One output column. `rows` is set for rolling frames and None for running ones."""

    name: str
    how: str
    value: Column | None = None
    rows: int | None = None
    current: bool = False


def rolling_mean(name, value, rows):
    return Frame(name, "mean", _col(value), rows)


def rolling_count(name, value, rows):
    return Frame(name, "count", _col(value), rows)


def previous(name, value):
    return Frame(name, "lag", _col(value), 1)


def running_sum(name, value, current=False):
    return Frame(name, "sum", _col(value), None, current)


def running_count(name, current=False):
    """Rows before this one (0, 1, 2, ...); with current=True the 1-based row number."""
    return Frame(name, "sum", F.lit(1), None, current)


def running_max(name, value, current=False):
    return Frame(name, "max", _col(value), None, current)


def last_seen(name, value, current=False):
    """Latest non-null value so far."""
    return Frame(name, "last", _col(value), None, current)


def _col(value):
    return F.col(value) if isinstance(value, str) else value


# ------------------------------------------------------------------ hot keys


@dataclass(frozen=True)
class HotKeys:
    """Keys that hold too many rows for one task. Valid for any finer key that contains `keys`."""

    keys: tuple[str, ...]
    found: int = 0
    total: int = 0
    listed: DataFrame | None = None

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(rows of hot keys, all other rows)."""
        if not self.keys:
            return df, df.limit(0)
        names = [f"__hot_{k}" for k in self.keys]
        listed = self.listed.toDF(*names)
        listed = F.broadcast(listed) if self.found <= BROADCAST_KEYS else listed
        same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(F.col(n)) for k, n in zip(self.keys, names)])
        return df.join(listed, same, "left_semi"), df.join(listed, same, "left_anti")


def find_hot(df: DataFrame, keys: list[str]) -> HotKeys:
    """Keys with more than `foretide.hot.rows` rows. One combined count; a second only if there are any."""
    limit = setting(df.sparkSession, HOT_ROWS)
    if not keys:
        n = df.count()
        return HotKeys((), int(n > limit), n)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    hot = stable(counts.filter(F.col("__n") > limit))  # few rows: each stands for more than `limit`
    found, total = hot.agg(F.count(F.lit(1)), F.sum("__n")).first()
    return HotKeys(tuple(keys), found, total or 0, hot.select(*keys))


# ------------------------------------------------------------------ the operator


def over_order(df: DataFrame, keys, order, frames: list[Frame], hot: HotKeys | None = None) -> DataFrame:
    """Add one column per frame, computed over the rows of each key in the given order."""
    keys, order = list(keys), _order(order)
    hot = find_hot(df, keys) if hot is None else hot
    if not hot.found:
        return _plain(df, keys, order, frames)
    hot_rows, cold_rows = hot.split(df)
    done = _chunked(hot_rows, keys, order, frames, hot.total)
    return done if not hot.keys else done.unionByName(_plain(cold_rows, keys, order, frames))


def _order(order) -> list[Column]:
    return [F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order]


def _plain(df, keys, order, frames):
    w = Window.partitionBy(*keys).orderBy(*order) if keys else Window.partitionBy(F.lit(0)).orderBy(*order)
    return df.withColumns({f.name: _over(f, w) for f in frames})


def _over(frame: Frame, w) -> Column:
    if frame.how == "lag":
        return F.lag(frame.value, 1).over(w)
    if frame.rows is not None:
        span = w.rowsBetween(-frame.rows, -1)
        return {"mean": F.avg, "count": F.count}[frame.how](frame.value).over(span)
    span = w.rowsBetween(Window.unboundedPreceding, 0 if frame.current else -1)
    if frame.how == "sum":
        return F.coalesce(F.sum(frame.value).over(span), F.lit(0))
    if frame.how == "max":
        return F.max(frame.value).over(span)
    return F.last(frame.value, ignorenulls=True).over(span)


def _chunked(df, keys, order, frames, n_rows):
    """Same result as `_plain` for keys too large for one task."""
    span = setting(df.sparkSession, CHUNK_ROWS)
    parts = max(2, math.ceil(n_rows / span))
    chunks = stable(df.repartitionByRange(parts, *keys, *order).withColumn(_CHUNK, F.spark_partition_id()))

    # Exact position of each row inside its key: rows in earlier chunks + place inside the chunk.
    sizes = chunks.groupBy(*keys, _CHUNK).agg(F.count(F.lit(1)).alias("__n"))
    upto = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, _CHUNK, F.coalesce(F.sum("__n").over(upto), F.lit(0)).alias("__ord_start"))
    inside = Window.partitionBy(*keys, _CHUNK).orderBy(*order)
    placed = join_same(chunks.withColumn("__ord_in", F.row_number().over(inside)), starts, [*keys, _CHUNK], "inner")
    placed = placed.withColumn(_POS, F.col("__ord_start") + F.col("__ord_in") - 1).drop("__ord_start", "__ord_in", _CHUNK)

    # Blocks of equal length; the last `reach` rows of a block are also shown to the next one.
    reach = max([f.rows for f in frames if f.rows] or [0])
    length = max(span, reach)
    block = F.floor(F.col(_POS) / length)
    shown = F.when(F.col(_POS) % length >= length - reach, F.array(block, block + 1)).otherwise(F.array(block))
    spread = placed.withColumn("__ord_own", block)
    spread = spread.withColumn(_BLOCK, F.explode(shown)).withColumn(_HOME, F.col(_BLOCK) == F.col("__ord_own"))

    w = Window.partitionBy(*keys, _BLOCK).orderBy(_POS)
    local = {}
    for f in frames:
        own = f if f.rows is not None else replace(f, value=F.when(F.col(_HOME), f.value))
        local[f.name] = _over(own, w)
    local = spread.withColumns(local).filter(_HOME).drop("__ord_own", _HOME)

    running = [f for f in frames if f.rows is None]
    if running:
        totals = placed.withColumn(_BLOCK, block).groupBy(*keys, _BLOCK).agg(
            *[_block_total(f).alias(f"__ord_{f.name}") for f in running]
        )
        before = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        carried = totals.select(*keys, _BLOCK, *[_carry(f, before).alias(f"__ord_{f.name}") for f in running])
        local = join_same(local, carried, [*keys, _BLOCK], "inner")
        local = local.withColumns({f.name: _combine(f) for f in running}).drop(*[f"__ord_{f.name}" for f in running])
    return local.select(*df.columns, *[f.name for f in frames])


def _block_total(frame: Frame) -> Column:
    if frame.how == "sum":
        return F.sum(frame.value)
    if frame.how == "max":
        return F.max(frame.value)
    return F.max_by(frame.value, F.when(frame.value.isNotNull(), F.col(_POS)))


def _carry(frame: Frame, before) -> Column:
    part = F.col(f"__ord_{frame.name}")
    if frame.how == "sum":
        return F.coalesce(F.sum(part).over(before), F.lit(0))
    if frame.how == "max":
        return F.max(part).over(before)
    return F.last(part, ignorenulls=True).over(before)


def _combine(frame: Frame) -> Column:
    here, earlier = F.col(frame.name), F.col(f"__ord_{frame.name}")
    if frame.how == "sum":
        return here + earlier
    if frame.how == "max":
        return F.greatest(here, earlier)
    return F.coalesce(here, earlier)


def join_same(left, right, keys, how):
    """Equi join that also pairs null keys."""
    names = {k: f"__r_{k}" for k in keys}
    right = right.withColumnsRenamed(names)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return left.join(right, same, how).drop(*names.values())


# ------------------------------------------------------------------ ranks


def rank_rows(df: DataFrame, keys, order, name: str, hot: HotKeys | None = None) -> DataFrame:
    """1-based position of each row inside its key."""
    return over_order(df, keys, order, [running_count(name, current=True)], hot)


def keep_first(df: DataFrame, keys, order) -> DataFrame:
    """First row of each key. Spark drops all but one row per key and task before the shuffle."""
    return keep_top(df, keys, order, 1)


def keep_top(df: DataFrame, keys, order, n: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return df.withColumn("__ord_rank", F.row_number().over(w)).filter(F.col("__ord_rank") <= n).drop("__ord_rank")
