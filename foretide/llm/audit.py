"""Interaction audit of five document filters, as a retracting stream.

The files of a table come as micro-batches until none is left (available now). What each document fails by itself is a
bit mask; that it repeats the text of a smaller doc_id is known only once all files were seen, so
keyed state holds each text's least id so far and the documents that carry it. When a smaller id arrives, those
documents are retracted from the part counters under their old mask and counted again as repeats. The counters are the
sum of all changes; kept, removed and the other numbers of all 120 filter orders follow from them.

Spark calls Python once per state key, which takes milliseconds however little the key holds; so a state key is a range
of text digests, dealt so finely that it holds about TEXTS texts at any table size, as a small Arrow table.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from foretide.llm.common import in_steps
from foretide.session import run_folder

FILTERS = "ABCDE"
# The words' separators, and the filters' bounds.
WHITE = b" \t\n\x0b\x0c\r"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SIGNS = 50, 65, 5, b"#$%&*|"
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
# Bytes that begin a character in UTF-8.
_LEADING = bytes([*range(0x80), *range(0xC0, 0x100)])
REPEAT = 1 << FILTERS.index("E")
# A run has at most so many micro-batches, and at least a file for each core in each of them.
ROUNDS = 16
# Texts that a task gathers before it passes their counts on.
GATHERED = 100_000

# Texts of one state key, on average.
TEXTS = 500

_DOCUMENT = "doc_id long, text string, source string"
_CHANGE = "key binary, mask int, low long, part string, good boolean, toxic boolean, at_low long, above long, apart long"
_COUNTER = "part string, mask int, good boolean, toxic boolean, n long"
_HELD = pa.schema([("key", pa.binary()), ("low", pa.int64()), ("part", pa.string()), ("good", pa.bool_()), ("toxic", pa.bool_()), ("n", pa.int64())])


def own_mask(data: bytes) -> int:
    """Bits of the filters that a text in UTF-8 fails by itself (A to D)."""
    words = data.split()  # at the bytes of WHITE
    characters = len(data) - len(data.translate(None, _LEADING))
    fails = (
        len(words) < LEAST_WORDS,
        100 * len(set(words)) < LEAST_DISTINCT * len(words),
        100 * (len(data) - len(data.translate(None, _CAPITALS))) > MOST_CAPITALS * characters,
        len(data.translate(None, SIGNS)) < len(data),
    )
    return sum(f << k for k, f in enumerate(fails))


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest and mask instead of each text."""
    for step in in_steps(batches):
        texts = [(t or "").encode() for t in step.column("text").to_pylist()]
        keys = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
        masks = pa.array([own_mask(t) for t in texts], pa.int32())
        yield pa.RecordBatch.from_arrays([step.column("doc_id"), step.column("part"), keys, masks], ["doc_id", "part", "key", "mask"])


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's documents per text and kind, at the text's least id and above it: few rows for a hot text."""
    lows: dict[bytes, tuple[int, int | None]] = {}
    counts: Counter = Counter()

    def rows() -> pa.RecordBatch:
        grouped: dict[tuple, list[int]] = {}
        for (key, doc_id, *kind), n in counts.items():
            low = lows[key][1]
            at = grouped.setdefault((key, *kind), [0, 0, 0])
            at[2 if doc_id is None else 0 if doc_id == low else 1] += n
        out = [(key, lows[key][0], lows[key][1], *kind, *at) for (key, *kind), at in grouped.items()]
        kinds = [pa.binary(), pa.int32(), pa.int64(), pa.string(), pa.bool_(), pa.bool_(), *[pa.int64()] * 3]
        columns = zip(*out, strict=True) if out else [[]] * len(kinds)
        names = [f.split()[0] for f in _CHANGE.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        held = (batch.column(c).to_pylist() for c in ("key", "mask", "doc_id", "part", "good", "toxic"))
        for key, mask, doc_id, part, good, toxic in zip(*held, strict=True):
            low = lows[key][1] if key in lows else None
            lows[key] = (mask, doc_id if low is None or doc_id is not None and doc_id < low else low)
            counts[key, doc_id if doc_id is None or doc_id <= lows[key][1] else lows[key][1] + 1, part, good, toxic] += 1
        if len(lows) >= GATHERED or len(counts) >= 4 * GATHERED:
            yield rows()
            lows.clear()
            counts.clear()
    yield rows()


def _retract(_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Changes of the counters by new documents of the texts of one state key.

    The state keeps each text's least id and how many documents of which kind carry it.
    """
    held: dict[bytes, tuple[int, Counter]] = {}
    if state.exists:
        with pa.ipc.open_stream(bytes(state.get[0])) as reader:
            for key, low, part, good, toxic, n in zip(*(c.to_pylist() for c in reader.read_all().columns), strict=True):
                held.setdefault(key, (low, Counter()))[1][part, good, toxic] = n
    changes: Counter = Counter()
    for batch in batches:
        columns = (batch[f.split()[0]].tolist() for f in _CHANGE.split(", "))
        for key, mask, new, part, good, toxic, at_low, above, apart in zip(*columns, strict=True):
            kind = (part, bool(good), bool(toxic))
            if apart:
                changes[*kind, mask] += apart
            if above:
                changes[*kind, mask | REPEAT] += above
            if not at_low:
                continue
            key, new = bytes(key), int(new)
            if key not in held or new < held[key][0]:
                if key in held:  # what was least so far turns into repeats
                    for other, n in held[key][1].items():
                        changes[*other, mask] -= n
                        changes[*other, mask | REPEAT] += n
                held[key] = (new, Counter())
            if new == held[key][0]:
                held[key][1][kind] += at_low
                changes[*kind, mask] += at_low
            else:
                changes[*kind, mask | REPEAT] += at_low
    if held:
        rows = [(key, low, *kind, n) for key, (low, kinds) in held.items() for kind, n in kinds.items()]
        table = pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _HELD, strict=True)], schema=_HELD)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _HELD) as writer:
            writer.write_table(table)
        state.update((sink.getvalue().to_pybytes(),))
    rows = [(part, m, good, toxic, n) for (part, good, toxic, m), n in changes.items() if n]
    yield pd.DataFrame(rows, columns=["part", "mask", "good", "toxic", "n"])


def flags(labels: DataFrame) -> DataFrame:
    """(doc_id, good, toxic): a document counts as labelled so if any of its rows says it."""
    one = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False))
    return labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(
        one("quality").alias("good"), one("toxic").alias("toxic")
    )


def changes(stream: DataFrame, flagged: DataFrame, ranges: int) -> DataFrame:
    """The stream of counter changes (part, mask, good, toxic, n) of a stream of documents (doc_id, text, source).

    State is kept for `ranges` ranges of text digests.
    """
    named = stream.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"), "text")
    facts = named.mapInArrow(_judge, "doc_id long, part string, key binary, mask int")
    known = facts.join(flagged, facts.doc_id == flagged.labelled, "left").select(
        "key", "mask", "doc_id", "part", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")
    )
    start = F.conv(F.hex(F.substring("key", 1, 7)), 16, 10).cast("long")
    gathered = known.mapInArrow(_gather, _CHANGE).withColumn("range", start % ranges)
    return gathered.groupBy("range").applyInPandasWithState(
        _retract, _COUNTER, "held binary", "append", GroupStateTimeout.NoTimeout
    )


def counters(spark: SparkSession, path: str, labels: DataFrame, files: int | None = None) -> DataFrame:
    """(part, mask, good, toxic, n) over all documents of the Parquet table at `path`, by a stream over its files.

    The stream takes `files` files in each micro-batch; without a number, at least one for each core and so many that
    there are at most ROUNDS micro-batches. State, changes and the labels' flags lie in the shared checkpoint folder; each
    micro-batch writes its changes to a folder of its own, so that one that runs twice replaces them. Null sources are the
    part ''; a null doc_id is smaller than none and none is smaller than it; documents that share doc_id and text are no
    repeats of each other; null text counts as empty. An empty table gives no row.

    State goes to the session's state store. Spark's default holds it in the executors' memory, about 90 bytes a text;
    `spark.sql.streaming.stateStore.providerClass` names one that keeps it in files.
    """
    folder = f"{run_folder(spark)}/audit-{uuid.uuid4().hex}"
    found = spark.read.parquet(path)
    schema = found.select(*[c.split()[0] for c in _DOCUMENT.split(", ")]).schema
    if files is None:
        files = max(spark.sparkContext.defaultParallelism, math.ceil(len(found.inputFiles()) / ROUNDS))
    ranges = max(1, math.ceil(found.count() / TEXTS))
    flags(labels).write.parquet(f"{folder}/flags")
    spark.createDataFrame([], _COUNTER).write.parquet(f"{folder}/changes/batch=-1")

    def keep(batch: DataFrame, number: int) -> None:
        summed = batch.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n <> 0")
        summed.write.mode("overwrite").parquet(f"{folder}/changes/batch={number}")

    # As a pattern, the path may be one file as well as a folder.
    pattern = f"{path[:-1]}[{path[-1]}]"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(pattern)
    changed = changes(stream, spark.read.parquet(f"{folder}/flags"), ranges)
    writer = changed.writeStream.outputMode("append").foreachBatch(keep).trigger(availableNow=True)
    query = writer.option("checkpointLocation", f"{folder}/state").start()
    query.awaitTermination()
    every = spark.read.schema(_COUNTER).parquet(f"{folder}/changes")
    return every.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n <> 0")


def interactions(counted: DataFrame) -> DataFrame:
    """Per part, filter order and step the numbers of the contract, from counters.

    A step's numbers depend on its filter and on the set of filters before it alone: 80 sums per part serve all 600 steps.
    """
    spark = counted.sparkSession
    bits = {f: 1 << k for k, f in enumerate(FILTERS)}
    steps = []
    for order in permutations(FILTERS):
        for k, f in enumerate(order):
            steps.append(("".join(order), k + 1, bits[f], sum(bits[g] for g in order[:k])))
    table = spark.createDataFrame(steps, "filter_order string, step int, bit int, before int")
    # Orders in which exactly the filters `before` come before a filter: what a sum counts for in the Shapley value.
    every = [(b, p, math.factorial(p.bit_count()) * math.factorial(len(FILTERS) - 1 - p.bit_count())) for b in bits.values() for p in range(32) if not p & b]
    pairs = F.explode(F.array(*[F.struct(*[F.lit(x).alias(c) for x, c in zip(e, ("bit", "before", "orders"), strict=True)]) for e in every]))
    wide = counted.select("*", pairs.alias("pair")).select("part", "mask", "good", "toxic", "n", "pair.*")
    fails, earlier = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    total = lambda when: F.sum(F.when(when, F.col("n")).otherwise(F.lit(0).cast("long")))
    sums = wide.groupBy("part", "bit", "before", "orders").agg(
        total(~fails & ~earlier).alias("kept"),
        total(fails & ~earlier).alias("removed"),
        total(fails & earlier).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(fails & ~earlier & F.col("good")).alias("good_lost"),
        total(fails & ~earlier & F.col("toxic")).alias("toxic_lost"),
    )
    shapley = sums.groupBy(F.col("part").alias("part_"), F.col("bit").alias("bit_")).agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    sums = sums.join(shapley, (sums.part == shapley.part_) & (sums.bit == shapley.bit_)).drop("part_", "bit_")
    return sums.join(F.broadcast(table), ["bit", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )
