"""Packing documents into fixed windows by best-fit decreasing.

Documents longer than a window are first cut into full windows. Pieces are then placed longest first, each into the
tightest open window, found in a segment tree indexed by remaining capacity. All pieces of one length are alike, so
the plan needs only the number of pieces of each length (at most `window` numbers): it places runs of equal pieces
into runs of equal windows and is small whatever the corpus holds. Pieces find their place by length and rank.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict, deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foretide.llm import bpe
from foretide.llm.common import in_steps, keyed_texts
from foretide.session import stable

# Pieces of one shard, within which ranks are counted.
SHARD_PIECES = 100_000
_LONG_BLANK = re.compile(r"\s{500}")
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class Capacities:
    """Segment tree over remaining capacities: which have an open window, and the least at or above a size."""

    def __init__(self, most: int):
        self.width = 1 << most.bit_length()
        self.held = [0] * (2 * self.width)

    def add(self, capacity: int, windows: int) -> None:
        at = capacity + self.width
        while at:
            self.held[at] += windows
            at >>= 1

    def tightest(self, size: int) -> int | None:
        at = size + self.width
        if self.held[at]:
            return size
        while at > 1:  # climb to the first right sibling that holds something, then descend leftmost
            if at % 2 == 0 and self.held[at + 1]:
                at += 1
                while at < self.width:
                    at = 2 * at if self.held[2 * at] else 2 * at + 1
                return at - self.width
            at >>= 1
        return None


def plan(counts: dict[int, int], window: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, first sequence, pieces per sequence, offset) of each run of equal pieces.

    The piece of that length with rank first + k goes to sequence + k // per, at offset + (k % per) * length.
    """
    open_: dict[int, deque] = defaultdict(deque)  # remaining capacity -> runs [first sequence, windows]
    tree, made, rows = Capacities(window), 0, []

    def put(capacity: int, first: int, windows: int) -> None:
        if capacity and windows:
            runs = open_[capacity]
            if runs and sum(runs[-1]) == first:
                runs[-1][1] += windows
            else:
                runs.append([first, windows])
            tree.add(capacity, windows)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity, per = window, window // length
                first, windows = made, -(-left // per)
                made += windows
            else:
                per = capacity // length
                run = open_[capacity][0]
                first, windows = run[0], min(run[1], -(-left // per))
                run[0], run[1] = run[0] + windows, run[1] - windows
                if not run[1]:
                    open_[capacity].popleft()
                tree.add(capacity, -windows)
            placed = min(left, windows * per)
            rows.append((length, rank, first, per, window - capacity))
            full, rest = divmod(placed, per)
            put(capacity - per * length, first, full)
            if rest:
                put(capacity - rest * length, first + full, 1)
            rank, left = rank + placed, left - placed
    return rows


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> tiktoken.Encoding:
    coder = bpe.encoder(path)
    ranks = {t: i for i, t in enumerate(coder.token) if i not in coder.special.values()}
    return tiktoken.Encoding("file", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens=coder.special)


def pieces(docs: DataFrame, path: str, window: int, end: int = 0) -> DataFrame:
    """Each document's ids and the closing id, cut into full windows and a rest."""

    def ids_of(text: str) -> np.ndarray:
        if _LONG_BLANK.search(text):  # long runs of blanks overrun the library's pattern matcher
            return np.frombuffer(bpe.encoder(path).encode([text])[0], "<u4")
        return np.array(_tokenizer(path).encode(text, allowed_special="all"), "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in in_steps(batches):
            rows = []
            for key, text in zip(step.column("doc_id").to_pylist(), step.column("text").to_pylist(), strict=True):
                ids = np.append(ids_of(text), np.array([end], "<u4"))
                data, tokens = ids.tobytes(), len(ids)
                for at in range(0, tokens, window):
                    part = data[4 * at : 4 * (at + window)]
                    rows.append((key, at, len(part) // 4, zlib.crc32(part), tokens))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return keyed_texts(docs).mapInArrow(run, _PIECES)


def pack(docs: DataFrame, path: str, window: int = 1024) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are one piece, the closing id. Rows with equal or null doc_id are packed one by one.
    An empty table gives no rows.
    """
    cut = stable(pieces(docs, path, window))
    shards = cut.count() // SHARD_PIECES + 1
    cut = cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "start"), F.lit(shards)))
    counts = cut.groupBy("length", "shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `window`
    rows = sorted(plan(totals, window))
    within = Window.partitionBy("length", "shard").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = cut.withColumn("at", F.row_number().over(within) - 1).join(base, ["length", "shard"])
    ranked = ranked.withColumn("rank", F.col("base") + F.col("at"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first_rank, sequence, per, offset = np.array(rows, np.int64).reshape(-1, 5).T
        starts = length << 44 | first_rank
        for batch in batches:
            size, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = np.searchsorted(starts, size << 44 | rank, side="right") - 1
            k = rank - first_rank[row]
            found = [sequence[row] + k // per[row], offset[row] + k % per[row] * size]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], *map(pa.array, found)], [*batch.schema.names[:5], "sequence_id", "offset"]
            )

    names = [f.split()[0] for f in _PIECES.split(", ")]
    return ranked.select(*names, "rank").mapInArrow(place, _PIECES + ", sequence_id long, offset long")
