"""Exact top-k inner products over norm-sorted vectors.

Vectors are ordered by descending length and cut into blocks. All queries first meet the block of the longest
vectors; their k-th best score there bounds what later blocks must reach. A block whose greatest length times the
query's length stays below that bound is skipped. Within a block, vectors are rotated to the principal axes (SVD of
the whole table's second moments), the first axes are multiplied out, and Cauchy-Schwarz bounds the rest by the
lengths of the residuals: only vectors whose bound reaches the query's are scored exactly, in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foretide.llm.vectors import matrix, usable, width
from foretide.session import stable

BLOCK = 8192  # candidates of one task
QUERIES = 2048  # queries of one task
AXES = 16  # rotated axes multiplied out before the bound is tried
_HIT = "query_id long, vec_id long, score long"


def _axes(vectors: DataFrame, components: int) -> np.ndarray:
    """Orthogonal matrix of the principal axes, greatest first."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((components, components))
        for batch in batches:
            x = matrix(batch.column("v"), components)
            total += x.T @ x
        place = np.arange(total.size, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total.ravel())], ["place", "value"])

    summed = vectors.select("v").mapInArrow(moments, "place int, value double").groupBy("place").agg(F.sum("value"))
    total = np.zeros(components**2)
    for place, value in summed.collect():  # components squared
        total[place] = value
    return np.linalg.svd(total.reshape(components, components))[0]


def _scored(found: DataFrame, blocks: DataFrame, components: int, axes: np.ndarray, k: int) -> DataFrame:
    """Each query's best k within each block. found: part, block, vec_id, v, least; blocks: part, block, vec_id, v."""

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        none = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        if not left.num_rows or not right.num_rows:
            return none
        q, c = matrix(left.column("v"), components), matrix(right.column("v"), components)
        query, vec, least = (t.to_numpy() for t in (left.column("vec_id"), right.column("vec_id"), left.column("least")))
        order = np.argsort(vec, kind="stable")
        c, vec = c[order], vec[order]
        qr, cr = q @ axes, c @ axes
        far = np.linalg.norm(qr[:, AXES:], axis=1)[:, None] * np.linalg.norm(cr[:, AXES:], axis=1)
        bound = qr[:, :AXES] @ cr[:, :AXES].T + far
        slack = 1e-9 * (1 + np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(c, axis=1).max())
        hope = (bound + slack >= least[:, None]) & (query[:, None] != vec)
        exact = np.abs(q).max() * np.abs(c).max() * components < 2.0**52  # then float products are whole and exact
        out: list[tuple[np.ndarray, ...]] = []
        for i in np.flatnonzero(hope.any(1)):
            at = np.flatnonzero(hope[i])
            value = (c[at] @ q[i]).astype(np.int64) if exact else c[at].astype(np.int64) @ q[i].astype(np.int64)
            if len(at) > k:  # keep everything that may tie with the k-th, then the smallest ids
                keep = np.flatnonzero(value >= np.partition(value, -k)[-k])
                at, value = at[keep], value[keep]
            best = np.argsort(-value, kind="stable")[:k]
            out.append((np.full(len(best), query[i]), vec[at[best]], value[best]))
        if not out:
            return none
        return pa.table(dict(zip(["query_id", "vec_id", "score"], map(np.concatenate, zip(*out, strict=True)), strict=True)))

    keys = ["part", "block"]
    # New names on both sides, which come from one frame.
    left, right = (f.select(*[F.col(c).alias(c) for c in names]) for f, names in (
        (found, [*keys, "vec_id", "v", "least"]), (blocks, [*keys, "vec_id", "v"])))
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(score, _HIT)


def top_products(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vec_id divisible by `every`, the k best other rows.

    Scores are inner products of floor(scale * component); ties go to the smaller vec_id. Vectors that are null,
    empty or hold null or non-finite components, and rows without vec_id, take no part; a shorter vector counts as
    filled up with zeros. Rows with the query's own vec_id are no candidates for it; a repeated candidate row is
    ranked once for each time it is there.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("e"))
    rows = rows.where(usable("e") & F.col("vec_id").isNotNull())
    whole = F.transform("e", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    rows = rows.select("vec_id", whole.alias("v"))
    rows = rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))
    count = rows.count()
    components = max(width(rows, "v"), 1)
    parts, blocks = -(-count // (every * QUERIES)) or 1, -(-count // BLOCK) or 1
    # Partitions of the range sort are the blocks; vec_id splits runs of equal length.
    sorted_ = rows.repartitionByRange(blocks, F.desc("norm"), "vec_id").withColumn("block", F.spark_partition_id())
    sorted_ = stable(sorted_)
    axes = _axes(sorted_, components)
    spread = sorted_.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    queries = sorted_.where(F.col("vec_id") % every == 0).drop("block")
    queries = queries.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int"))
    lengths = sorted_.groupBy("block").agg(F.max("norm").alias("longest"))
    first = lengths.agg(F.min("block")).first()[0] or 0

    start = queries.withColumns({"block": F.lit(first), "least": F.lit(-float("inf"))})
    ahead = stable(_scored(start, spread.where(F.col("block") == first), components, axes, k))
    least = ahead.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k)
    least = least.select(F.col("query_id").alias("vec_id"), F.col("least").cast("double")).distinct()
    least = queries.join(least, "vec_id", "left").fillna({"least": -float("inf")})
    others = F.explode(F.sequence(F.lit(first + 1), F.lit(max(first + 1, blocks + first))))
    meet = least.withColumn("block", others).join(lengths, "block")
    meet = meet.where(F.col("norm") * F.col("longest") * (1 + 1e-9) >= F.col("least"))
    behind = _scored(meet, spread.where(F.col("block") > first), components, axes, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = ahead.union(behind).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
