"""Near-duplicate embeddings by a pivot-permutation index.

Reference points (pivots) are a bounded sample of the vectors, thinned until none is near another. Every vector is described by its nearest pivots in
order and stands in the inverted list of each. Vectors that share enough of their nearest pivots are candidates and
are verified by their cosine. A pair is treated in the list of its first shared pivot only; long lists are compared
in blocks, so no task holds a whole list, and tasks return counts and joining edges, never pairs. Equal vectors
count as one with a weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretide.llm.components import components
from foretide.llm.vectors import matrix, usable, width
from foretide.session import stable

COSINE = 0.93
# Pivots: twice the root of the number of vectors, within these bounds; those of smallest hash.
FEWEST, MOST = 64, 2048
# Pivots this close count as one: else those inside a large group are the nearest of all its members, whose order of them
# follows their own small deviations.
APART = 0.7
NEAREST = 12  # pivots that describe a vector
SHARED = 3  # of them two candidates have in common
BLOCK = 1024


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of length one. They are scaled by their greatest component first, so that neither tiny nor huge ones
    leave the range of doubles."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column("v")
        sizes = np.diff(column.offsets.to_numpy())
        flat = column.flatten().to_numpy(zero_copy_only=False)
        starts = np.cumsum(sizes) - sizes
        flat = flat / np.repeat(np.maximum.reduceat(np.abs(flat), starts), sizes)
        flat = flat / np.repeat(np.sqrt(np.add.reduceat(flat * flat, starts)), sizes)
        ends = pa.array(np.r_[0, np.cumsum(sizes)], pa.int32())
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.ListArray.from_arrays(ends, pa.array(flat))], batch.schema.names)


def _thinned(pivots: np.ndarray) -> np.ndarray:
    """The pivots that no earlier kept one is near to."""
    kept, free = [], np.ones(len(pivots), bool)
    for k in range(len(pivots)):
        if free[k]:
            kept.append(k)
            free &= pivots @ pivots[k] < APART
    # Where every vector would stand in every list, one list holds all pairs.
    return pivots[kept if len(kept) > NEAREST else kept[:1]]


def _described(nodes: DataFrame, pivots: np.ndarray, size: int) -> DataFrame:
    """nodes with `near`, the numbers of the nearest pivots, nearest first."""
    many = min(NEAREST, len(pivots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("v"), size)
            close = x @ pivots.T
            some = np.argpartition(-close, many - 1, axis=1)[:, :many]
            some = np.take_along_axis(some, np.argsort(-np.take_along_axis(close, some, 1), axis=1, kind="stable"), 1)
            ends = pa.array(np.arange(0, some.size + 1, many), pa.int32())
            near = pa.ListArray.from_arrays(ends, pa.array(some.ravel().astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, near], [*batch.schema.names, "near"])

    return nodes.mapInArrow(run, "node long, label long, weight long, v array<double>, near array<int>")


def _roots(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class label of each row and column of a matrix of links; rows and columns are numbered one after the other."""
    rows, columns = links.shape
    left, right = np.arange(rows), np.arange(rows, rows + columns)
    big = rows + columns
    while True:
        new_right = np.minimum(right, np.where(links, left[:, None], big).min(0, initial=big))
        new_left = np.minimum(left, np.where(links, new_right, big).min(1, initial=big))
        if (new_left == left).all() and (new_right == right).all():
            return left, right
        left, right = new_left, new_right


def _compare(cosine: float, size: int, shared: int):
    """The work of one pair of blocks of one inverted list."""

    def run(table: pa.Table) -> pa.Table:
        pivot, i, j = (table.column(c)[0].as_py() for c in ("pivot", "i", "j"))
        node, weight, block = (table.column(c).to_numpy() for c in ("node", "weight", "block"))
        x = matrix(table.column("v"), size)
        near = np.stack(table.column("near").to_pylist())
        names, place = np.unique(near, return_inverse=True)
        has = np.zeros((len(node), len(names)), np.float32)
        has[np.arange(len(node))[:, None], place.reshape(near.shape)] = 1
        a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
        before = names < pivot
        first = has[a][:, before] @ has[b][:, before].T == 0
        links = first & (has[a] @ has[b].T >= shared) & (x[a] @ x[b].T >= cosine)
        links &= (node[a][:, None] < node[b]) if i == j else True
        counts = np.zeros(len(node), np.int64)
        np.add.at(counts, a, links @ weight[b])
        np.add.at(counts, b, weight[a] @ links)
        left, right = _roots(links)
        both = np.r_[node[a], node[b]]
        root = np.r_[both[left], both[right]]
        edge = root != both
        kept = counts > 0
        nodes = np.r_[node[kept], both[edge]]
        return pa.table({
            "node": nodes,
            "links": np.r_[counts[kept], np.zeros(edge.sum(), np.int64)],
            "root": np.r_[node[kept], root[edge]],
        })

    return run


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, shared: int = SHARED) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row: other vectors of the same label at `cosine` or more, and the
    least vec_id reachable by links.

    Vectors that are null, empty or zero or hold null or non-finite components, and rows without label or vec_id,
    link with nothing; a shorter vector counts as filled up with zeros. A row given twice is two vectors. A null
    vec_id has a null component and is kept.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.transform("embedding", lambda x: x.cast("double")).alias("v"),
    )
    linking = usable("v") & F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.exists("v", lambda x: x != 0)
    fine = rows.where(linking).mapInArrow(_unit, "vec_id long, label long, v array<double>")
    rows = fine.unionByName(rows.where(~linking).withColumn("v", F.lit(None).cast("array<double>")))
    grouped = fine.groupBy("label", "v").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
    nodes = stable(grouped.withColumn("node", F.monotonically_increasing_id()))
    size, count = max(width(nodes, "v"), 1), nodes.count()
    many = int(min(MOST, max(FEWEST, 2 * count**0.5)))
    chosen = nodes.orderBy(F.xxhash64("v"), "node").limit(many).select("v").toArrow()
    pivots = _thinned(matrix(chosen.column("v"), size)) if chosen.num_rows else np.zeros((1, size))
    near = _described(nodes.select("node", "label", "weight", "v"), pivots, size)
    listed = stable(near).withColumn("pivot", F.explode("near"))
    sizes = listed.groupBy("label", "pivot").agg(F.expr(f"(count(*) + {BLOCK - 1}) div {BLOCK}").alias("blocks"), F.count("*").alias("n"))
    listed = listed.join(sizes.where("n > 1").drop("n"), ["label", "pivot"])
    listed = listed.withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    listed = listed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    listed = listed.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    found = listed.groupBy("label", "pivot", "i", "j").applyInArrow(
        _compare(cosine, size, min(shared, len(pivots))), "node long, links long, root long"
    )
    found = stable(found)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    placed = nodes.join(links, "node", "left").join(joined, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    placed = placed.join(least, "component").select(
        "label", "v", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"
    )
    # Rows without a usable vector match nothing.
    told = rows.join(placed, ["label", "v"], "left")
    told = told.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return told.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
