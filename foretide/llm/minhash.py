"""Near-duplicate documents by DartMinHash signatures, banded joining and exact verification.

Darts are thrown by hashing at every element's (weight x rank) plane: dyadic regions are cut into cells of area one,
each holds a Poisson number of darts, and the darts below an element's weight are its document's. The lowest-ranked
dart of each coordinate is the signature; two documents agree on a coordinate with the probability of their weighted
Jaccard similarity. Work is proportional to elements + darts, however long the signature.

Equal texts count as one. Documents that share a band are candidates; a band's group is not expanded into pairs:

1. every document is verified against one leader (the least document of its groups), which joins most copies;
2. the rows of groups that still hold several classes are compared by their signatures, in blocks of bounded size; a
   pair of different classes that agrees enough is verified there and then, each pair in the first band it shares.
   Tasks return the links that joined classes, never all pairs.

Verification is the exact Jaccard similarity of the sets of five-word shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretide.llm.common import in_steps, keyed_texts
from foretide.llm.components import components
from foretide.session import stable

WORDS = 5
SIMILARITY = 0.8
# 24 bands of 4: a pair at 0.8 is missed with probability 3e-6.
BANDS, ROWS = 24, 4
# A pair whose signatures agree in a smaller share is refuted; at 0.8 that is 4.5 standard deviations.
AGREEMENT = SIMILARITY - 4.5 * (SIMILARITY * (1 - SIMILARITY) / (BANDS * ROWS)) ** 0.5
BLOCK = 1024  # rows of a large group that one task compares with as many others
TASK_BYTES = 4 << 20  # shingles and ROW_BYTES a row of the small groups of one task
ROW_BYTES = 1000
KNOWN = 300_000
_CELLS = 400_000  # cells per numpy step
_POISSON = np.cumsum([0.36787944117144233 / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320, 362880)])


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _expand(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, number within owner) of counts[i] items for each i."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def darts(element: np.ndarray, weight: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the element, dart, rank) of all darts below each element's weight and rank `reach`."""
    found = []
    for nu in range(int(np.log2(1 + weight.max())) + 1 if len(weight) else 0):
        for rho in range(int(np.log2(1 + reach.max())) + 1):
            low_w, low_r, width, height = 2.0**nu - 1, 2.0**rho - 1, 2.0 ** (nu - rho), 2.0 ** (rho - nu)
            inside = np.flatnonzero((weight > low_w) & (reach > low_r))
            across = np.minimum(2**rho, np.ceil((weight[inside] - low_w) / width)).astype(np.int64)
            along = np.minimum(2**nu, np.ceil((reach[inside] - low_r) / height)).astype(np.int64)
            owner, k = _expand(across * along)
            a, b = np.divmod(k, along[owner])
            owner = inside[owner]
            place = (a.astype(np.uint64) << np.uint64(32)) + (b.astype(np.uint64) << np.uint64(12))
            cell = mix(element[owner] ^ mix(place + np.uint64(nu << 6 | rho)))
            thrown = np.searchsorted(_POISSON, _uniform(mix(cell + np.uint64(1))), side="right")
            at, j = _expand(thrown)
            dart = mix(cell[at] + (j + 2).astype(np.uint64))
            owner = owner[at]
            w = low_w + (a[at] + _uniform(mix(dart ^ np.uint64(0x5851F42D4C957F2D)))) * width
            rank = low_r + (b[at] + _uniform(mix(dart ^ np.uint64(0x14057B7EF767814F)))) * height
            hit = (w < weight[owner]) & (rank < reach[owner])
            found.append((owner[hit], dart[hit], rank[hit]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))  # type: ignore[return-value]


def signatures(elements: list[np.ndarray], weights: list[np.ndarray], size: int) -> np.ndarray:
    """One row of `size` darts for each weighted set; sets must not be empty."""
    out = np.zeros((len(elements), size), np.uint64)
    total = np.array([w.sum() for w in weights])
    wanted = size * (np.log(size) + 3)  # darts expected; then few sets leave a coordinate empty
    todo = np.arange(len(elements))
    while len(todo):
        missing = []
        cost = np.cumsum([len(elements[i]) + 2 * wanted for i in todo])
        for part in np.split(todo, np.searchsorted(cost, np.arange(_CELLS, cost[-1], _CELLS))):
            if not len(part):
                continue
            counts = np.array([len(elements[i]) for i in part])
            row = np.repeat(np.arange(len(part)), counts)
            owner, dart, rank = darts(
                np.concatenate([elements[i] for i in part]),
                np.concatenate([weights[i] for i in part]).astype(np.float64),
                (wanted / total[part])[row],
            )
            slot = row[owner] * size + (dart % np.uint64(size)).astype(np.int64)
            lowest = np.full(len(part) * size, np.inf)
            np.minimum.at(lowest, slot, rank)
            best = rank == lowest[slot]
            held = np.zeros(len(part) * size, np.uint64)
            held[slot[best]] = dart[best]
            out[part] = held.reshape(-1, size)
            missing.append(part[np.isinf(lowest).reshape(-1, size).any(1)])
        todo, wanted = np.concatenate(missing), wanted * 2
    return out


class Shingles:
    """Sets of hashed word runs; the hash of each word seen is kept in a bounded table."""

    def __init__(self, words: int):
        self.words = words
        self.known: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        """Sorted distinct shingles; a text of fewer words is one shingle, a text without words has none."""
        words = text.lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > KNOWN:
            kept = dict(islice(known.items(), KNOWN // 2))
            known.clear()
            known.update(kept)
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = min(self.words, len(words))
        run = np.zeros(len(words) - n + 1, np.uint64)
        for i in range(n):
            run = mix(run + h[i : len(words) - n + 1 + i])
        run.sort()
        return run[np.r_[True, run[1:] != run[:-1]]]


def sign(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, content, bands, sketch) of every document with words: band keys, and a byte of each coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for step in in_steps(batches):
            sets = [shingles(t) for t in step.column("text").to_pylist()]
            some = np.array([len(s) > 0 for s in sets], bool)
            sets = [s for s in sets if len(s)]
            table = signatures(sets, [np.ones(len(s)) for s in sets], BANDS * ROWS)
            key = np.zeros((len(sets), BANDS), np.uint64)
            for r in range(ROWS):
                key = mix(key + table.reshape(-1, BANDS, ROWS)[:, :, r])
            key = mix(key + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
            ends = pa.array(np.arange(0, key.size + 1, BANDS), pa.int32())
            sketch = [r.tobytes() for r in (table >> np.uint64(20)).astype(np.uint8)]
            kept = step.filter(pa.array(some))
            yield pa.RecordBatch.from_arrays(
                [kept.column("doc_id"), kept.column("content"), pa.ListArray.from_arrays(ends, pa.array(key.ravel())),
                 pa.array(sketch, pa.binary())], ["doc_id", "content", "bands", "sketch"],
            )

    texts = keyed_texts(docs).where("doc_id is not null").withColumn("content", F.unhex(F.md5("text")))
    return texts.mapInArrow(run, "doc_id long, content binary, bands array<long>, sketch binary")


def _sets(docs: DataFrame, chosen: DataFrame, words: int) -> DataFrame:
    """(node, shingles) of the chosen documents, 32 bits of each shingle's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for step in in_steps(batches):
            held = [np.unique(shingles(t).astype(np.uint32)).tobytes() for t in step.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([step.column("doc_id"), pa.array(held, pa.binary())], ["node", "shingles"])

    texts = keyed_texts(docs).join(chosen.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    return texts.mapInArrow(run, "node long, shingles binary")


def _agreeing(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches agree enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8) for c in ("x", "y"))
            same = (x == y).reshape(batch.num_rows, -1).mean(1) if batch.num_rows else np.zeros(0)
            yield batch.select(["a", "b"]).filter(pa.array(same >= AGREEMENT))

    x = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("x"))
    y = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _linked(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of at least the given exact similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                both = np.concatenate([np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)])
                total = len(both)
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(common >= similarity * (total - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


class Labels:
    """Classes joined within one task."""

    def __init__(self, owner: np.ndarray):
        names, self.of = np.unique(owner, return_inverse=True)
        self.parent = list(range(len(names)))

    def root(self, label: int) -> int:
        while self.parent[label] != label:
            self.parent[label] = self.parent[self.parent[label]]
            label = self.parent[label]
        return label

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def _compare(similarity: float):
    """Links between classes among the rows of one task: whole groups, or one pair of blocks of a large group."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("bucket")
        bucket, node, owner, block = (table.column(c).to_numpy() for c in ("bucket", "node", "class", "block"))
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(node), -1)
        bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        held = [np.frombuffer(x, np.uint32) for x in table.column("shingles").to_pylist()]
        size = np.array([len(x) for x in held])
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        labels, links = Labels(owner), []
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], len(bucket)], strict=True):
            at = np.arange(a, b)
            left, right = at[block[a:b] == i], at[block[a:b] == j]
            band = int(np.flatnonzero(bands[a] == bucket[a])[0])
            for row in left:
                others = right[node[right] > node[row]] if i == j else right
                # A pair that shares an earlier band is compared there.
                others = others[~(bands[others, :band] == bands[row, :band]).any(1)]
                same = (sketch[others] == sketch[row]).mean(1)
                order = np.argsort(-same, kind="stable")
                others = others[order][same[order] >= AGREEMENT]
                while len(others):
                    mine = labels.root(labels.of[row])
                    others = others[[labels.root(labels.of[o]) != mine for o in others]]
                    some, others = others[:32], others[32:]
                    if not len(some):
                        break
                    near = np.concatenate([held[o] for o in some])
                    hit = held[row][np.minimum(np.searchsorted(held[row], near), size[row] - 1)] == near
                    common = np.add.reduceat(hit, np.cumsum(size[some]) - size[some], dtype=np.int64)
                    for o in some[common >= similarity * (size[row] + size[some] - common)]:
                        if labels.join(labels.of[row], labels.of[o]):
                            links.append((min(node[row], node[o]), max(node[row], node[o])))
        pairs = np.array(links, np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def _links_across(members: DataFrame, classes: DataFrame, sketches: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that join the classes that meet in a group, verified where the rows are compared.

    Small groups share a task; a large one is cut into blocks, and block i meets block j >= i in a task of its own, so
    each row goes to as many tasks as its group has blocks.
    """
    owned = members.join(classes, "node", "left").withColumn("class", F.coalesce("component", "node"))
    spread = owned.groupBy("bucket").agg(F.min("class").alias("p"), F.max("class").alias("q"), F.count("*").alias("n"))
    spread = spread.where("p < q").select("bucket", F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("blocks"))
    rows = stable(owned.select("bucket", "node", "class").join(spread, "bucket"))
    weighed = rows.join(sets.select("node", (F.octet_length("shingles") + ROW_BYTES).alias("w")), "node")
    weighed = weighed.agg(F.sum("w")).first()[0] or 0
    parts = weighed // TASK_BYTES + 1
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    alone = F.col("blocks") > 1
    rows = rows.withColumn("part", F.when(alone, F.col("bucket")).otherwise(F.pmod(F.xxhash64("bucket"), F.lit(parts))))
    rows = rows.withColumn("alone", alone).join(sketches, "node").join(sets, "node").drop("blocks", "other")
    return rows.groupBy("part", "alone", "i", "j").applyInArrow(_compare(similarity), "a long, b long")


def classes(docs: DataFrame, similarity: float = SIMILARITY, words: int = WORDS) -> DataFrame:
    """(doc_id, class_id, kept) per row: class_id is the least doc_id of the document's near-duplicate class.

    Classes are the components of the links between documents of at least `similarity`; equal texts are one.
    A text without words is a class of its own, a null doc_id has a null class and is kept; rows that share a doc_id
    are one document.
    """
    signed = stable(sign(docs, words))
    content = signed.groupBy("content").agg(F.min("doc_id").alias("node"))
    copies = signed.select("doc_id", "content").join(content, "content").select("doc_id", "node").where("doc_id > node")
    # A content's least document stands for it.
    texts = signed.join(content.withColumnRenamed("node", "doc_id"), ["content", "doc_id"], "left_semi")
    texts = texts.dropDuplicates(["doc_id", "content"]).withColumnRenamed("doc_id", "node")
    sketches = stable(texts.select("node", "sketch", "bands"))
    banded = sketches.select("node", F.explode("bands").alias("bucket"))
    groups = banded.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("leader")).where("n > 1")
    members = stable(banded.join(groups.drop("n"), "bucket"))
    sets = stable(_sets(docs, members.select("node").distinct(), words))
    first = members.where("node > leader").groupBy("node").agg(F.min("leader").alias("b")).withColumnRenamed("node", "a")
    links = stable(_linked(_agreeing(first, sketches), sets, similarity))
    members = members.select("bucket", "node").distinct()
    links = links.union(_links_across(members, components(links), sketches, sets, similarity))
    edges = links.select("a", "b").union(copies.toDF("a", "b"))
    found = components(edges).select(F.col("node").alias("doc_id"), F.col("component").alias("class_id"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(found, "doc_id", "left")
    rows = rows.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
    return rows.withColumn("kept", F.coalesce(F.col("class_id") == F.col("doc_id"), F.lit(True)))
