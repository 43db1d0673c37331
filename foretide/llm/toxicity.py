"""Toxic spans and document scores by a linear-chain conditional random field.

Labels say only whether a document is toxic. Token labels come from words and word beginnings that, by a bounded
sample of labelled documents, stand almost only in toxic ones; they must occur after several different words, so that
copies of one document count once: fewer words where few documents are toxic. The field (states clean and toxic, weights per word and beginning, transitions) is
fitted on lines of that sample; forward-backward gives each token's marginal. A document's score is a logistic function
of its greatest marginal and of the sum of its marginals; offending offsets are its tokens above one half.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretide.llm.common import STEP_BYTES, in_steps, keyed_texts
from foretide.llm.quality import labelled
from foretide.session import stable

# Labelled documents and sequences that the field is fitted on at most: those of smallest hash.
SAMPLE = 20_000
SEQUENCES = 8_000
# Different preceding words, and share of toxic ones among the documents, that make a word or beginning a mark. Up to 24
# different toxic texts, a third as many preceding words do, but no fewer than the least, if two toxic documents hold it.
CONTEXTS = 8
LEAST_CONTEXTS = 3
PURITY = 0.8
# A sequence is a line, or this many words of a longer line.
LENGTH = 128
# Cells (padded words) that are tagged at once.
CELLS = 1 << 17
KNOWN = 100_000
_EDGES = ".,;:!?\"'()[]{}|#$%&*…«»„“”-"
_BEGINNINGS = (3, 4, 5, 6)


def features(word: str) -> list[str]:
    """The bare word and its beginnings; a beginning ends in a star."""
    bare = word.strip(_EDGES).lower()
    return [bare, *(bare[:n] + "*" for n in _BEGINNINGS if len(bare) > n)] if bare else []


def sequences(text: str) -> list[list[str]]:
    """Words of each line, long lines cut."""
    out = []
    for line in text.split("\n"):
        words = line.split()
        out += [words[i : i + LENGTH] for i in range(0, len(words), LENGTH)]
    return out


@dataclass
class Field:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -5.0
    start: float = 0.0  # of the toxic state, against clean
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))  # from, to
    # Document score: constant, greatest marginal, log(1 + sum of marginals).
    document: np.ndarray = field(default_factory=lambda: np.array([-5.0, 5.0, 0.0]))
    known: dict[str, float] = field(default_factory=dict)

    def emission(self, word: str) -> float:
        value = self.known.get(word)
        if value is None:
            value = self.known[word] = self.bias + sum(self.weights.get(f, 0.0) for f in features(word))
        return value

    def score(self, great: np.ndarray, mass: np.ndarray) -> np.ndarray:
        """Document scores from greatest marginals and sums of marginals."""
        total = np.c_[np.ones(len(great)), great, np.log1p(mass)] @ self.document
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))

    def trim(self) -> None:
        if len(self.known) > KNOWN:
            first = dict(islice(self.known.items(), KNOWN // 2))
            self.known.clear()
            self.known.update(first)


def _sweeps(emission: np.ndarray, sizes: np.ndarray, start: float, moves: np.ndarray):
    """Cells inside the padded sequences, scores, forward and backward log sums, log normaliser."""
    n, width = emission.shape
    inside = np.arange(width) < sizes[:, None]
    score = np.zeros((n, width, 2))
    score[..., 1] = emission
    ahead = np.zeros((n, width, 2))
    ahead[:, 0] = score[:, 0] + [0.0, start]
    for t in range(1, width):
        step = np.logaddexp(ahead[:, t - 1, :1] + moves[0], ahead[:, t - 1, 1:] + moves[1]) + score[:, t]
        ahead[:, t] = np.where(inside[:, t, None], step, ahead[:, t - 1])
    total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
    back = np.zeros((n, width, 2))
    for t in range(width - 2, -1, -1):
        after = back[:, t + 1] + score[:, t + 1]
        step = np.logaddexp(moves[:, 0] + after[:, :1], moves[:, 1] + after[:, 1:])
        back[:, t] = np.where(inside[:, t + 1, None], step, 0.0)
    return inside, score, ahead, back, total


def marginals(emission: np.ndarray, sizes: np.ndarray, start: float, moves: np.ndarray) -> np.ndarray:
    """Marginals of the toxic state of padded sequences."""
    inside, _, ahead, back, total = _sweeps(emission, sizes, start, moves)
    return np.where(inside, np.exp(ahead[..., 1] + back[..., 1] - total[:, None]), 0.0)


def forward_backward(emission: np.ndarray, sizes: np.ndarray, start: float, moves: np.ndarray):
    """Marginals of the toxic state and expected moves (by row) of padded sequences."""
    inside, score, ahead, back, total = _sweeps(emission, sizes, start, moves)
    marginal = np.where(inside, np.exp(ahead[..., 1] + back[..., 1] - total[:, None]), 0.0)
    if emission.shape[1] < 2:
        return marginal, np.zeros((len(emission), 2, 2))
    pair = ahead[:, :-1, :, None] + moves + (score[:, 1:] + back[:, 1:])[:, :, None, :] - total[:, None, None, None]
    return marginal, np.where(inside[:, 1:, None, None], np.exp(pair), 0.0).sum(1)


def fit_field(rows: list[tuple], names: list[str], rounds: int = 60) -> Field:
    """Gradient ascent on the penalised likelihood. rows: words, marked places, their features, their labels, weight."""
    if not rows:
        return Field()
    sizes = np.array([r[0] for r in rows])
    shape = (len(rows), int(sizes.max()))
    row = np.concatenate([np.full(len(r[1]), i) for i, r in enumerate(rows)]).astype(np.int64)
    place = np.fromiter(chain.from_iterable(r[1] for r in rows), np.int64)
    lists = list(chain.from_iterable(r[2] for r in rows))
    at = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    feature = np.fromiter(chain.from_iterable(lists), np.int64)
    truth = np.zeros(shape)
    truth[row, place] = np.fromiter(chain.from_iterable(r[3] for r in rows), np.int64)
    weight = np.array([r[4] for r in rows], np.float64)
    inside = (np.arange(shape[1]) < sizes[:, None]) * weight[:, None]
    seen = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            seen[a, b] = ((truth[:, :-1] == a) & (truth[:, 1:] == b)).ravel() @ inside[:, 1:].ravel()
    w, rest, moves = np.zeros(len(names)), np.array([-4.0, 0.0]), np.zeros((2, 2))
    first, second = [np.zeros(len(names) + 6) for _ in range(2)]
    for t in range(1, rounds + 1):
        emission = np.full(shape, rest[0])
        np.add.at(emission, (row, place), np.bincount(at, w[feature], len(lists)))
        marginal, moved = forward_backward(emission, sizes, rest[1], moves)
        moved = np.tensordot(weight, moved, 1)
        wrong = (truth - marginal) * inside
        gradient = np.r_[
            np.bincount(feature, wrong[row, place][at], len(names)) - 0.5 * w,
            wrong.sum() - 0.1 * rest[0], wrong[:, 0].sum() - 0.1 * rest[1], (seen - moved - 0.1 * moves).ravel(),
        ]
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        step = 0.3 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
        w, rest, moves = w + step[:-6], rest + step[-6:-4], moves + step[-4:].reshape(2, 2)
    return Field(dict(zip(names, w.tolist(), strict=True)), float(rest[0]), float(rest[1]), moves)


def fit(docs: DataFrame, labels: DataFrame, keep: Column, label: str = "toxic", rows: int = SAMPLE) -> Field:
    """A field learned from labelled documents whose doc_id `keep` admits; without any, one that finds nothing."""
    sample = stable(labelled(docs, labels, label, keep, rows))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in in_steps(batches):
            pairs = set()
            for text in step.column("text").to_pylist():
                before = ""
                for word in text.split():
                    pairs.update((f, before) for f in features(word))
                    before = word
            yield pa.RecordBatch.from_arrays(
                [pa.array([f for f, _ in pairs], pa.string()), pa.array([b for _, b in pairs], pa.string())],
                ["feature", "before"],
            )

    bad = sample.where("y = 1").select("text")
    enough = min(CONTEXTS, max(LEAST_CONTEXTS, -(-bad.select(F.xxhash64("text")).distinct().count() // 3)))
    spread = bad.mapInArrow(contexts, "feature string, before string")
    spread = spread.groupBy("feature").agg(F.countDistinct("before").alias("n")).where(F.col("n") >= enough)
    candidates = {r.feature: r.n for r in spread.collect()}  # of a bounded sample

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for step in in_steps(batches):
            for y, text in zip(step.column("y").to_pylist(), step.column("text").to_pylist(), strict=True):
                here = set(chain.from_iterable(map(features, set(text.split())))) & candidates.keys()
                found.update((f, y) for f in here)
        yield pa.RecordBatch.from_arrays(
            [pa.array([f for f, _ in found], pa.string()), pa.array([y for _, y in found], pa.int32()),
             pa.array(list(found.values()), pa.int64())], ["feature", "y", "n"],
        )

    counted = sample.select("y", "text").mapInArrow(counts, "feature string, y int, n long")
    toxic, clean = (F.coalesce(F.sum(F.when(F.col("y") == v, F.col("n"))), F.lit(0)).alias(a) for v, a in ((1, "t"), (0, "c")))
    counted = counted.groupBy("feature").agg(toxic, clean)
    pure = counted.where(F.col("t") >= PURITY * (F.col("t") + F.col("c"))).collect()
    names = sorted(r.feature for r in pure if candidates[r.feature] >= CONTEXTS or r.t > 1)
    number = {f: i for i, f in enumerate(names)}

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in in_steps(batches):
            out: list[list] = [[], [], [], []]
            for y, text in zip(step.column("y").to_pylist(), step.column("text").to_pylist(), strict=True):
                for words in sequences(text):
                    marks = [[number[f] for f in features(w) if f in number] for w in words]
                    at = [i for i, m in enumerate(marks) if m]
                    for column, value in zip(out, (len(words), at, [marks[i] for i in at], [y] * len(at)), strict=True):
                        column.append(value)
            kinds = [pa.int32(), pa.list_(pa.int32()), pa.list_(pa.list_(pa.int32())), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["words", "at", "marks", "y"]
            )

    schema = "words int, at array<int>, marks array<array<int>>, y array<int>"
    every = sample.select("y", "text").mapInArrow(lines, schema).withColumn("hash", F.xxhash64("words", "at", "marks", "y"))
    # Half of the sequences hold marks; copies of a line count once.
    some = every.where(F.size("at") > 0).distinct().orderBy("hash").limit(SEQUENCES // 2).collect()
    # Sequences without marks differ only in length; they weigh as much as the marked ones.
    blank = every.where(F.size("at") == 0).groupBy("words").count().orderBy("words").collect()  # at most LENGTH rows
    share = SEQUENCES / 2 / max(sum(r["count"] for r in blank), 1)
    rows_ = [(r.words, r.at, r.marks, r.y, 1.0) for r in some if r.words]
    rows_ += [(r.words, [], [], [], min(share, 1.0) * r["count"]) for r in blank if r.words]
    if not names:
        return Field()
    crf = fit_field(rows_, names)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in in_steps(batches):
            great, mass, _ = tag(step.column("text").to_pylist(), crf, spans=False)
            yield pa.RecordBatch.from_arrays([step.column("y"), pa.array(great), pa.array(mass)], ["y", "great", "mass"])

    measured = sample.select("y", "text").mapInArrow(measure, "y int, great double, mass double")
    # At most `rows` triples of numbers.
    table = np.array(measured.orderBy("great", "mass", "y").toArrow().to_pandas(), np.float64)
    crf.document = _logistic(np.c_[np.ones(len(table)), table[:, 1], np.log1p(table[:, 2])], table[:, 0])
    return crf


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients by Newton steps with a small penalty."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (y - p) - 0.1 * w)
    return w


def tag(texts: list[str], crf: Field, spans: bool = True) -> tuple[np.ndarray, np.ndarray, list[list[tuple]]]:
    """Greatest marginal, sum of marginals and toxic spans (first character, end, greatest marginal) of each text."""
    crf.trim()
    cut = [sequences(t) for t in texts]
    sizes = np.array([len(s) for c in cut for s in c], np.int64)
    doc = np.repeat(np.arange(len(texts)), [len(c) for c in cut])
    great, mass = np.zeros(len(texts)), np.zeros(len(texts))
    out: list[list[tuple]] = [[] for _ in texts]
    emission = np.array([crf.emission(w) for c in cut for s in c for w in s])
    marked = np.zeros(len(sizes), bool)
    marked[np.repeat(np.arange(len(sizes)), sizes)[emission != crf.bias]] = True
    # Sequences without marks differ only in length: one of each length stands for all, and they add nothing to the sum.
    lengths = np.unique(sizes)
    blank = marginals(np.full((len(lengths), LENGTH), crf.bias), lengths, crf.start, crf.moves)
    np.maximum.at(great, doc[~marked], blank.max(1)[np.searchsorted(lengths, sizes[~marked])])
    if not marked.any():
        return great, mass, out
    chosen = np.flatnonzero(marked)
    starts = np.cumsum(sizes) - sizes
    first = starts - starts[np.searchsorted(doc, doc)]  # words of the document before the sequence
    hits: dict[int, dict[int, float]] = {}
    # Sequences of like length go together, in pieces of so many cells: padding and memory stay small.
    chosen = chosen[np.argsort(sizes[chosen], kind="stable")]
    while len(chosen):
        cells = sizes[chosen] * np.arange(1, len(chosen) + 1)
        piece, chosen = np.split(chosen, [max(1, int(np.searchsorted(cells, CELLS, side="right")))])
        padded = np.full((len(piece), int(sizes[piece[-1]])), crf.bias)
        inside = np.arange(padded.shape[1]) < sizes[piece][:, None]
        padded[inside] = emission[(starts[piece][:, None] + np.arange(padded.shape[1]))[inside]]
        marginal = marginals(padded, sizes[piece], crf.start, crf.moves)
        np.maximum.at(great, doc[piece], marginal.max(1))
        np.add.at(mass, doc[piece], marginal.sum(1))
        if spans:
            for i, t in zip(*np.nonzero(marginal >= 0.5), strict=True):
                s = piece[i]
                hits.setdefault(int(doc[s]), {})[int(first[s] + t)] = float(marginal[i, t])
    if spans:
        for d, found in hits.items():
            out[d] = _spans(texts[d], found)
    return great, mass, out


def _spans(text: str, found: dict[int, float]) -> list[tuple[int, int, float]]:
    """Characters of the words with the given numbers; neighbours on a line are joined."""
    spans: list[tuple[int, int, float]] = []
    for k, m in enumerate(re.finditer(r"\S+", text)):
        if k not in found:
            continue
        if k - 1 in found and "\n" not in text[spans[-1][1] : m.start()]:
            spans[-1] = (spans[-1][0], m.end(), max(spans[-1][2], found[k]))
        else:
            spans.append((m.start(), m.end(), found[k]))
    return spans


def score(docs: DataFrame, crf: Field) -> DataFrame:
    """(doc_id, score, spans) for every row; null and empty texts have the lowest score and no span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in in_steps(batches, limit=STEP_BYTES // 2):
            great, mass, tagged = tag(step.column("text").to_pylist(), crf)
            value = crf.score(great, mass)
            spans = [[{"start": a, "end": b, "score": s} for a, b, s in found] for found in tagged]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [step.column("doc_id"), pa.array(value), pa.array(spans, kind)],
                ["doc_id", "score", "spans"],
            )

    return keyed_texts(docs).mapInArrow(run, "doc_id long, score double, spans array<struct<start:int,end:int,score:double>>")


def keep_clean(docs: DataFrame, crf: Field, limit: float) -> DataFrame:
    """The rows of docs, all columns, whose text scores below `limit`; null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in in_steps(batches, limit=STEP_BYTES // 8):
            great, mass, _ = tag([t or "" for t in step.column("text").to_pylist()], crf, spans=False)
            yield step.filter(pa.array(crf.score(great, mass) < limit))

    return docs.mapInArrow(run, docs.schema)
