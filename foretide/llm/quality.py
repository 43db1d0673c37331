"""Quality score by histogram gradient-boosted trees over document statistics.

The statistics of a bounded sample of labelled documents reach the driver, which fits the trees; every document is
then scored inside map tasks by walking the flat tree arrays.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretide.llm import trees
from foretide.llm.common import in_steps, keyed_texts

# Labelled documents the trees are fitted on at most: those of smallest id hash.
SAMPLE = 20_000
NAMES = [
    "chars", "words", "lines", "word_length", "longest_word", "distinct_words", "top_word", "repeated_next",
    "words_without_letter", "words_ending_in_mark", "short_words", "distinct_lines", "line_length", "words_per_stop",
    "letters", "upper", "digits", "blanks", "stops", "bars", "symbols", "wide", "entropy",
]
_STOPS, _SYMBOLS = b".,;:!?", b"#$%&*+<=>@\\^_`{}~/[]()"


def _byte_classes() -> np.ndarray:
    kind = np.full(256, 8, np.uint8)  # anything else
    for value, members in enumerate((range(97, 123), range(65, 91), range(48, 58), b" \n\t\r", _STOPS, b"|", _SYMBOLS, range(128, 256))):
        kind[list(members)] = value
    return kind


_CLASS = _byte_classes()


def statistics(text: str) -> list[float]:
    """The statistics named in NAMES; all zero for an empty text."""
    if not text:
        return [0.0] * len(NAMES)
    data = np.frombuffer(text.encode(), np.uint8)
    bytes_ = np.bincount(data, minlength=256)
    n = len(data)
    share = np.bincount(_CLASS, bytes_, 9) / n
    words, lines = text.split(), text.split("\n")
    count = max(len(words), 1)
    seen = Counter(words)
    held = bytes_[bytes_ > 0] / n
    return [
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), (len(text) - count + 1) / count,
        max(map(len, words), default=0), len(seen) / count, max(seen.values(), default=0) / count,
        sum(map(operator.eq, words, words[1:])) / count,
        1 - sum(map(str.isalpha, map(operator.itemgetter(0), words))) / count,
        1 - sum(map(str.isalnum, map(operator.itemgetter(-1), words))) / count,
        sum(len(w) < 4 for w in words) / count, len(set(lines)) / len(lines), np.log1p(n / len(lines)),
        count / (1 + text.count(".")), share[0] + share[1] + share[7], share[1], share[2], share[3], share[4], share[5],
        share[6], share[7], float(-(held * np.log2(held)).sum()),
    ]


def labelled(docs: DataFrame, labels: DataFrame, label: str, keep: Column, rows: int) -> DataFrame:
    """(doc_id, text, y) of at most `rows` labelled documents that `keep` (over doc_id) admits, by smallest id hash.

    A document with several label rows has the greatest label; rows without doc_id or label teach nothing. A doc_id
    that stands in docs more than once teaches each of its texts.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).dropna()
    known = known.where(keep).groupBy("doc_id").agg(F.max("y").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return keyed_texts(docs).join(F.broadcast(chosen), "doc_id")  # at most `rows` pairs of numbers


def _statistics_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for step in in_steps(batches):
        x = pa.array([statistics(t) for t in step.column("text").to_pylist()], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([step.column("y"), x], ["y", "x"])


def fit(docs: DataFrame, labels: DataFrame, keep: Column, label: str = "quality", rows: int = SAMPLE) -> trees.Trees:
    """Trees for P(label = 1), learned from labelled documents whose doc_id `keep` admits."""
    sample = labelled(docs, labels, label, keep, rows).mapInArrow(_statistics_of, "y int, x array<double>")
    table = sample.toArrow().sort_by([("y", "ascending")])  # at most rows x len(NAMES) numbers
    x = np.array(table.column("x").to_pylist(), np.float64).reshape(-1, len(NAMES))
    y = table.column("y").to_numpy().astype(np.float64)
    order = np.lexsort((*x.T, y))  # the same trees whatever order the rows came in
    return trees.fit(x[order], y[order])


def score(docs: DataFrame, model: trees.Trees) -> DataFrame:
    """(doc_id, score) for every row; null text counts as empty and gets the score of an empty text.

    Repeated rows each give a row; a null doc_id stays null; an empty table gives no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in in_steps(batches):
            x = np.array([statistics(t) for t in step.column("text").to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([step.column("doc_id"), pa.array(model.score(x))], ["doc_id", "score"])

    return keyed_texts(docs).mapInArrow(run, "doc_id long, score double")
