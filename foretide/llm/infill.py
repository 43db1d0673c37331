"""Fill-in-the-middle documents: prefix, middle and suffix in a new order behind marks, and back again.

Secondary sort: every text is cut into pieces of at most UNIT code points that carry their place in the output; one
exchange brings the pieces of a document into one partition and sorts them by place (`repartition` on the document with
`sortWithinPartitions`, the DataFrame form of `repartitionAndSortWithinPartitions`). The sorted pieces run through an
incremental digest and through a reader that finds the marks again and gives each piece its place in the restored text;
a second sort inside the same partitions, without another exchange, brings them into that order for the second digest.
No task ever holds an assembled document: it holds one batch of pieces.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretide.llm.common import in_steps, keyed_texts

# Code points of a piece.
UNIT = 4096
# The marks that stand before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Place of a section in the restored text.
_PLACE = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
_MARK = re.compile("|".join(_PLACE))
# The end of a piece that may be the beginning of a mark.
_HALF_MARK = re.compile("<[PSM]?\\Z")

_PIECE = "spread long, row long, doc_id long, at long, n long, form string, prefix_chars long, middle_chars long, text string"


def choose(doc_id: int | None, text: str, seed: str = "1", change: int = 90, suffix_first: int = 20) -> tuple[str, int, int]:
    """(form, end of the prefix, end of the middle) of a text, from the hash of seed and id; a null id counts as no digits.

    Of 100 documents `change` are rearranged, and of 100 rearranged ones `suffix_first` have the form spm. Empty texts and
    texts that hold a mark stay plain.
    """
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    low, high = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    if not text or _MARK.search(text) or h3 % 100 >= change:
        return "plain", low, high
    return ("spm" if h4 % 100 < suffix_first else "psm"), low, high


def pieces(docs: DataFrame, unit: int = UNIT, **choice: str | int) -> DataFrame:
    """The output of every row of docs in pieces, those of one document in one partition and in order of `at`.

    `at` is a piece's first code point in the output, `row` tells rows with one doc_id apart, `spread` is what the exchange
    deals by; the first piece carries n (code points of the text), form, prefix_chars and middle_chars (null if plain).
    Null text counts as empty and gives one empty piece; repeated rows give their pieces each; columns of any other name
    do not matter.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in in_steps(batches):
            out: list[list] = [[] for _ in range(9)]
            for spread, row, doc_id, text in zip(*(step.column(c).to_pylist() for c in ("spread", "row", "doc_id", "text")), strict=True):
                form, low, high = choose(doc_id, text, **choice)
                sections = {"plain": [text], "psm": [PREFIX + text[:low], SUFFIX + text[high:], MIDDLE + text[low:high]],
                            "spm": [SUFFIX + text[high:], PREFIX + text[:low], MIDDLE + text[low:high]]}[form]
                head = (len(text), form, *((None, None) if form == "plain" else (low, high - low)))
                at = 0
                for section in sections:
                    for start in range(0, max(len(section), 1), unit):
                        part = section[start : start + unit]
                        values = (spread, row, doc_id, at, *(head if at == 0 else (None,) * 4), part)
                        for column, value in zip(out, values, strict=True):
                            column.append(value)
                        at += len(part)
            yield _batch(out, _PIECE)

    spread = F.xxhash64("doc_id", "text").alias("spread")
    whole = keyed_texts(docs).select(spread, F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return whole.mapInArrow(cut, _PIECE).repartition("spread").sortWithinPartitions("spread", "row", "at")


_KINDS = {"long": pa.int64(), "string": pa.string()}


def _batch(columns: list[list], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(f.split() for f in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, k in zip(columns, kinds, strict=True)], names)


class _Reader:
    """Takes an output piece by piece and gives (place of the section, text) pairs."""

    def __init__(self, form: str):
        self.form, self.place, self.held = form, 0, ""

    def take(self, text: str, last: bool = False) -> list[tuple[int, str]]:
        if self.form == "plain":
            return [(0, text)] if text else []
        data, out = self.held + text, []
        while mark := _MARK.search(data):
            out.append((self.place, data[: mark.start()]))
            self.place, data = _PLACE[mark.group()], data[mark.end() :]
        half = None if last else _HALF_MARK.search(data)
        cut = half.start() if half else len(data)
        out.append((self.place, data[:cut]))
        self.held = data[cut:]
        return [(place, part) for place, part in out if part]


_RESTORED = "spread long, row long, doc_id long, place long, at long, n long, form string, prefix_chars long, middle_chars long, text string, output_sha256 string"


def restored(assembled: DataFrame) -> DataFrame:
    """From `pieces`: the texts rebuilt from output and form alone, in pieces ordered by (place, at) within a partition.

    Per document a row with place -1 comes first: no text, but the columns of the document's first piece and the digest of
    the whole output.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = reader = digest = head = None
        count = 0
        out: list[list] = [[] for _ in range(11)]

        def add(place: int, values: tuple, text: str | None, sha: str | None) -> None:
            nonlocal count
            for column, value in zip(out, (*key, place, count, *values, text, sha), strict=True):
                column.append(value)
            count += 1

        def end() -> None:
            for place, text in reader.take("", last=True):
                add(place, (None,) * 4, text, None)
            add(-1, head, None, digest.hexdigest())

        for batch in batches:
            for *this, _, n, form, prefix, middle, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if this != key:
                    if key is not None:
                        end()
                    key, reader, digest, head, count = this, _Reader(form), hashlib.sha256(), (n, form, prefix, middle), 0
                digest.update(text.encode())
                for place, part in reader.take(text):
                    add(place, (None,) * 4, part, None)
            yield _batch(out, _RESTORED)
            out = [[] for _ in range(11)]
        if key is not None:
            end()
            yield _batch(out, _RESTORED)

    return assembled.mapInArrow(read, _RESTORED).sortWithinPartitions("spread", "row", "place", "at")


_DIGESTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


def digests(docs: DataFrame, unit: int = UNIT, **choice: str | int) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) for every row of docs.

    An empty table gives no row; see `pieces` for nulls and repeated rows.
    """

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = head = digest = None
        out: list[list] = [[] for _ in range(7)]

        def end() -> None:
            for column, value in zip(out, (*head, digest.hexdigest()), strict=True):
                column.append(value)

        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            for spread, row, doc_id, place, _, n, form, prefix, middle, text, sha in rows:
                if (spread, row) != key:
                    if key is not None:
                        end()
                    key, digest = (spread, row), hashlib.sha256()
                if place < 0:
                    head = (doc_id, n, form, prefix, middle, sha)
                else:
                    digest.update(text.encode())
            yield _batch(out, _DIGESTS)
            out = [[] for _ in range(7)]
        if key is not None:
            end()
            yield _batch(out, _DIGESTS)

    return restored(pieces(docs, unit, **choice)).mapInArrow(close, _DIGESTS)
