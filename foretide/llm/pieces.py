"""Encoding and decoding with a SentencePiece vocabulary of the merge type.

Adjacent symbols whose joined text is a piece wait in an agenda ordered by the piece's score, ties from the left; the
best pair is merged until the agenda is empty. What no piece holds is spelled in bytes. No merge can cross a place whose
two characters never stand side by side in a piece, so texts are cut there first, and the parts met before come from a
bounded per-worker table. Everything happens inside map tasks, without a shuffle.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from foretide.llm.common import in_steps, keyed_texts

# Entries of a worker's two tables: chunks between blanks, and the parts they are cut into.
KNOWN, KNOWN_PARTS = 700_000, 300_000
SPACE = "▁"
# Fixed values of the file format: field numbers and piece types.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_TEXT, _SCORE, _TYPE = 1, 2, 3
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_MERGE_TYPE = 2
# Places of an agenda entry's rank and of its symbol.
_AT = 32
_LOW = (1 << _AT) - 1


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = number() if kind == 2 else 8 if kind == 1 else 4
        yield key >> 3, data[at : at + size]
        at += size


class Encoder:
    """Encodes texts as the library does with this model, without begin and end ids.

    Taken are merge-type models that keep all characters and all white space (identity rule), spell unknown characters in
    bytes and have no user-defined or unused pieces; others are refused.
    """

    def __init__(self, path: str):
        with open(path, "rb") as file:
            top = list(_fields(file.read()))
        trainer = dict(_fields(next(v for k, v in top if k == _TRAINER)))
        rule = dict(_fields(next(v for k, v in top if k == _NORMALIZER)))
        held = [dict(_fields(v)) for k, v in top if k == _PIECES]
        self.text = [p[_TEXT].decode() for p in held]
        kinds = [p.get(_TYPE, _NORMAL) for p in held]
        # Trainer 3: type, 24: white space as suffix, 35: byte fallback; rule 2: character map, 3: dummy prefix, 4 and 5: white space.
        plain = trainer.get(3) == _MERGE_TYPE and trainer.get(35) and not trainer.get(24) and set(kinds) <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}
        if not plain or rule.get(2) or rule.get(4, 1) or not rule.get(5, 1) or not rule.get(3, 1):
            raise ValueError(f"{path}: not a merge-type model with bytes and without a character map")
        self.unknown_text = trainer.get(44, " ⁇ ".encode())
        self.byte = {int(t[3:5], 16): i for i, (t, k) in enumerate(zip(self.text, kinds, strict=True)) if k == _BYTE}
        self.of_byte = {i: b for b, i in self.byte.items()}
        self.control = {i for i, k in enumerate(kinds) if k == _CONTROL}
        self.unknown = {i for i, k in enumerate(kinds) if k == _UNKNOWN}
        normal = {t: i for i, (t, k) in enumerate(zip(self.text, kinds, strict=True)) if k == _NORMAL}
        # Equal scores share a rank: then the leftmost pair goes first.
        score = {t: struct.unpack("<f", held[i][_SCORE])[0] for t, i in normal.items()}
        rank = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        # Characters that stand in pieces only have numbers of their own beyond the ids.
        self.symbol = {t: i for t, i in normal.items() if len(t) == 1}
        for c in sorted(set().union(*normal)):
            self.symbol.setdefault(c, len(held) + len(self.symbol))
        known = normal | self.symbol
        self.pair: dict[int, int] = {}
        for text, i in normal.items():
            for cut in range(1, len(text)):
                a, b = known.get(text[:cut]), known.get(text[cut:])
                if a is not None and b is not None:
                    self.pair[a << _AT | b] = rank[score[text]] << _AT | i
        self.joined = {text[k : k + 2] for text in normal for k in range(len(text) - 1)}
        self.spelled = {n: self._bytes(c) for c, n in self.symbol.items() if c not in normal}
        self.chunks: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        # One chunk after each blank; white space that may merge with itself goes through the other way.
        self.uneven = re.compile(f"  |\\A |{SPACE}").search
        whole = [t.replace(SPACE, " ").encode() for t in self.text]
        self.plain = [b"" if i in self.control else bytes([self.of_byte[i]]) if i in self.of_byte else w for i, w in enumerate(whole)]
        for i in self.unknown:
            self.plain[i] = self.unknown_text

    def _bytes(self, c: str) -> bytes:
        return np.array([self.byte[b] for b in c.encode()], "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit bytes, in order."""
        for known, most in ((self.chunks, KNOWN), (self.parts, KNOWN_PARTS)):
            if len(known) > most:  # those met first are the frequent ones
                first = dict(islice(known.items(), most // 2))
                known.clear()
                known.update(first)
        known, out = self.chunks, []
        for text in texts:
            if self.uneven(text):
                out.append(self._chunk(SPACE + text.replace(" ", SPACE)))
                continue
            # A line break joins no piece: it may begin a chunk, which then has no blank before it.
            chunks = text.replace("\n", " \n").split(" ") if text else []
            if text[:1] == "\n":
                chunks[0] = ""  # the mark that stands before every text
            for c in chunks:
                if c not in known:
                    known[c] = self._chunk(c if c[:1] == "\n" else SPACE + c)
            out.append(b"".join(map(known.__getitem__, chunks)))
        return out

    def _chunk(self, text: str) -> bytes:
        """Ids of a text whose blanks are marks already: cut where no piece has the two neighbours, then merged."""
        joined, parts, found, start = self.joined, self.parts, [], 0
        for k in range(1, len(text) + 1):
            if k < len(text) and text[k - 1 : k + 1] in joined:
                continue
            part = text[start:k]
            ids = parts.get(part)
            if ids is None:
                ids = self._merge(part)
                if k - start <= 64:
                    parts[part] = ids
            found.append(ids)
            start = k
        return b"".join(found)

    def _merge(self, part: str) -> bytes:
        """The agenda: pairs by rank, then place; an entry counts if the pair at its place still has its rank."""
        if len(part) == 1 and part not in self.symbol:
            return self._bytes(part)
        symbol = [self.symbol[c] for c in part]  # characters outside all pieces are always alone
        size, pair = len(symbol), self.pair.get
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        agenda = [
            v >> _AT << _AT | k for k in range(size - 1) if (v := pair(symbol[k] << _AT | symbol[k + 1])) is not None
        ]
        heapq.heapify(agenda)
        pop, push = heapq.heappop, heapq.heappush
        while agenda:
            entry = pop(agenda)
            k = entry & _LOW
            right = after[k]
            if symbol[k] < 0 or right >= size:
                continue
            made = pair(symbol[k] << _AT | symbol[right])
            if made is None or made >> _AT != entry >> _AT:
                continue
            symbol[k], symbol[right] = made & _LOW, -1
            after[k] = after[right]
            if after[k] < size:
                before[after[k]] = k
                if (v := pair(symbol[k] << _AT | symbol[after[k]])) is not None:
                    push(agenda, v >> _AT << _AT | k)
            if before[k] >= 0 and (v := pair(symbol[before[k]] << _AT | symbol[k])) is not None:
                push(agenda, v >> _AT << _AT | before[k])
        left = [s for s in symbol if s >= 0]
        spelled = self.spelled
        if any(s in spelled for s in left):
            return b"".join(spelled[s] if s in spelled else struct.pack("<I", s) for s in left)
        return struct.pack(f"<{len(left)}I", *left)

    def decode(self, ids: list[int]) -> str:
        """The text of the ids; bytes that are no character become U+FFFD one by one."""
        first = next((k for k, i in enumerate(ids) if i not in self.control), len(ids))
        held = list(map(self.plain.__getitem__, ids))
        if first < len(ids) and self.text[ids[first]].startswith(SPACE):
            held[first] = held[first][1:]
        try:
            text = b"".join(held).decode()
        except UnicodeDecodeError:
            text = None
        if text is None or not self.control.isdisjoint(ids):  # only neighbouring byte pieces form a character
            text, run = "", b""
            for i, data in zip(ids, held, strict=True):
                if i in self.of_byte:
                    run += data
                else:
                    text, run = text + _lenient(run) + data.decode(), b""
            text += _lenient(run)
        return text


def _lenient(data: bytes) -> str:
    out, at = [], 0
    while at < len(data):
        size = next((n for n in (1, 2, 3, 4) if _whole(data[at : at + n])), 0)
        out.append(data[at : at + size].decode() if size else "�")
        at += size or 1
    return "".join(out)


def _whole(data: bytes) -> bool:
    try:
        return len(data.decode()) == 1
    except UnicodeDecodeError:
        return False


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and model file."""
    return Encoder(path)


def encode(docs: DataFrame, path: str, decoded: bool = False) -> DataFrame:
    """(doc_id, ids) per row of docs, and with `decoded` the text that the ids give back.

    Null text counts as empty and has no ids; texts like those of control pieces are ordinary text, as in the library.
    Repeated rows each give a row; a null doc_id stays null; an empty table gives no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for step in in_steps(batches):
            found = coder.encode(step.column("text").to_pylist())
            ends = np.cumsum([0, *(len(b) // 4 for b in found)], dtype=np.int64)
            flat = np.frombuffer(b"".join(found), "<i4")
            columns = [step.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))]
            names = ["doc_id", "ids"]
            if decoded:
                held = flat.tolist()
                texts = [coder.decode(held[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                columns.append(pa.array(texts, pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names)

    return keyed_texts(docs).mapInArrow(run, "doc_id long, ids array<int>" + ", decoded string" * decoded)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            texts = [coder.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


@lru_cache(maxsize=2)
def _library(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def differences(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of the rows whose ids or decoded text differ from the library's: none, if this module is right."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, library = encoder(path), _library(path)
        for step in in_steps(batches):
            texts = step.column("text").to_pylist()
            ids = [np.frombuffer(b, "<u4").tolist() for b in coder.encode(texts)]
            theirs = library.encode(texts, num_threads=1)
            back = library.decode(theirs, num_threads=1)
            bad = [i != j or coder.decode(i) != t for i, j, t in zip(ids, theirs, back, strict=True)]
            yield step.filter(pa.array(bad, pa.bool_()))

    return keyed_texts(docs).mapInArrow(run, "doc_id long, text string")
