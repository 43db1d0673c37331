"""Byte-pair encoding and decoding with a given vocabulary file.

Words are merged in batched numpy rounds: the symbols of many words lie in one flat array, every adjacent pair is
looked up by binary search in the sorted pair keys, and each word merges its lowest-ranked pair. Words seen before
come from a bounded per-worker table. Everything happens inside map tasks, without a shuffle.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from foretide.llm.common import in_steps, keyed_texts

# Fixed value: the word pattern that belongs to the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Entries of each worker's table of known pieces; beyond that the later half is dropped.
KNOWN = 400_000
# Words of more bytes are merged with a heap; the rounds below cost (distinct pairs x length) for one word.
LONG_WORD = 400
_BITS = 20
_NO_PAIR = 1 << 40
# Marks that end a word and start one of their own.
_MARKS = frozenset(".,;:!?|")
# Runs of white space that a split at single blanks would cut differently.
_UNEVEN = re.compile(r"\s\s\s|\s\s\Z")


def _byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Encoder:
    """Encodes texts as the file's tokenizer does; ids come as little-endian 32-bit bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        vocabulary, merges = held["model"]["vocab"], held["model"]["merges"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in merges]
        alphabet = _byte_alphabet()
        back = {c: b for b, c in enumerate(alphabet)}
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        size = max([*vocabulary.values(), *self.special.values()]) + 1
        self.token = [b""] * size
        for text, i in vocabulary.items():
            self.token[i] = bytes(back[c] for c in text)
        for text, i in self.special.items():
            self.token[i] = text.encode()
        self.byte_id = np.array([vocabulary[c] for c in alphabet], np.int64)
        left = np.array([vocabulary[a] for a, _ in merges], np.int64)
        right = np.array([vocabulary[b] for _, b in merges], np.int64)
        made = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        keys = left << _BITS | right
        order = np.argsort(keys)
        self.keys, self.rank, self.made = keys[order], order, made[order]
        self.find = regex.compile(PATTERN).findall
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split if self.special else None
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, in order."""
        for known in (self.words, self.chunks):
            if len(known) > KNOWN:  # those met first are the frequent ones
                first = dict(islice(known.items(), KNOWN // 2))
                known.clear()
                known.update(first)
        plans = [self._plan(t) for t in texts]
        new = set().union(*(rest for _, rest in plans)) - self.chunks.keys()
        plain, marked, other = set(), [], {}
        for c in new:
            if c.isalpha():
                plain.add(c)
            elif c[-1:] in _MARKS and c[:-1].isalpha():
                marked.append(c)
            else:
                other[c] = self.find(c if c[:1] == "\n" else " " + c)
        plain.update(c[:-1] for c in marked if c[:-1] not in self.chunks)
        self._learn(plain, self.chunks, " ")
        word, chunk = self.words.__getitem__, self.chunks
        mixed = set(chain.from_iterable(other.values())).union(*(first for first, _ in plans), {c[-1] for c in marked})
        self._learn(mixed, self.words, "")
        for c in marked:
            chunk[c] = chunk[c[:-1]] + word(c[-1])
        for c, parts in other.items():
            chunk[c] = b"".join(map(word, parts))
        look = chunk.__getitem__
        return [b"".join(chain(map(word, first), map(look, rest))) for first, rest in plans]

    def _plan(self, text: str) -> tuple[list[str], list[str]]:
        """Words to encode one by one, and after them chunks that each begin at a blank or line break.

        The pattern always starts a word at a blank between other characters, so whole chunks can be looked up.
        Special tokens and long runs of white space go through the pattern.
        """
        if self.cut is not None and any(s in text for s in self.special):
            parts = self.cut(text)
            return [w for p in parts for w in ([p] if p in self.special else self.find(p))], []
        if _UNEVEN.search(text):
            return self.find(text), []
        first, *rest = text.replace("\n", " \n").split(" ")
        return self.find(first), rest

    def _learn(self, words: set[str], known: dict[str, bytes], lead: str) -> None:
        """Add to `known` the ids of lead + word for every new word."""
        short = []
        for w in words - known.keys():
            if w in self.special and not lead:
                known[w] = np.array([self.special[w]], "<u4").tobytes()
            elif len(data := (lead + w).encode()) > LONG_WORD:
                known[w] = self._merge_long(data)
            else:
                short.append((w, data))
        for start in range(0, len(short), 20_000):
            part = short[start : start + 20_000]
            known.update(zip([w for w, _ in part], self._merge([d for _, d in part]), strict=True))

    def _look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (a large number if there is none) and merged id of pair keys."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank[at], _NO_PAIR), self.made[at]

    def _merge(self, words: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(words)
        sizes = np.array([len(w) for w in words], np.int64)
        owner = np.repeat(np.arange(len(words)), sizes)
        symbol = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        rank, made = np.full(len(owner), _NO_PAIR), np.zeros(len(owner), np.int64)
        look = np.flatnonzero(owner[:-1] == owner[1:])
        while len(owner):
            rank[look], made[look] = self._look_up(symbol[look] << _BITS | symbol[look + 1])
            start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(rank, start)
            count = np.diff(np.r_[start, len(owner)])
            done = lowest == _NO_PAIR
            if done.any():
                ids, ends = symbol.astype("<u4").tobytes(), (4 * (start + count))[done].tolist()
                for o, a, b in zip(owner[start[done]].tolist(), (4 * start[done]).tolist(), ends, strict=True):
                    out[o] = ids[a:b]
            here = rank == np.repeat(np.where(done, -1, lowest), count)
            # In a run of overlapping equal pairs every second one is merged, from the left.
            place = np.arange(len(here))
            begins = np.maximum.accumulate(np.where(here & ~np.r_[False, here[:-1]], place, 0))
            here &= (place - begins) % 2 == 0
            symbol[here] = made[here]
            keep = ~np.r_[False, here[:-1]] & np.repeat(~done, count)
            symbol, owner, rank, made, here = symbol[keep], owner[keep], rank[keep], made[keep], here[keep]
            # Only pairs next to a merged symbol have changed.
            near = here | np.r_[here[1:], False]
            inside = np.r_[owner[:-1] == owner[1:], False] if len(owner) else near
            rank[near & ~inside] = _NO_PAIR
            look = np.flatnonzero(near & inside)
        return out

    def _merge_long(self, word: bytes) -> bytes:
        """One long word: a heap of pairs, lowest rank first, then leftmost."""
        symbol = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        after, before = list(range(1, len(symbol) + 1)), list(range(-1, len(symbol) - 1))
        table = self._table()
        heap = [(*table[k], i) for i, k in enumerate(zip(symbol, symbol[1:], strict=False)) if k in table]
        heapq.heapify(heap)
        while heap:
            rank, made, i = heapq.heappop(heap)
            j = after[i] if symbol[i] is not None else len(symbol)
            if j >= len(symbol) or table.get((symbol[i], symbol[j])) != (rank, made):
                continue
            symbol[i], symbol[j], after[i] = made, None, after[j]
            if after[j] < len(symbol):
                before[after[j]] = i
                if pair := table.get((made, symbol[after[j]])):
                    heapq.heappush(heap, (*pair, i))
            if before[i] >= 0 and (pair := table.get((symbol[before[i]], made))):
                heapq.heappush(heap, (*pair, before[i]))
        return np.array([s for s in symbol if s is not None], "<u4").tobytes()

    @lru_cache(maxsize=1)  # noqa: B019  one encoder per worker
    def _table(self) -> dict[tuple[int, int], tuple[int, int]]:
        low = (1 << _BITS) - 1
        return {
            (k >> _BITS, k & low): (r, m)
            for k, r, m in zip(self.keys.tolist(), self.rank.tolist(), self.made.tolist(), strict=True)
        }

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.token.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary file."""
    return Encoder(path)


def encode(docs: DataFrame, path: str, decoded: bool = False) -> DataFrame:
    """(doc_id, ids) per row of docs, and with `decoded` the text that the ids give back.

    Null text counts as empty and has no ids; special tokens in a text get their own id, as in the library.
    Repeated rows each give a row; a null doc_id stays null.
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
                texts = [coder.decode(flat[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
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
