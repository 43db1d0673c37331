"""Tokens and packing."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from cases import documents, empty, texts
from tokenizers import Tokenizer

from foretide.llm import bpe, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_encoder_agrees_with_the_library():
    r = random.Random(1)
    library, own = Tokenizer.from_file(PATH), bpe.Encoder(PATH)
    signs = list(" \n\t\r'abcXéß1２。，   ~") + ["'s", "'ll", "<|endoftext|>", "   ", "aaaaaa", "日本", "\U0001f600", "the "]
    odd = ["".join(r.choices(signs, k=r.randint(0, 30))) for _ in range(5000)]
    odd += ["", " ", "  ", "a" * 3000, "ab" * 2000, "<|endoftext|>" * 3, *[t or "" for _, t in texts()]]
    ids = [np.frombuffer(b, "<u4").tolist() for b in own.encode(odd)]
    expected = [e.ids for e in library.encode_batch(odd, add_special_tokens=False)]
    assert ids == expected
    assert [own.decode(i) for i in ids] == [library.decode(i, skip_special_tokens=False) for i in expected] == odd


def test_bounded_tables(monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN", 50)
    own, again = bpe.Encoder(PATH), bpe.Encoder(PATH)
    held = [t or "" for _, t in texts()]
    assert [own.encode([t])[0] for t in held] == again.encode(held)


def test_encode_and_decode(spark):
    docs = documents(spark)
    coded = bpe.encode(docs, PATH, decoded=True)
    rows = coded.collect()
    expected = Counter((i, t or "") for i, t in texts())
    assert Counter((r.doc_id, r.decoded) for r in rows) == expected
    assert Counter((r.doc_id, r.text) for r in bpe.decode(coded, PATH).collect()) == expected
    assert bpe.encode(empty(spark), PATH).count() == 0


def plain_best_fit(lengths, window):
    room = []
    for length in sorted(lengths, reverse=True):
        fits = [k for k, r in enumerate(room) if r >= length]
        if fits:
            room[min(fits, key=lambda k: room[k])] -= length
        else:
            room.append(window - length)
    return sorted(room)


def test_plan_is_best_fit_decreasing():
    r = random.Random(4)
    for window in (8, 37, 100):
        for _ in range(40):
            lengths = [r.randint(1, window) for _ in range(r.randint(0, 60))]
            rows = packing.plan(Counter(lengths), window)
            used = Counter()
            for length, rank, first, per, offset in rows:
                following = [q[1] for q in rows if q[0] == length and q[1] > rank]
                placed = min(following, default=lengths.count(length)) - rank
                for k in range(placed):
                    used[first + k // per] += length
                    assert offset + (k % per + 1) * length <= window
            assert sorted(window - u for u in used.values()) == plain_best_fit(lengths, window)


def test_tightest_capacity():
    r = random.Random(6)
    tree, held = packing.Capacities(64), Counter()
    for _ in range(400):
        c = r.randint(0, 64)
        step = -1 if held[c] and r.random() < 0.6 else 1
        held[c] += step
        tree.add(c, step)
        size = r.randint(1, 64)
        assert tree.tightest(size) == min((k for k in held if held[k] and k >= size), default=None)


def test_packed_pieces(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_PIECES", 10)
    window, library = 64, Tokenizer.from_file(PATH)
    rows = texts()
    found = packing.pack(documents(spark, rows), PATH, window).collect()
    expected = Counter()
    for i, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for at in range(0, len(ids), window):
            part = ids[at : at + window]
            expected[i, at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter(tuple(r)[:5] for r in found) == expected
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= window
    assert sorted(window - sum(n for _, n in h) for h in sequences.values()) == plain_best_fit([r.length for r in found], window)
    assert packing.pack(empty(spark), PATH).count() == 0


def test_long_runs_of_blanks(spark):
    rows = [(1, " " * 200_000), (2, "a" + "\n" * 100_000 + "b")]
    library = Tokenizer.from_file(PATH)
    found = {r.doc_id: r.doc_tokens for r in packing.pack(documents(spark, rows), PATH).collect()}
    assert found == {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows}
