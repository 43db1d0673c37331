"""Byte strings, lines, near-duplicates: against brute force."""

import random

import numpy as np
import pytest
from cases import CLASHING, documents, empty, texts

from foretide.llm import lines, minhash, suffix


def plain_removed(rows, width=suffix.WINDOW):
    """doc_id -> [(text, removed mask)] by looking every window up."""
    first = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for k in range(len(b) - width + 1):
            if i is not None:
                first[b[k : k + width]] = min(i, first.get(b[k : k + width], i))
    out = []
    for i, b in data:
        mask = np.zeros(len(b), bool)
        for k in range(len(b) - width + 1):
            if i is not None and first[b[k : k + width]] < i:
                mask[k : k + width] = True
        out.append((i, b, mask))
    return out


@pytest.mark.parametrize("sizes", [None, (3000, 2000, 1500)])
def test_removed_strings(spark, monkeypatch, sizes):
    if sizes:  # many shards and buckets
        for name, size in zip(("SHARD", "ANCHOR_BUCKET", "RUN_BUCKET"), sizes, strict=True):
            monkeypatch.setattr(suffix, name, size)
    rows = texts()
    found = suffix.removed(documents(spark, rows)).collect()
    ours = sorted((r.doc_id or -1, r.n_bytes, tuple(r.starts), tuple(r.ends), bytes(r.kept)) for r in found)
    plain = []
    for i, b, mask in plain_removed(rows):
        edge = np.flatnonzero(np.diff(np.r_[False, mask, False])).tolist()
        kept = np.frombuffer(b, np.uint8)[~mask].tobytes()
        plain.append((i or -1, len(b), tuple(edge[::2]), tuple(edge[1::2]), kept))
    assert ours == sorted(plain)
    assert sum(len(p[2]) for p in plain) > 20


def test_no_documents(spark):
    assert suffix.removed(empty(spark)).count() == 0
    assert lines.marked(empty(spark)).count() == 0
    assert lines.drop_repeats(empty(spark)).count() == 0
    assert minhash.classes(empty(spark)).count() == 0


def test_suffix_array_and_prefixes():
    r = random.Random(1)
    for _ in range(60):
        parts = ["".join(r.choices("ab", k=r.randint(1, 30))) for _ in range(r.randint(1, 6))]
        flat = np.array([x for p in parts for x in [*(ord(c) for c in p), 0]])
        order = suffix.suffix_array(flat)
        assert order.tolist() == sorted(range(len(flat)), key=lambda i: flat[i:].tolist())
        end = np.cumsum([len(p) + 1 for p in parts]) - 1
        begin = end - [len(p) for p in parts]
        most = r.randint(1, 6)
        found = suffix.common_prefixes(flat, order, begin, end, most)
        before = {b: a for a, b in zip(order, order[1:], strict=False)}
        for b, e in zip(begin, end, strict=True):
            for i in range(b, e - most + 1):
                j, same = before.get(i), 0
                while j is not None and same < most and flat[j + same] and flat[i + same] == flat[j + same]:
                    same += 1
                assert found[i] == same


def test_runs_depend_on_bytes_alone():
    r = np.random.default_rng(2)
    passage = r.integers(97, 101, 300).astype(np.uint8)
    both = []
    for lead in (0, 77):
        data = np.r_[r.integers(97, 101, lead).astype(np.uint8), passage]
        first, last, key = suffix.runs_of(data, np.array([len(data)]))
        both.append({w - lead: k for a, b, k in zip(first, last, key, strict=True) for w in range(a, b + 1) if w >= lead})
    assert both[0] == both[1] and len(both[0]) == 251


def plain_lines(rows, run_lines, alone_words):
    """For each different (doc_id, text): which lines go."""
    docs = sorted({(2**63 - 1 if i is None else i, t or "") for i, t in rows}, key=lambda d: d[0])
    seen, gone = set(), {}
    for i, t in docs:
        held = t.split("\n")
        out = [False] * len(held)
        for n, line in enumerate(held):
            if ("one", line) in seen and line.count(" ") + 1 >= alone_words:
                out[n] = True
            seen.add(("one", line))
            run = tuple(held[n : n + run_lines])
            if len(run) == run_lines:
                if run in seen:
                    out[n : n + run_lines] = [True] * run_lines
                seen.add(run)
        gone[i, t] = out
    return gone


@pytest.mark.parametrize("run_lines", [1, 2, 3, 5])
def test_repeated_lines(spark, run_lines):
    r = random.Random(run_lines)
    rows = [(i, "\n".join(r.choices(["a", "b", "c d", "", "one two three four five six seven eight"], k=r.randint(1, 14)))) for i in range(40)]
    rows += [(41, None), (42, ""), (43, "\n" * 30), (7, rows[7][1]), (None, rows[3][1])]
    found = lines.marked(documents(spark, rows), run_lines, 8).select("row.doc_id", "row.text", "kept", "n_lines", "n_deleted").collect()
    gone = plain_lines(rows, run_lines, 8)
    assert len(found) == len(rows)
    for i, t, kept, n, deleted in found:
        out = gone[2**63 - 1 if i is None else i, t or ""]
        assert (n, deleted) == (len(out), sum(out)), (i, t)
        assert kept == "\n".join(x for x, g in zip((t or "").split("\n"), out, strict=True) if not g)


def test_lines_stage_counts_words_of_any_script(spark):
    """Long lines repeated between different neighbours go whatever parts their words; short ones stay."""
    words = "one two three four five six seven eight".split()
    long = ["\t".join(words), "\u00a0".join(words), " \u3000".join(words), "東京都に住んでいる人々は毎朝早く、", "ภาษาไทยไม่มีการเว้นวรรคระหว่างคำในประโยค"]
    short = ["\t".join(words[:7]), "東京都に住んでいる", "ภาษาไทยไม่มี", "x" * 90]
    for gone, held in ((True, long), (False, short)):
        rows = [(10 * k + i, f"before {k} {i}\n{line}\nafter {k} {i}") for k, line in enumerate(held) for i in range(3)]
        kept = {r.doc_id: r.text for r in lines.drop_repeats(documents(spark, rows)).collect()}
        for i, t in rows:
            first, line, last = t.split("\n")
            assert kept[i] == (f"{first}\n{last}" if gone and i % 10 else t)


def test_lines_stage_keeps_columns(spark):
    docs = documents(spark)
    left = lines.drop_repeats(docs)
    assert left.columns == docs.columns and left.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    rows = left.collect()
    assert {r.doc_id for r in rows} >= {1003, 1004, 1009}  # null, empty and short texts stay
    assert 1000 not in {r.doc_id for r in rows}  # a copy loses every line
    assert all(r.n_chars is None or r.n_chars == len(r.text or "") for r in rows)
    assert all(r[c] == "clash" for r in rows for c in CLASHING)


def plain_classes(rows, similarity=0.8):
    def shingles(t):
        w = (t or "").lower().split()
        n = min(5, len(w))
        return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and len(s & t) >= similarity * len(s | t):
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in parent}


def test_near_duplicate_classes(spark):
    r = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    rows = texts()
    for g in range(6):  # groups of near copies, one beyond a block
        base = r.choices(words, k=120)
        for k in range(40 if g else 12):
            copy = list(base)
            for _ in range(r.randint(0, 3)):
                copy[r.randrange(120)] = r.choice(words)
            rows.append((5000 + 100 * g + k, " ".join(copy)))
    found = minhash.classes(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    plain = plain_classes(rows)
    assert {(r.doc_id, r.class_id, r.kept) for r in found if r.doc_id is not None} == {(i, c, i == c) for i, c in plain.items()}
    assert all(r.kept and r.class_id is None for r in found if r.doc_id is None)


def test_blocks_find_what_the_leader_misses(spark, monkeypatch):
    # A chain: neighbours are near, the ends are not, so groups hold several classes after the first step.
    monkeypatch.setattr(minhash, "BLOCK", 3)
    words = [f"v{k}" for k in range(300)]
    rows = [(900 - k, " ".join(words[4 * k : 4 * k + 100])) for k in range(30)]
    found = minhash.classes(documents(spark, rows)).collect()
    assert {(r.doc_id, r.class_id) for r in found} == set(plain_classes(rows).items())
    assert len({r.class_id for r in found}) == 1


def test_darts_estimate_weighted_similarity():
    r = np.random.default_rng(8)
    names = minhash.mix(np.arange(1, 400, dtype=np.uint64))
    for _ in range(5):
        a, b = r.integers(0, 6, 399) * r.random(399), r.integers(0, 6, 399) * r.random(399)
        b = np.where(r.random(399) < 0.7, a, b)
        x, y = minhash.signatures([names[a > 0], names[b > 0]], [a[a > 0], b[b > 0]], 2048)
        truth = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert abs((x == y).mean() - truth) < 0.06
    # One element alone, and signatures that do not depend on the company.
    one = minhash.signatures([names[:1], names[:50]], [np.ones(1), np.ones(50)], 96)
    assert (one[1] == minhash.signatures([names[:50]], [np.ones(50)], 96)[0]).all() and (one != 0).all()
