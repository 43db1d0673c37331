"""Fill-in-the-middle against a plain version."""

import hashlib
import random
from collections import Counter

import oracle
import pytest
from cases import documents, empty, texts

from foretide.llm import infill, queries

ODD = ["<", "<P", "<P>", "a<S>b", "x<M", "<M<", "<<S", "P>", "S>x", "<" * 9, "<S" * 7, "é" * 50, "日本\U0001f600" * 9, "\x00<", "\n"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(doc_id, text):
    text = text or ""
    h = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(text)
    i, j = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, m, z = text[:i], text[i:j], text[j:]
    form = "spm" if h4 % 100 < 20 else "psm"
    out = f"<S>{z}<P>{a}<M>{m}" if form == "spm" else f"<P>{a}<S>{z}<M>{m}"
    return doc_id, n, form, i, j - i, sha(out), sha(text)


@pytest.mark.parametrize("unit", [1, 2, 3, 7, 4096])
def test_digests(spark, unit):
    """Pieces down to one code point, so that marks and half marks lie across pieces."""
    r = random.Random(unit)
    rows = [(5000 + i, "".join(r.choices(ODD, k=r.randint(0, 6)))) for i in range(150)]
    rows += [(i, t) for i, t in texts() if unit > 2 or len(t or "") < 3000]
    rows += rows[:3]
    found = infill.digests(documents(spark, rows), unit).collect()
    assert Counter(map(tuple, found)) == Counter(plain(i, t) for i, t in rows)


def test_reader_finds_marks_across_pieces():
    r = random.Random(3)
    for _ in range(3000):
        text = "".join(r.choices("<PSM>ab", k=r.randint(1, 12)))
        if any(m in text for m in ("<P>", "<S>", "<M>")):
            continue
        i, j = sorted((r.randint(0, len(text)), r.randint(0, len(text))))
        out = r.choice([f"<P>{text[:i]}<S>{text[j:]}<M>{text[i:j]}", f"<S>{text[j:]}<P>{text[:i]}<M>{text[i:j]}"])
        reader, got = infill._Reader("psm"), []
        while out:
            k = r.randint(1, 4)
            got += reader.take(out[:k])
            out = out[k:]
        got += reader.take("", last=True)
        assert "".join(t for _, t in sorted(got, key=lambda x: x[0])) == text


def test_pieces_are_the_outputs(spark):
    docs = documents(spark, [(1, "one two three four"), (2, None), (3, "<P>"), (3, "<P>"), (None, "x y")])
    rows = infill.pieces(docs, 5).collect()
    held = {}
    for r in sorted(rows, key=lambda r: (r.row, r["at"])):
        held[r.row] = held.get(r.row, "") + r.text
    assert Counter(sha(t) for t in held.values()) == Counter(plain(i, t)[5] for i, t in [
        (1, "one two three four"), (2, None), (3, "<P>"), (3, "<P>"), (None, "x y")])


def test_one_exchange(spark):
    plan = infill.digests(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Exchange") <= 2 + plan.count("RoundRobin")


def test_empty(spark):
    assert infill.digests(empty(spark)).count() == 0


def test_other_shares(spark):
    docs = documents(spark, [(i, "some text here") for i in range(40)])
    assert {r.form for r in infill.digests(docs, change=0).collect()} == {"plain"}
    assert {r.form for r in infill.digests(docs, change=100, suffix_first=100).collect()} == {"spm"}


def test_query_matches_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert oracle.differences(spark, oracle.connect(folder), "op12_infill", queries.op12_infill, queries.INFILL_SQL, folder) == []
