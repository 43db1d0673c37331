"""Trained operators: their parts against plain versions, and held-out accuracy."""

import itertools
import random
import re

import numpy as np
import pytest
from cases import documents, empty
from pyspark.sql import functions as F

from foretide.llm import language, quality, queries, toxicity, trees

FOLDER = "/root/testdata/sf0.01"


def held_out_accuracy(spark, name, label):
    found = queries.QUERIES[name](spark, FOLDER)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert found.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    return sum(r.predicted == r[label] for r in rows) / len(rows)


def test_quality_held_out(spark):
    assert held_out_accuracy(spark, "op5_quality", "quality") > 0.97


def test_toxicity_held_out(spark):
    assert held_out_accuracy(spark, "op9_toxicity", "toxic") > 0.9


def test_language_held_out(spark):
    found = queries.op10_language(spark, FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 200 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.99


def test_trees_learn_a_product():
    r = np.random.default_rng(0)
    x = r.normal(size=(4000, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    model = trees.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.93
    for k in range(20):  # the flat walk against a walk node by node
        total = model.start
        for f, c, leaf in zip(model.feature, model.cut, model.leaf, strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + int(x[k, f[node]] > c[node])
            total += leaf[node - len(f)]
        assert model.score(x[k : k + 1])[0] == pytest.approx(1 / (1 + np.exp(-total)))
    assert trees.fit(np.zeros((0, 3)), np.zeros(0)).score(x[:2]).tolist() == [0.5, 0.5]
    assert (trees.fit(x[:9], np.ones(9)).score(x[:2]) > 0.9).all()


def test_field_against_all_paths():
    r = np.random.default_rng(3)
    emission, start, moves = r.normal(size=(3, 4)), 0.7, r.normal(size=(2, 2))
    sizes = np.array([4, 2, 1])
    marginal, moved = toxicity.forward_backward(emission, sizes, start, moves)
    for i, n in enumerate(sizes):
        weights, sums, steps = 0.0, np.zeros(n), np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=int(n)):
            total = start * path[0] + sum(emission[i, t] * s for t, s in enumerate(path))
            total += sum(moves[a, b] for a, b in itertools.pairwise(path))
            weights += np.exp(total)
            sums += np.exp(total) * np.array(path)
            for a, b in itertools.pairwise(path):
                steps[a, b] += np.exp(total)
        assert np.allclose(marginal[i, :n], sums / weights)
        assert np.allclose(moved[i], steps / weights)
        assert (marginal[i, n:] == 0).all()


def labelled_corpus(spark, seed=1):
    """Prose in which documents with words that begin in `zorg` or are `grumpf` are toxic."""
    r = random.Random(seed)
    words = [a + b for a in "la me ti so ru na".split() for b in "ka lo vi pe da nu so".split()]
    rows, toxic = [], []
    for i in range(400):
        held = r.choices(words, k=r.randint(20, 80))
        bad = i % 5 == 0
        for _ in range(r.randint(2, 5) if bad else 0):
            held[r.randrange(len(held))] = r.choice(["grumpf", "zorg" + r.choice(words)])
        held[len(held) // 2] += "\n"
        rows.append((i, " ".join(held)))
        toxic.append((i, int(bad)))
    return rows, spark.createDataFrame(toxic, "doc_id long, toxic int")


def test_toxic_spans(spark):
    rows, labels = labelled_corpus(spark)
    crf = toxicity.fit(documents(spark, rows), labels, F.col("doc_id") % 2 == 0)
    odd = [(1000, "lavi zorgneu, mepe"), (1001, "lavi grumpf zorgly\nzorgty mepe"), (1002, None), (1003, ""), (None, "x")]
    found = {r.doc_id: r for r in toxicity.score(documents(spark, rows + odd), crf).collect()}
    assert all((found[i].score >= 0.3) == (i % 5 == 0) for i, _ in rows)
    text = odd[1][1]
    assert [text[s.start : s.end] for s in found[1001].spans] == ["grumpf zorgly", "zorgty"]
    assert [(s.start, s.end) for s in found[1000].spans] == [(5, 13)]
    assert found[1002].score == found[1003].score < 0.3 and not found[1002].spans
    kept = toxicity.keep_clean(documents(spark, rows + odd), crf, 0.3)
    assert kept.columns == documents(spark).columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows if i % 5} | {1002, 1003, None}


def test_few_toxic_documents(spark):
    """Six toxic documents: no word can follow eight different ones, and one document's own repeated word is no mark."""
    r = random.Random(4)
    words = [a + b + c for a in "la me ti so ru na".split() for b in "ka lo vi pe da nu so".split() for c in "bcdfg"]
    rows = [(i, " ".join(r.sample(words, 30))) for i in range(36)]
    rows = [(i, f"{t} grumpf {words[i]}" if i % 6 == 0 else t) for i, t in rows]
    rows[6] = (6, rows[6][1] + " laka mumbl tivi mumbl nada mumbl")
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i, _ in rows], "doc_id long, toxic int")
    crf = toxicity.fit(documents(spark, rows), labels, F.lit(True))
    assert "grumpf" in crf.weights and "mumbl" not in crf.weights
    other = [(100, "lakab grumpf mevic"), (101, "lakab mumbl mevic"), (102, "lakab mevic")]
    found = toxicity.score(documents(spark, rows + other), crf).collect()
    assert all((f.score >= 0.3) == (f.doc_id == 100 or f.doc_id < 100 and f.doc_id % 6 == 0) for f in found)


def test_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    docs = documents(spark, [(1, "a b c"), (2, None), (1, "a b c"), (None, "")])
    assert all(r.score < 0.3 for r in toxicity.score(docs, toxicity.fit(docs, none, F.lit(True))).collect())
    model = quality.fit(docs, none, F.lit(True))
    assert [r.score for r in quality.score(docs, model).collect()] == [0.5] * 4
    assert quality.score(empty(spark), model).count() == 0
    assert toxicity.score(empty(spark), toxicity.Field()).count() == 0


def test_quality_statistics_of_odd_texts():
    for text in ("", " ", "\n\n", "x", "日本" * 500, "a " * 5000, "\x00"):
        values = quality.statistics(text)
        assert len(values) == len(quality.NAMES) and np.isfinite(values).all()


def plain_profile(texts):
    counts = {}
    for text in texts:
        word = ""
        for c in text.lower() + " ":
            if c.isalpha():
                word += c
                continue
            for i in range(len(word)):
                padded = "\x01" + word + "\x01"
                for gram in {("u", i): word[i], ("b", i): padded[i : i + 2], ("t", i): padded[i : i + 3]}.values():
                    counts[gram] = counts.get(gram, 0) + 1
            if word:
                gram = word[-1] + "\x01"
                counts[gram] = counts.get(gram, 0) + 1
            word = ""
    code = lambda g: sum(ord(c) << 21 * k for k, c in enumerate(reversed(g)))
    return {code(g): n for g, n in counts.items()}


def test_gram_counts():
    texts = ["Été, the THE\nb2b", "", "12 !", "日本 x", "İstanbul ß" * 3]
    who, code, counts = language.count_grams(texts, np.arange(5))
    for i, text in enumerate(texts):
        ours = dict(zip(code[who == i].tolist(), counts[who == i].tolist(), strict=True))
        assert ours == plain_profile([text])


def test_out_of_place_distance(spark):
    rows = [(1, "aa ab ab abc", "one"), (2, "zz zy zyx", "two"), (3, "ab abc", None), (4, None, "two"), (5, "12 34", "one"), (6, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = language.fit(docs, 5)
    found = {r.doc_id: r for r in language.classify(docs, profiles, 5).collect()}
    assert [found[i].lang_pred for i in range(1, 7)] == ["one", "two", "one", "und", "und", "und"]
    held = {}
    for r in profiles.collect():
        held.setdefault(r.lang, {})[r.gram] = r["rank"]
    counts = plain_profile(["ab abc"])
    # Ties go by the kind of n-gram (one, two, three letters), then by its letters with word ends first.
    kind = lambda c: (c >= 1 << 21) + (c >= 1 << 42)
    order = sorted(counts, key=lambda c: (-counts[c], kind(c), c))[:5]
    distance = sum(abs(held["one"].get(c, 99) - k) if c in held["one"] else 5 for k, c in enumerate(order))
    assert found[3].score == pytest.approx(1 - distance / 25)
    assert all(found[i].score == 0 for i in (4, 5, 6))
    assert all(r.lang_pred == "und" for r in language.classify(docs, profiles.limit(0), 5).collect())
    assert language.classify(empty(spark), profiles, 5).count() == 0


def _marked_field():
    return toxicity.Field({"bad": 9.0, "bad*": 1.0}, -4.0, 0.2, np.array([[0.3, -0.4], [0.1, 0.6]]))


def test_tagging_in_pieces_is_the_field_run_line_by_line(monkeypatch):
    """Whatever is tagged at once, scores and spans are those of every sequence by itself."""
    r = random.Random(8)
    texts = ["\n".join(" ".join(r.choice(["bad", "good", "badly", "x"]) for _ in range(r.randint(0, 300))) for _ in range(r.randint(0, 6)))
             for _ in range(40)] + ["", "bad", "good\n\nbad bad\n"]
    crf = _marked_field()
    great, mass, spans = toxicity.tag(texts, crf)
    for cells in (1, 200, 5000):
        monkeypatch.setattr(toxicity, "CELLS", cells)
        again = toxicity.tag(texts, crf)
        assert np.allclose(again[0], great) and np.allclose(again[1], mass)
        assert [[(a, b) for a, b, _ in s] for s in again[2]] == [[(a, b) for a, b, _ in s] for s in spans]
    for text, g, m, found in zip(texts, great, mass, spans, strict=True):
        every = [toxicity.forward_backward(np.array([[crf.emission(w) for w in s]]), np.array([len(s)]), crf.start, crf.moves)[0][0]
                 for s in toxicity.sequences(text)]
        marked = [p for p, s in zip(every, toxicity.sequences(text), strict=True) if any(crf.emission(w) != crf.bias for w in s)]
        assert g == pytest.approx(max((p.max() for p in every), default=0.0), abs=1e-9)
        assert m == pytest.approx(sum(p.sum() for p in marked), abs=1e-9)
        hits = np.concatenate([p >= 0.5 for p in every]) if every else []
        words = [x.start() for x in re.finditer(r"\S+", text)]
        assert [any(a <= w < b for a, b, _ in found) for w in words] == list(hits)


def test_tagging_takes_little_memory_for_short_lines():
    """Two megabytes of marked lines of one word each: padding must not multiply them."""
    import tracemalloc

    tracemalloc.start()
    great, _, _ = toxicity.tag(["bad\n" * 500_000], _marked_field(), spans=False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert great[0] > 0.5 and peak < 250e6


def test_language_takes_odd_tables(spark):
    """Clashing columns, repeated rows, null ids, a very long text, empty tables."""
    rows = [(1, "la casa es la casa", "es"), (1, "la casa es la casa", "es"), (None, "the house is the house", "en"), (2, "the house", None),
            (2, "the house", None), (None, None, "en"), (3, "la casa " * 400_000, None), (4, "", "es")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)
    docs = docs.withColumns({c: F.lit("clash") for c in ("gram", "rank", "n", "lang_pred", "score", "code")})
    profiles = language.fit(docs)
    found = sorted(((r.doc_id, r.lang_pred) for r in language.classify(docs, profiles).collect()), key=str)
    assert found == sorted([(1, "es"), (1, "es"), (None, "en"), (2, "en"), (2, "en"), (None, "und"), (3, "es"), (4, "und")], key=str)
    assert language.fit(docs.limit(0)).count() == 0
    assert language.classify(docs.limit(0), profiles).count() == 0
    assert {r.lang_pred for r in language.classify(docs, language.fit(docs.limit(0))).collect()} == {"und"}


def test_repeated_labels(spark):
    """Several label rows of a document count as its greatest label, wherever they stand."""
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (2, 0), (3, None), (None, 1)], "doc_id long, quality int")
    rows = quality.labelled(docs, labels, "quality", F.lit(True), 100).collect()
    assert sorted(map(tuple, rows)) == [(1, "a", 1), (2, "b", 0), (2, "b", 0)]
