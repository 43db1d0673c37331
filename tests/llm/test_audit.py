"""The filter audit against a plain version, over tables of many files in any order."""

import random
import re
from itertools import permutations

import oracle
import pytest
from cases import empty, texts

from foretide.llm import audit, queries


def fails(rows, i):
    doc_id, text, *_ = rows[i]
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = ""
    if len(words) < 50:
        found += "A"
    if 100 * len(set(words)) < 65 * len(words):
        found += "B"
    if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
        found += "C"
    if re.search("[#$%&*|]", text):
        found += "D"
    if doc_id is not None and any(o is not None and o < doc_id and (t or "") == text for o, t, *_ in rows):
        found += "E"
    return found


def plain(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    held = [(r[2] or "", fails(rows, i), r[0] in good, r[0] in toxic) for i, r in enumerate(rows)]
    out, shapley = {}, {}
    for part in {h[0] for h in held}:
        mine = [h for h in held if h[0] == part]
        for order in permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                kept = [h for h in left if f not in h[1]]
                gone = [h for h in left if f in h[1]]
                every = sum(f in h[1] for h in mine)
                out[part, "".join(order), k + 1] = (
                    len(kept), len(gone), every - len(gone), sum(h[1] == f for h in mine), sum(h[2] for h in gone), sum(h[3] for h in gone), f)
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
                left = kept
    return {k: (*v[:6], shapley[k[0], v[6]]) for k, v in out.items()}


def found(spark, folder, labels, files):
    rows = audit.interactions(audit.counters(spark, folder, labels, files)).collect()
    out = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows}
    assert len(out) == len(rows)
    return out


def tables(spark, path, seed, clash=True):
    """Copies of one text under falling and rising ids in several files, odd texts, null ids, sources and labels."""
    r = random.Random(seed)
    rows = [(i, t) for i, t in texts(seed, 12)]
    shared = ["copy " * 60, "UPPER Case # text", "", None, "a b c"]
    rows += [(r.randint(0, 90), r.choice(shared)) for _ in range(60)] + [(None, "a b c"), (None, "a b c"), (7, "a b c"), (7, "a b c")]
    r.shuffle(rows)
    rows = [(i, t, r.choice(["s1", "s2", None])) for i, t in rows]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(0, 100, 2)] + [(4, 1, 1), (None, 1, 1)]
    docs = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    if clash:
        docs = docs.selectExpr("*", "'clash' AS part", "'clash' AS mask", "'clash' AS key", "'clash' AS good", "'clash' AS range")
    for k in range(5):  # five files, each with its own rows
        docs.where(f"pmod(xxhash64(doc_id, text, source), 5) = {k}").coalesce(1).write.mode("append").parquet(path)
    return rows, labels, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("files", [1, 2, 100])
def test_audit_in_micro_batches(spark, tmp_path, files):
    rows, labels, flagged = tables(spark, str(tmp_path / "d"), files)
    assert found(spark, str(tmp_path / "d"), flagged, files) == plain(rows, labels)


def test_one_file_and_no_labels(spark, tmp_path):
    rows = [(3, "x", "s"), (1, "x", "s"), (2, "x", "t")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).write.parquet(str(tmp_path / "d"))
    file = next((tmp_path / "d").glob("part-*.parquet"))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert found(spark, str(file), none, None) == plain(rows, [])


def test_empty(spark, tmp_path):
    empty(spark).write.parquet(str(tmp_path / "d"))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert found(spark, str(tmp_path / "d"), none, None) == {}


def test_gathered_counts_do_not_depend_on_where_they_are_cut(spark, tmp_path, monkeypatch):
    """Copies of one text in one task give few rows, whatever their number."""
    import pyarrow as pa

    n = 5000
    r = random.Random(1)
    ids = [r.randint(0, 400) for _ in range(n)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([b"k"] * n), pa.array([3] * n, pa.int32()), pa.array(ids), pa.array(["p"] * n), pa.array([False] * n), pa.array([True] * n)],
        ["key", "mask", "doc_id", "part", "good", "toxic"])
    (out,) = list(audit._gather(iter([batch])))
    assert out.to_pylist() == [{"key": b"k", "mask": 3, "low": min(ids), "part": "p", "good": False, "toxic": True,
                                "at_low": ids.count(min(ids)), "above": n - ids.count(min(ids)), "apart": 0}]


def test_query_matches_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert oracle.differences(spark, oracle.connect(folder), "op13_filter_audit", queries.op13_filter_audit, queries.AUDIT_SQL, folder) == []
