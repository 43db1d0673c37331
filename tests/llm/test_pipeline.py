"""Registered queries and the corpus pipeline."""

import random
import re

import __spark_entry__
import corpus_pipeline
import numpy as np
from cases import documents
from oracle import connect, differences
from test_models import labelled_corpus
from test_strings import plain_classes, plain_lines, plain_removed
from test_tokens import PATH, plain_best_fit
from tokenizers import Tokenizer

from foretide.llm import lines, suffix
from foretide.llm.common import BATCH_ROWS

FOLDER = "/root/testdata/sf0.01"


def test_names():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    assert sorted(int(m[1]) for m in (re.match(r"op(\d+)_", n) for n in names) if m) == list(range(1, 14))


def test_lines_query_against_sql(spark):
    run, sql = __spark_entry__.queries()["op4_lines"], __spark_entry__.oracle_sql()["op4_lines"]
    assert not differences(spark, connect(FOLDER), "op4_lines", run, sql, FOLDER)


def corpus(spark):
    rows, labels = labelled_corpus(spark)
    r = random.Random(9)
    passage = " ".join(f"p{r.randrange(90)}" for _ in range(60))
    for k in range(1, 400, 7):
        rows[k] = (rows[k][0], rows[k][1] + "\n" + passage + " " + str(k))
    rows += [(500, rows[3][1]), (501, rows[4][1] + " end"), (502, None), (503, ""), (504, rows[7][1].upper())]
    long = [f"n{r.randrange(500)}" for _ in range(200)]
    other = ["changed" if k in (50, 150) else w for k, w in enumerate(long)]
    rows += [(k, " ".join(w[:100]) + "\n" + " ".join(w[100:])) for k, w in ((505, long), (506, other))]
    return rows, labels


def test_whole_pipeline_against_brute_force(spark, tmp_path):
    rows, labels = corpus(spark)
    docs = documents(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    held = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, held, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        held = spark.read.parquet(f"{tmp_path}/{name}")
        assert held.columns == docs.columns and held.dtypes == docs.dtypes, name
    left = [(i, t) for i, t in rows if i >= 500 or i % 5]  # toxic documents are those with i % 5 == 0
    gone = plain_lines(left, lines.RUN_LINES, lines.ALONE_WORDS)
    cut = [(i, t, [x for x, g in zip((t or "").split("\n"), gone[i, t or ""], strict=True) if not g]) for i, t in left]
    left = [(i, "\n".join(x) if len(x) < len((t or "").split("\n")) else t) for i, t, x in cut if x]
    class_ = plain_classes(left)
    left = [(i, t) for i, t in left if class_[i] == i]
    kept = []
    for (i, b, mask), (_, t) in zip(plain_removed(left), left, strict=True):
        text = np.frombuffer(b, np.uint8)[~mask].tobytes().decode("utf-8", "ignore")
        if not mask.any():
            kept.append((i, t))
        elif text:
            kept.append((i, text))
    assert sorted((r.doc_id, r.text or "") for r in held.collect()) == sorted((i, t or "") for i, t in kept)
    assert {500, 506}.isdisjoint(i for i, _ in kept) and {502, 503, 505} <= {i for i, _ in kept}
    library = Tokenizer.from_file(PATH)
    sizes = {i: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in kept}
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.doc_tokens for r in packed} == sizes
    used = {}
    for r in packed:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert sorted(1024 - u for u in used.values()) == plain_best_fit([r.length for r in packed], 1024)


def test_empty_pipeline(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_tasks_of_the_pipeline_hold_little(spark, tmp_path):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    rows, labels = corpus(spark)
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = documents(spark, rows)
    try:
        for wanted, held in (("10000", BATCH_ROWS), ("0", BATCH_ROWS), ("100", 100)):
            spark.conf.set(name, wanted)
            found = corpus_pipeline.without_repeated_strings(spark, docs, str(tmp_path))
            assert int(spark.conf.get(name)) == held
        # One Python worker for each task: the one that removes bytes also decodes what stays.
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "FlatMapCoGroupsInArrow" in plan and "MapInArrow" not in plan
    finally:
        spark.conf.set(name, before)


def test_readable_text_drops_broken_characters(spark):
    passage = "".join(chr(97 + k % 26) + str(k) for k in range(30))
    # é and è begin with the same byte.
    rows = [(1, passage + "é"), (2, "x" + passage + "èz"), (3, None), (4, "ö" * 60), (5, "ö" * 40 + "o")]
    docs = documents(spark, rows)
    bytes_, text = ({r.doc_id: r.kept for r in suffix.removed(docs, readable=x).collect()} for x in (False, True))
    assert text == {i: bytes(b).decode("utf-8", "ignore") for i, b in bytes_.items()}
    assert any(bytes(b).decode("utf-8", "replace") != text[i] for i, b in bytes_.items())
