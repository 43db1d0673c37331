"""Profiles, counts of dropped rows and the check for matches without rows."""

import random

import pytest
from pyspark.sql import functions as F

from foretide.operators import quality as Q


def table(spark):
    r = random.Random(4)
    rows = [(i, r.randint(0, 4000), r.choice("abcde"), None if i % 9 == 0 else r.gauss(0, 1)) for i in range(30_000)]
    return spark.createDataFrame(rows, "id long, k int, t string, x double").repartition(4), rows


def test_sketch_is_near_the_exact_profile(spark):
    df, rows = table(spark)
    exact = {r.column: r for r in Q.profile(df, ["id", "k", "t", "x"]).collect()}
    sketch = {r.column: r for r in Q.profile(df, ["id", "k", "t", "x"], exact=False, quantiles=[0.1, 0.5, 0.9]).collect()}
    for i, c in enumerate(["id", "k", "t", "x"]):
        values = [r[i] for r in rows if r[i] is not None]
        assert (exact[c].rows, exact[c].filled, exact[c].distinct_values) == (len(rows), len(values), len(set(values)))
        assert (exact[c].rows, exact[c].filled, exact[c].least, exact[c].greatest) == (
            sketch[c].rows, sketch[c].filled, sketch[c].least, sketch[c].greatest)
        assert sketch[c].distinct_values == pytest.approx(len(set(values)), rel=0.08)
        if c == "t":
            assert sketch[c].quantiles is None
            continue
        values.sort()
        for q, got in zip([0.1, 0.5, 0.9], sketch[c].quantiles, strict=True):  # rank error within 0.5 %
            assert values[int((q - 0.005) * len(values))] <= got <= values[int((q + 0.005) * len(values))]


def test_sketch_is_one_scan_without_expand(spark, tmp_path):
    table(spark)[0].write.parquet(str(tmp_path / "t"))
    plan = Q.profile(spark.read.parquet(str(tmp_path / "t")), ["id", "k", "t"], exact=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Expand" not in plan


def test_profile_of_an_empty_table(spark):
    df = table(spark)[0].where(F.lit(False))
    for exact in (True, False):
        assert [(r.rows, r.filled, r.distinct_values, r.least) for r in Q.profile(df, ["k", "t"], exact).collect()] == [(0, 0, 0, None)] * 2


def test_dropped_counts(spark):
    rows = [(1, "a", "x"), (1, "a", "x"), (None, "a", "x"), (2, None, "x"), (3, "b", None), (4, None, None)]
    dropped = Q.Dropped()
    df = dropped.unkeyed(spark.createDataFrame(rows, "k int, a string, b string"), ["k"]).dropDuplicates(["k"])
    assert dropped.unplaced(df, ["a", "b"]).count() == 1
    assert dropped.counts == {"rows": 6, "unkeyed": 1, "copies": 1, "unplaced": 3, "kept": 1, "without_a": 2, "without_b": 2}


def test_groups_without_rows_are_refused(spark):
    games = spark.createDataFrame([(i,) for i in range(5)], "id_match int")
    rows = games.where("id_match <> 3").crossJoin(spark.range(2))
    with pytest.raises(Q.DataProblem, match="3"):
        Q.require_members(games, rows, "id_match", "players")
    assert Q.require_members(games.where("id_match <> 3"), rows, "id_match").count() == 4
