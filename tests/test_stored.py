"""Stored keyed tables: results, files that stay, reruns, refusals."""

import random

import pytest
from pyspark.sql import functions as F

from foretide.operators import keyed as K
from foretide.operators import quality as Q
from foretide.sources import stored as B

SCHEMA = "id long, team string, n int, note string"


def rows(seed, ids):
    r = random.Random(seed)
    return [(i, t, r.randint(0, 9), r.choice(["x", "", None, f"note {seed}"])) for i in ids for t in ("a", "b")]


def files(spark, path):
    return set(spark.read.parquet(path).inputFiles())


def held(df):
    return sorted(df.collect(), key=lambda r: (r.id, r.team))


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    B.create(spark.createDataFrame(rows(1, range(200)), SCHEMA), path, ["id", "team"], 16)
    return path


def test_upsert_rewrites_only_what_it_changes(spark, table):
    old = spark.createDataFrame(rows(1, range(200)), SCHEMA)
    batch = spark.createDataFrame([(3, "a", 77, "new"), (500, "c", 1, None)], SCHEMA)
    before = files(spark, table)
    written = B.upsert(table, batch.withColumn("other", F.lit(1)))
    after = files(spark, table)
    assert written <= 2 and len(before - after) <= 2 and len(before & after) >= 14
    assert held(B.read(spark, table)) == held(K.upsert(old, batch, ["id", "team"]))
    assert B.upsert(table, batch) == 0 and files(spark, table) == after


def test_other_merges(spark, table):
    old = spark.createDataFrame(rows(1, range(200)), SCHEMA)
    batch = spark.createDataFrame(rows(2, range(190, 210)), SCHEMA)
    keys = ["id", "team"]
    want = K.insert_absent(old, batch, keys)
    B.insert_absent(table, batch)
    assert held(B.read(spark, table)) == held(want)
    want = K.merge_filled(want, batch, keys)
    B.merge_filled(table, batch)
    assert held(B.read(spark, table)) == held(want)
    change = spark.createDataFrame([(5, "a", 1000), (9999, "a", 1)], "id long, team string, n int")
    want = K.set_where_found(want, change, keys, ["n"])
    assert B.update(table, change, ["n"]) == 1
    assert held(B.read(spark, table)) == held(want)
    assert B.update(table, change, ["n"]) == 0


def test_refusals(spark, table, tmp_path):
    with pytest.raises(Q.DataProblem):
        B.upsert(table, spark.createDataFrame([(None, "a", 1, "")], SCHEMA))
    with pytest.raises(Q.DataProblem):
        B.upsert(table, spark.createDataFrame([(1, 1)], "id long, n int"))
    with pytest.raises(Q.DataProblem):
        B.read(spark, table, ["absent"])
    twice = spark.createDataFrame([(1, "a", 1, ""), (1, "a", 2, "")], SCHEMA)
    with pytest.raises(Q.DataProblem):
        B.create(twice, str(tmp_path / "u"), ["id", "team"])
    with pytest.raises(Q.DataProblem):
        B.merge_filled(table, twice)
    with pytest.raises(Q.DataProblem):
        B.create(twice.withColumn("bucket", F.lit(1)), str(tmp_path / "v"), ["id"])


def test_empty_table_and_empty_batch(spark, tmp_path):
    path, none = str(tmp_path / "e"), spark.createDataFrame([], SCHEMA)
    B.create(none, path, ["id", "team"], 4)
    assert B.read(spark, path).count() == 0
    assert B.upsert(path, none) == 0
    assert B.upsert(path, spark.createDataFrame([(1, "a", 1, "")], SCHEMA)) == 1
    assert B.read(spark, path).count() == 1


def test_snapshot_reader(spark, tmp_path):
    path = str(tmp_path / "s")
    data = [("2024-01-02", " bos ", 1), ("no day", "MTL", 2)]
    B.create(spark.createDataFrame(data, "date_snapshot string, team_abbrev string, points int"), path, ["date_snapshot", "team_abbrev"], 2)
    assert [(str(r.date_snapshot), r.team_abbrev, r.points) for r in B.read_snapshots(spark, path).collect()] == [("2024-01-02", "BOS", 1)]
