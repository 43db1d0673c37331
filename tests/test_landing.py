"""Landing of files and counted results."""

import pytest

from foretide.operators import quality as Q
from foretide.streaming import landing as N


def test_every_file_lands_once(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for i in range(5):
        (source / f"{i}.json").write_text(f'{{"a":\n{i}}}')
    assert N.land(spark, str(source), path, files=2) == 5
    assert N.land(spark, str(source), path) == 0
    (source / "new.json").write_text("one\ntwo")
    assert N.land(spark, str(source), path) == 1
    rows = N.landed(spark, path).collect()
    assert sorted(r.document for r in rows) == sorted([f'{{"a":\n{i}}}' for i in range(5)] + ["one\ntwo"])
    assert {r.file.rsplit("/", 1)[1] for r in rows} == {"new.json", *[f"{i}.json" for i in range(5)]}


def test_counted_results(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.createDataFrame([(i, "x" * i) for i in range(7)], "i long, t string").repartition(3)
    assert N.write_counted(df, path) == 7
    assert sorted(map(tuple, N.read_counted(spark, path, df.schema).collect())) == [(i, "x" * i) for i in range(7)]
    assert N.write_counted(df.where("i > 3"), path) == 3
    N.read_counted(spark, path, df.schema)
    df.where("i = 0").write.mode("append").json(f"{path}/rows")
    with pytest.raises(Q.DataProblem, match="4 rows"):
        N.read_counted(spark, path, df.schema)
    assert N.write_counted(df.where("false"), path) == 0
    assert N.read_counted(spark, path, df.schema).count() == 0
