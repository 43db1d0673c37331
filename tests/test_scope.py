"""Date range of the first existing table, and the season scope."""

from datetime import date

import pytest

from foretide.operators.quality import DataProblem
from foretide.sources import tables


def test_date_range_falls_back(spark, tmp_path):
    paths = [f"{tmp_path}/base.parquet", f"{tmp_path}/matches.parquet"]
    with pytest.raises(DataProblem):
        tables.first_date_range(spark, paths, spark.read.parquet)
    rows = [("2024-01-05", "1999-01-01"), ("2023-10-10", None), ("later", None), (None, None)]
    spark.createDataFrame(rows, "game_date string, match_date string").write.parquet(paths[1])
    assert tables.first_date_range(spark, paths, spark.read.parquet) == (date(2023, 10, 10), date(2024, 1, 5))
    spark.sql("SELECT DATE '2022-02-03' AS date_match").write.parquet(paths[0])
    assert tables.first_date_range(spark, paths, spark.read.parquet) == (date(2022, 2, 3), date(2022, 2, 3))
    for bad in (spark.createDataFrame([("x",)], "date string"), spark.createDataFrame([("x",)], "day string")):
        with pytest.raises(DataProblem):
            tables.date_range(bad)


def test_season_scope(spark):
    seasons = spark.createDataFrame([("20212022",), ("20222023",), ("20232024",), (None,), ("x",)], "saison string")
    held = lambda *scope: sorted(r.saison for r in tables.seasons_in_scope(seasons, *scope).collect())
    assert held(20222023) == ["20222023", "20232024"]
    assert held(20212022, 20222023) == ["20212022", "20222023"]
    for scope in ((20242025,), (20222023, 20212022)):
        with pytest.raises(DataProblem):
            held(*scope)
