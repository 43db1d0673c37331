"""Work that must grow no faster than its input."""

import datetime
import threading

import pytest
from pyspark.sql import functions as F
from test_timeline import season, standings

from foretide.operators import modelling as G
from foretide.plans import catalogue
from foretide.plans import features as P
from foretide.plans import pricing as V
from foretide.plans import slate as X
from foretide.session import spread

catalogue.load()


def _slate(spark, day, games):
    return spark.createDataFrame([(g, day, "20232024", home, away, "FUT") for g, home, away in games],
                                 "id_match long, date_match date, saison string, id_equipe_domicile string, id_equipe_exterieur string, status string")


def test_a_history_goes_through_the_windows_once(spark, monkeypatch):
    past = P.canonical_base(season(spark)).filter("id_match < 113")
    day = past.select(F.max("date_match")).first()[0]  # players also have a match on the day itself
    games = [(50, "BOS", "MTL"), (201, "BOS", "MTL"), (202, "TOR", "BOS"), (203, "BOS", "TOR")]
    people = spark.createDataFrame([(0, "A", "C"), (1, "B", "D"), (2, "C", "LW")], "id_joueur long, nom string, position string")
    seen, real = [], P.temporal_features

    class Enough(Exception):
        pass

    def count(df, hot=None):
        seen.append(df.count())
        raise Enough

    later = day + datetime.timedelta(2)
    pool = X.player_pool(past, people, str(later), X.slate_sides(_slate(spark, later, games))).filter("team_player_match = 'BOS'")
    players, history = pool.count(), past.join(pool, "id_joueur", "left_semi").count()
    assert players
    monkeypatch.setattr(P, "temporal_features", count)
    for when in (later, day):
        with pytest.raises(Enough):
            X.slate_features(past, None, _slate(spark, when, games), pool, standings(spark))
    assert seen == [history + players, 4 * (history + players)]
    # A row to come sees what the id of its match places before it, and no other row to come.
    monkeypatch.setattr(P, "temporal_features", real)
    got = X.slate_features(past, None, _slate(spark, day, games), pool, standings(spark)).select("id_match", "id_joueur", "nb_matchs_avant_match").collect()
    mine = {r.id_joueur: r.n for r in past.join(pool, "id_joueur", "left_semi").groupBy("id_joueur").agg(F.count("*").alias("n")).collect()}
    assert sorted(got) == sorted((g, j, n - (g == 50)) for j, n in mine.items() for g in (50, 201, 202, 203))


def _tables(spark, folder):
    day = F.date_add(F.lit("1999-10-01").cast("date"), (F.col("id") * 9).cast("int"))
    orders = spark.range(1, 41).select(F.col("id").alias("o_orderkey"), (F.col("id") % 3).alias("o_custkey"), day.cast("timestamp").alias("o_orderdate"))
    lines = spark.range(160).select((F.col("id") % 40 + 1).alias("l_orderkey"), F.floor(F.col("id") / 40).alias("l_suppkey"), (F.col("id") % 50).cast("double").alias("l_quantity"))
    orders.write.parquet(f"{folder}/orders.parquet")
    lines.write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["season_blend_and_gap", "absence_episodes", "opponent_history"])
def test_players_are_counted_before_any_window(spark, tmp_path, monkeypatch, name):
    def again(df, keys):
        raise AssertionError(f"{keys} counted behind a window")

    monkeypatch.setattr("foretide.plans.features.find_hot", again)
    monkeypatch.setattr("foretide.operators.timeline.find_hot", again)
    monkeypatch.setattr("foretide.operators.ordered.find_hot", again)
    assert catalogue.QUERIES[name](spark, _tables(spark, tmp_path)).count() == 160


def test_tasks_keep_their_size(spark):
    spark.conf.set("foretide.task.rows", "10")
    try:
        rows = spark.range(500)
        assert spread(rows, ["id"], 500).rdd.getNumPartitions() == 50
        assert spread(rows, ["id"], 50) is rows
    finally:
        spark.conf.unset("foretide.task.rows")


def test_partitions_that_adaptive_execution_joins_are_not_counted_on(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("foretide.task.rows", "10")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        assert spread(spark.range(500), ["id"], 500).rdd.getNumPartitions() == 50
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("foretide.task.rows")


def test_variants_are_fitted_side_by_side(spark, monkeypatch):
    both = threading.Barrier(2, timeout=60)

    class Model:
        def score(self, rows):
            return rows.withColumn("proba_point_1p_raw", F.lit(0.5))

    def fit(train, usable, *_, **__):
        both.wait()  # breaks when the other fit has not begun
        return Model()

    monkeypatch.setattr(G, "fit_trees", fit)
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 20).cast("int")).alias("date_match")
    rows = spark.range(60).select(F.col("id").alias("id_match"), F.col("id").alias("id_joueur"), day,
                                  (F.col("id") % 2).cast("int").alias("a_marque_un_point"), F.rand(1).alias("x"), F.rand(2).alias("y"))
    table, scored = G.train_variants(rows, "date_match", {"one": ["x"], "two": ["x", "y"]})
    assert sorted((r.model_variant, r.split, r.rows) for r in table.collect()) == [(n, s, 9) for n in ("one", "two") for s in ("test", "validation")]
    assert list(scored) == ["one", "two"]


def test_picks_are_worked_out_once_for_their_display(spark):
    seen = spark.sparkContext.accumulator(0)
    rows = [(f"b{i}", "2024-01-05", f"p{i}", 2.0, 0.5, 0.6 + i / 100, 0.1) for i in range(12)]

    def counted(row):
        seen.add(1)
        return row

    candidates = spark.createDataFrame(
        spark.sparkContext.parallelize(rows, 2).map(counted),
        "bet_id string, run_date string, player_name string, odds_decimal double, implied_probability double, model_probability double, edge_probability double",
    ).withColumns({c: F.lit("x") for c in ("bet_status", "date_match", "team", "opponent", "market")})
    for most in (10, 0):
        before = seen.value
        shown = V.daily_display(V.daily_picks(V.load_candidates(candidates), "2024-01-05", max_picks=most)).collect()
        assert [r.player_name for r in sorted(shown, key=lambda r: r.display_rank)] == [f"p{i}" for i in range(11, 11 - (most or 12), -1)]
        assert seen.value - before == 12


def test_copies_are_sorted_out_once_for_all_features(spark):
    """Matches and windows read the base as written; nothing behind it drops copies again."""
    def text(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    fused = season(spark)
    assert "__ord_rank" in text(P.canonical_base(fused, check=False))
    out = P.all_features(fused, None, check=False)
    assert "__ord_rank" not in text(out)
    assert out.count() == P.canonical_base(fused, check=False).count()
