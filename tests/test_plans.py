from datetime import date

import pytest
from pyspark.sql import functions as F

from foretide.functions import scalars as S
from foretide.operators import keyed as K
from foretide.operators import modelling as G
from foretide.operators import quality as Q
from foretide.operators import splits as T
from foretide.plans import pricing as P
from foretide.sources import documents as J
from foretide.sources import tables as B
from foretide.streaming import refresh as R


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_upserts_are_idempotent(spark):
    old = spark.createDataFrame([("a", "x", 1.0), ("b", "y", 2.0)], "id string, note string, v double")
    new = spark.createDataFrame([("a", "", 3.0), ("c", "z", None)], "id string, note string, v double")
    for once in (K.upsert(old, new, ["id"], ["v"]), K.merge_filled(old, new, ["id"]), K.insert_absent(old, new, ["id"])):
        pass
    for f in (lambda s: K.upsert(s, new, ["id"], ["v"]), lambda s: K.merge_filled(s, new, ["id"]), lambda s: K.insert_absent(s, new, ["id"])):
        assert rows(f(f(old))) == rows(f(old))
    assert rows(K.merge_filled(old, new, ["id"])) == [("a", "x", 3.0), ("b", "y", 2.0), ("c", "z", None)]
    assert rows(K.insert_absent(old, new, ["id"])) == [("a", "x", 1.0), ("b", "y", 2.0), ("c", "z", None)]


def test_snapshot_refresh_is_idempotent(spark):
    day = lambda d, t, p: (date(2024, 1, d), t, float(p))
    kind = "date_snapshot date, team_abbrev string, points double"
    stored = spark.createDataFrame([day(1, "A", 1), day(1, "B", 1), day(2, "A", 1)], kind)
    fresh = spark.createDataFrame([day(2, "A", 5), day(2, "B", 5)], kind)
    once = R.merge_snapshots(stored, fresh, 2)
    assert rows(once) == rows(R.merge_snapshots(once, fresh, 2))
    assert once.count() == 4
    assert R.missing_days(fresh.select("date_snapshot").distinct(), once, 2).count() == 0


def edges(spark, data):
    kind = "bet_id string, player_name string, model_probability double, odds_decimal double, hard_exclude_hot_streak_pre int"
    df = spark.createDataFrame(data, kind)
    return P.load_candidates(df.withColumns(
        {"run_date": F.lit("2024-01-05"), "bet_status": F.lit(""), "implied_probability": 1 / F.col("odds_decimal"),
         "edge_probability": F.col("model_probability") - 1 / F.col("odds_decimal")}))


def test_picks(spark):
    data = [("1", "ann", 0.95, 1.2, 0), ("2", "bob", 0.5, 1.3, 0), ("3", "ann", 0.6, 2.0, 0), ("4", "cyd", 0.9, 2.0, 1), ("5", "dee", 0.4, 3.0, 0)]
    table = edges(spark, data)
    picks = P.daily_picks(table, P.latest_run(table)).orderBy("recommendation_rank").collect()
    assert [p["bet_id"] for p in picks] == ["1", "5"]
    assert all(p["bet_status"] == "pending" for p in picks)
    assert P.daily_picks(table, "2024-01-05", max_picks=0, exclude_hot=False, one_per_player=False).count() == 4
    assert P.daily_picks(table, "2024-01-05", max_picks=1).count() == 1


def test_settling_twice_changes_nothing(spark):
    history = spark.createDataFrame(
        [("a", "2024-01-01", 1, 1, "pending"), ("b", "2024-01-05", 2, 1, "pending"), ("c", "2024-01-01", 3, 1, "pending"), ("d", None, 1, 1, "pending"), ("e", "2024-01-01", 1, 1, "settled")],
        "bet_id string, date_match string, id_match long, id_joueur long, bet_status string",
    ).withColumns({"run_date": F.lit("2024-01-01"), "threshold": F.lit(1.0), "outcome_key": F.lit("1_plus"), "actual_stat_value": F.lit(None).cast("double"),
                   "result": F.lit(""), "settled_at": F.lit("")})
    stats = spark.createDataFrame([(1, 1, date(2024, 1, 1), 2), (2, 1, date(2024, 1, 5), 0)], "id_match long, id_joueur long, date_match date, points int")
    once, settled, unresolved = P.settle(history, stats, "2024-01-05", "now")
    twice = P.settle(once, stats, "2024-01-05", "later")[0]
    assert rows(once.select("bet_id", "result", "bet_status", "settled_at")) == rows(twice.select("bet_id", "result", "bet_status", "settled_at"))
    assert [r[0] for r in rows(settled.select("bet_id"))] == ["a"] and [r[0] for r in rows(unresolved.select("bet_id"))] == ["c"]
    assert once.count() == 5


def test_split_sizes(spark):
    days = spark.createDataFrame([(date(2024, 1, 1 + d),) for d in range(12) for _ in range(d % 3 + 1)], "day date")
    assert {r["split"]: r["days"] for r in T.bounds(T.three_way(days, "day"), "day").collect()} == {"train": 8, "validation": 2, "test": 2}
    with pytest.raises(Q.DataProblem):
        T.three_way(days.filter("day < '2024-01-12'"), "day")


def test_isotonic_and_sigmoid_curves(spark):
    data = [(p / 20, int((p * 7) % 11 < p / 2)) for p in range(1, 20) for _ in range(3)]
    df = spark.createDataFrame(data, "p double, y int")
    # Pool neighbours that break the order: the textbook isotonic fit.
    pools = []
    for p in sorted({p for p, _ in data}):
        ys = [y for q, y in data if q == p]
        pools.append([[p], sum(ys), len(ys)])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2] + last[2]]
    want = {p: min(max(s / n, 1e-6), 1 - 1e-6) for ps, s, n in pools for p in ps}
    got = {r["p"]: r["c"] for r in G.fit_isotonic(df, "p", "y").apply(df, "p", "c").collect()}
    assert got == pytest.approx(want)
    curve = [r["c"] for r in G.fit_sigmoid(df, "p", "y").apply(df, "p", "c").select("p", "c").distinct().orderBy("p").collect()]
    assert curve == sorted(curve) and 0 < curve[0] < curve[-1] < 1


def test_trees_learn_and_score(spark):
    data = [(float(i % 10), None if i % 7 == 0 else float(i % 3), int(i % 10 > 5)) for i in range(300)]
    df = spark.createDataFrame(data, "a double, b double, y int")
    with pytest.raises(Q.DataProblem):
        G.fit_trees(df, ["a", "b"], "y", rounds=3, least_rows=5)
    with pytest.raises(Q.DataProblem):
        G.fit_trees(df.filter("y = 1"), ["a", "b"], "y", rounds=3, least_rows=5, at_least=2)
    model = G.fit_trees(df, ["a", "b"], "y", rounds=3, least_rows=5, at_least=2)
    got = model.score(df, "p").groupBy("y").agg(F.avg("p").alias("p")).collect()
    means = {r["y"]: r["p"] for r in got}
    assert means[1] > 0.6 > 0.4 > means[0]


def test_readers_and_writers(spark, tmp_path):
    path = str(tmp_path / "bets")
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "run_date string, v int")
    B.write_dated(df, path)
    B.write_dated(spark.createDataFrame([("2024-01-02", 3)], "run_date string, v int"), path)
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 3]
    B.write_table(df, str(tmp_path / "csv"), "csv")
    assert [r["v"] for r in B.read_csv(spark, str(tmp_path / "csv"), "run_date string, v int", ["v"]).orderBy("v").collect()] == [1, 2]
    assert B.read_optional(spark, str(tmp_path / "none"), spark.read.parquet) == (None, "file_missing")
    assert B.first_path(spark, [str(tmp_path / "none"), path]) == path
    folder = tmp_path / "landed" / "season=20232024" / "team=BOS"
    folder.mkdir(parents=True)
    (folder / "roster.json").write_text('{"forwards": [{"id": 7, "fullName": "Bo Li", "positionCode": "LW"}, {"id": 8}], "note": "x"}')
    landed = J.read_documents(spark, str(tmp_path / "landed"))
    assert rows(J.roster_players(landed, "team", "season").select("id_joueur", "nom", "position", "id_equipe", "saison")) == [(7, "Bo Li", "L", "BOS", 20232024)]


def test_broken_price_documents_are_refused(spark):
    for text in ('{"bookmaker": "b"}', '{"bookmaker":"b","market":"m","stat":"s","threshold":1,"outcome_label":"o","rows":{"a":1}}', "no json"):
        with pytest.raises(Q.DataProblem):
            B.odds_rows(spark.createDataFrame([(text,)], "d string"), "d")


def test_guards(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, t string")
    with pytest.raises(Q.DataProblem, match="duplicate"):
        Q.require_unique(df, ["k"])
    with pytest.raises(Q.DataProblem, match="missing columns"):
        Q.require_columns(df, ["z"])
    with pytest.raises(Q.DataProblem):
        Q.require_filled(df, ["t"])
    with pytest.raises(Q.DataProblem, match="forbidden"):
        Q.require_no_leak(["a", "points"], ["points"], "y", "d")
    assert Q.with_missing(df, {"n": 0}).columns == ["k", "t", "n"]
    assert Q.rename_legacy(df, {"t": "text", "gone": "x"}).columns == ["k", "text"]
    assert S.fill(df, {"k": 0, "zz": 1}).columns == ["k", "t"]
