import random
from datetime import date, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from foretide import fixed
from foretide.operators import timeline as T
from foretide.operators.ordered import HotKeys, find_hot
from foretide.plans import features as P
from foretide.plans import slate as X

NAMES = ("longest", "longest_miss", "long_runs", "rows")


def rescan(history, season):
    """Direct scan over the earlier rows of this and the last season."""
    run = miss = top = top_miss = long_runs = n = 0
    for s, hit in history:
        if s < season - 1:
            continue
        n += 1
        run, miss = (run + 1, 0) if hit else (0, miss + 1)
        top, top_miss = max(top, run), max(top_miss, miss)
        long_runs += run == 5
    return top, top_miss, long_runs, n


@pytest.mark.parametrize("hot", [False, True])
def test_two_season_streaks_match_a_rescan(spark, tiny_keys, hot):
    rng = random.Random(11)
    data, expected = [], {}
    for player in range(6):
        history, season = [], 2018
        for i in range(rng.choice([1, 40, 90])):
            season += rng.choice([0] * 12 + [1, 2])
            hit = int(rng.random() < 0.7)
            expected[(player, i)] = rescan(history, season)
            history.append((season, hit))
            data.append((player, i, season, hit, "x"))
    df = spark.createDataFrame(data, "p int, i int, s int, hit int, extra string")
    keys = find_hot(df, ["p"]) if hot else HotKeys(("p",))
    assert bool(keys.found) == hot
    got = T.two_season_streaks(df, ["p"], ["i"], "s", "hit", NAMES, 5, keys)
    assert {(r["p"], r["i"]): tuple(r[n] for n in NAMES) for r in got.collect()} == expected


@pytest.mark.parametrize("hot", [False, True])
def test_current_streaks_and_runs(spark, tiny_keys, hot):
    rng = random.Random(12)
    data = [(k, i, int(rng.random() < 0.6)) for k in range(3) for i in range(50 if k else 5)]
    df = spark.createDataFrame(data, "k int, i int, hit int")
    keys = find_hot(df, ["k"]) if hot else HotKeys(("k",))
    out = T.current_streaks(df, ["k"], ["i"], "hit", "hits", "misses", keys)
    out = T.run_since(out, ["k"], ["i"], F.col("hit") == 1, "since", keys)
    state = {}
    for r in sorted(out.collect(), key=lambda r: (r["k"], r["i"])):
        hits, misses = state.get(r["k"], (0, 0))
        assert (r["hits"], r["misses"]) == (hits, misses)
        state[r["k"]] = (hits + 1, 0) if r["hit"] else (0, misses + 1)
        assert r["since"] == state[r["k"]][1]


def test_as_of_uses_the_latest_earlier_snapshot(spark, tiny_keys):
    rng = random.Random(13)
    start = date(2024, 1, 1)
    left = [(rng.choice("ABC"), start + timedelta(rng.randrange(60)), i) for i in range(120)]
    right = sorted({(rng.choice("ABD"), start + timedelta(rng.randrange(60))) for _ in range(50)})
    right = [(t, d, float(i)) for i, (t, d) in enumerate(right)]
    got = T.as_of(
        spark.createDataFrame(left, "team string, day date, i int"),
        spark.createDataFrame(right, "team string, seen date, points double"),
        "team", "day", "seen", ["points", "seen"], "_pre",
    ).toPandas().sort_values("i")
    a = pd.DataFrame(left, columns=["team", "day", "i"]).assign(day=lambda x: pd.to_datetime(x["day"])).sort_values("day")
    b = pd.DataFrame(right, columns=["team", "seen", "points"]).assign(seen=lambda x: pd.to_datetime(x["seen"])).sort_values("seen")
    want = pd.merge_asof(a, b, left_on="day", right_on="seen", by="team").sort_values("i")
    assert got["points_pre"].fillna(-1).tolist() == want["points"].fillna(-1).tolist()


def season(spark, n=14, players=3, seed=7, poison=None):
    """Fused rows of a small league; `poison` overwrites the results from that match on."""
    rng = random.Random(seed)
    rows = []
    for m in range(n):
        day = date(2022, 10, 1) + timedelta(m * 2 + (14 if m > n // 2 else 0) + (300 if m > n - 5 else 0))
        code = "20222023" if day < date(2023, 7, 1) else "20232024"
        for p in range(players):
            home = p % 2
            points = rng.choice([0, 0, 1, 2])
            toi = rng.choice(["12:30", "18:05", None])
            if poison is not None and m >= poison:
                points, toi = 9, "59:59"
            rows.append((p, 100 + m, str(day), code, "BOS" if home else "MTL", "MTL" if home else "BOS", home, points, 0, points, 3, toi,
                         "01:10", "BOS", "MTL", m % 4, 1, 1, True, True))
    names = ("id_joueur long, id_match long, date_match string, season_source string, team_player_match string, adversaire_match string, "
             "is_home_player int, buts int, passes int, points int, tirs int, temps_de_glace string, temps_pp string, id_equipe_domicile string, "
             "id_equipe_exterieur string, buts_domicile int, buts_exterieur int, match_trouve int, check_team_ok boolean, check_opp_ok boolean")
    return spark.createDataFrame(rows, names).withColumns({"plus_moins": F.lit(0), "penalty_minutes": F.lit(0)})


def standings(spark):
    rows = [("2022-10-04", "BOS", "E", "E1", 2.0, 80.0, 4.0, 1.0, 1.0), ("2022-10-04", "MTL", "E", "E1", 2.0, 80.0, 0.0, 2.0, 2.0)]
    names = ("date_snapshot string, team_abbrev string, conference_abbrev string, division_abbrev string, games_played double, games_remaining double, "
             "points double, conference_sequence double, division_sequence double")
    extra = {c: F.lit(1.0) for c in ("wildcard_sequence", "point_pctg", "goal_differential", "l10_points")}
    return spark.createDataFrame(rows, names).withColumns(extra)


OWN = {"buts", "passes", "points", "tirs", "temps_de_glace", "temps_pp", "a_marque_un_point", "a_marque_un_but", "diff_buts_equipe",
       "plus_moins", "penalty_minutes", "victoire_equipe", "defaite_equipe", "buts_match_equipe", "buts_match_adversaire", "buts_domicile", "buts_exterieur"}


def table(df, drop=OWN):
    keep = sorted(c for c in df.columns if c not in drop)
    tidy = lambda v: round(v, 9) if isinstance(v, float) else v
    return {(r["id_joueur"], r["id_match"]): tuple(tidy(r[c]) for c in keep) for r in df.collect()}


def test_later_results_do_not_reach_earlier_features(spark):
    clean = table(P.all_features(season(spark), standings(spark)))
    spoilt = table(P.all_features(season(spark, poison=6), standings(spark)))
    assert len(clean) == 42
    assert {k: v for k, v in clean.items() if k[1] <= 106} == {k: v for k, v in spoilt.items() if k[1] <= 106}
    assert clean != spoilt


def test_player_features_on_split_players(spark, tiny_keys):
    base = P.canonical_base(season(spark, n=24))
    hot = find_hot(base, ["id_joueur"])
    assert hot.found == 3 and hot.total == 72
    for block in (P.player_form, P.season_to_date):
        assert table(block(base, hot)) == table(block(base, HotKeys(("id_joueur",))))


def test_streak_output_can_be_counted_by_player(spark):
    out = P.streaks(P.canonical_base(season(spark, n=4)))
    assert {r["count"] for r in out.groupBy("id_joueur").count().collect()} == {4}


def test_snapshot_of_the_same_day_is_not_used(spark):
    out = {r["id_match"]: r for r in P.all_features(season(spark), standings(spark)).filter("id_joueur = 1").collect()}
    days = {m: str(r["date_match"]) for m, r in out.items()}
    assert [out[m]["standings_context_found"] for m in sorted(out)][:4] == [int(days[m] > "2022-10-04") for m in sorted(days)][:4]


def test_slate_rows_get_the_features_they_have_once_played(spark):
    fused = season(spark)
    base = P.canonical_base(fused)
    last = 113
    day = base.filter(f"id_match = {last}").select(F.max("date_match")).first()[0]
    want = table(P.all_features(fused, standings(spark)).filter(f"id_match = {last}"),
                 OWN | {"match_trouve", "check_home_team_context_ok"})
    past = base.filter(f"id_match < {last}")
    ahead = spark.createDataFrame([(last, day, "20232024", "BOS", "MTL", "FUT")],
                                  "id_match long, date_match date, saison string, id_equipe_domicile string, id_equipe_exterieur string, status string")
    people = spark.createDataFrame([(0, "A", "C"), (1, "B", "D"), (2, "C", "LW")], "id_joueur long, nom string, position string")
    pool = X.player_pool(past, people, str(day), X.slate_sides(ahead))
    got = X.slate_features(past, ahead, ahead, pool, standings(spark)).filter(f"id_match = {last}")
    got = table(got.drop("nom", "position", "days_since_last_game"), OWN | {"match_trouve", "check_home_team_context_ok"})
    assert got == want


def test_known_rates_stand_in_for_each_other(spark):
    base = P.canonical_base(season(spark, n=2))
    out = P.expectations(P.absences(P.opponent_history(P.temporal_features(base))), known_only=True)
    rows = {(r["id_joueur"], r["id_match"]): r for r in out.collect()}
    first, second = rows[(1, 100)], rows[(1, 101)]
    assert first["point_hit_rate_weighted_pre"] is None
    assert second["point_hit_rate_weighted_pre"] == float(first["a_marque_un_point"])


def test_bad_fused_rows_are_refused(spark):
    from foretide.operators.quality import DataProblem

    with pytest.raises(DataProblem, match="team_differs"):
        P.canonical_base(season(spark).withColumn("check_team_ok", F.lit("no")))


def test_feature_lists_are_built(spark):
    columns = set(P.all_features(season(spark), standings(spark)).columns) | {"saison"}
    assert set(fixed.ENRICHED_FEATURES) <= columns
    assert not set(fixed.ENRICHED_FEATURES) & set(fixed.FORBIDDEN_FEATURES)
