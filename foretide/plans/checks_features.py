"""Queries for the canonical base, every window feature, team form, standings and the slate."""

from __future__ import annotations

from pyspark.sql import functions as F

from foretide import fixed
from foretide.functions import scalars as S
from foretide.operators import metrics as M
from foretide.operators import quality as Q
from foretide.operators import timeline as T
from foretide.operators.ordered import find_hot
from foretide.plans import features as P
from foretide.plans import league as L
from foretide.plans import league_sql as D
from foretide.plans import slate as X
from foretide.plans.catalogue import Shape, query
from foretide.session import spread, stable, written


def base(spark, folder):
    return P.canonical_base(L.fused(spark, folder), check=False)


def timelines(spark, folder):
    """The base, written once, and the players with too many rows for one task: every window reads these rows."""
    rows = written(base(spark, folder))
    return spread(rows, [P.PLAYER], rows.count()), find_hot(rows, [P.PLAYER])


# ------------------------------------------------------------------ base

_fused = Shape(whole="rows matched team_differs opponent_differs home_rows")


@query(
    "fused_join_checks",
    f"WITH {D.BASE} SELECT {_fused.sql} FROM (SELECT count(*) AS rows, count(*) AS matched, 0 AS team_differs, 0 AS opponent_differs, "
    "sum(is_home_player) AS home_rows FROM base)",
)
def fused_join_checks(spark, folder):
    bad = P.fused_violations()
    found = L.fused(spark, folder).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_merge") == "both").alias("matched"),
        F.count_if(bad["team_differs"]).alias("team_differs"), F.count_if(bad["opponent_differs"]).alias("opponent_differs"),
        F.sum("is_home_player").alias("home_rows"),
    )
    return _fused.of(found)


_faults = Shape(whole="rows matched unknown team_differs opponent_differs")


@query(
    "fused_join_faults",
    f"""WITH {D.BASE}, f AS (SELECT id_match % 13 = 5 AS gone, id_match % 17 = 3 AS swapped, id_match % 19 = 2 AS misnamed FROM base)
    SELECT {_faults.sql} FROM (SELECT count(*) AS rows, count(*) FILTER (NOT gone) AS matched, count(*) FILTER (gone) AS unknown,
      count(*) FILTER (gone OR swapped) AS team_differs, count(*) FILTER (gone OR swapped OR misnamed) AS opponent_differs FROM f)""",
)
def fused_join_faults(spark, folder):
    """Player rows of unknown matches, with both teams swapped, and with a wrong opponent."""
    games = L.matches(spark, folder)
    swapped, misnamed = F.col("id_match") % 17 == 3, F.col("id_match") % 19 == 2
    team, other = F.col("team_player_match"), F.col("adversaire_match")
    rows = L.stats(spark, folder, games).withColumns({
        "team_player_match": F.when(swapped, other).otherwise(team),
        "adversaire_match": F.when(swapped, team).when(misnamed, "???").otherwise(other),
    })
    fused = P.fused_base(rows, games.filter(F.col("id_match") % 13 != 5))
    bad = P.fused_violations()
    return _faults.of(fused.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_merge") == "both").alias("matched"), F.count_if(bad["match_missing"]).alias("unknown"),
        F.count_if(bad["team_differs"]).alias("team_differs"), F.count_if(bad["opponent_differs"]).alias("opponent_differs"),
    ))


_dropped = Shape(whole="rows unkeyed copies unplaced without_team_player_match without_season_source kept")


@query(
    "dropped_rows",
    f"""WITH {D.BASE}, f AS (SELECT CASE WHEN id_match % 50 = 1 THEN NULL ELSE id_joueur END AS id_joueur, id_match,
      id_match % 31 = 4 AS no_team, id_joueur % 37 = 5 AS no_season FROM base),
    e AS (SELECT * FROM f UNION ALL SELECT * FROM f WHERE id_match % 20 = 3),
    k AS (SELECT id_joueur, id_match, any_value(no_team) AS no_team, any_value(no_season) AS no_season FROM e WHERE id_joueur IS NOT NULL GROUP BY 1, 2),
    c AS (SELECT (SELECT count(*) FROM e) AS rows, (SELECT count(*) FROM e WHERE id_joueur IS NULL) AS unkeyed, count(*) AS single,
      count(*) FILTER (no_team OR no_season) AS unplaced, count(*) FILTER (no_team) AS without_team_player_match,
      count(*) FILTER (no_season) AS without_season_source FROM k),
    d AS (SELECT *, rows - unkeyed - single AS copies, single - unplaced AS kept FROM c) SELECT {_dropped.sql} FROM d""",
)
def dropped_rows(spark, folder):
    """What the base leaves out of rows without player, with a key twice, without team or season, counted on the way."""
    rows = L.fused(spark, folder).withColumns({
        "team_player_match": F.when(F.col("id_match") % 31 != 4, F.col("team_player_match")),
        "season_source": F.when(F.col("id_joueur") % 37 != 5, F.col("season_source")),
        "id_joueur": F.when(F.col("id_match") % 50 != 1, F.col("id_joueur")),
    })
    dropped = Q.Dropped()
    stable(P.canonical_base(rows.unionByName(rows.filter("id_match % 20 = 3")), check=False, dropped=dropped))
    counts = dropped.counts
    return _dropped.of(spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts)))


_unplayed = Shape(whole="id_match")


@query("played_without_rows", f"WITH {D.BASE}, m AS (SELECT id_match FROM matches WHERE buts_domicile IS NOT NULL AND buts_exterieur IS NOT NULL AND id_match NOT IN (SELECT id_match FROM base)) SELECT {_unplayed.sql} FROM m")
def played_without_rows(spark, folder):
    """Played matches that no player row belongs to: what the blocking check refuses."""
    games = L.matches(spark, folder)
    return _unplayed.of(Q.missing_from(X.played_matches(games), L.stats(spark, folder, games), "id_match"))


_base = Shape(
    whole="id_joueur id_match season_start_year is_home_player a_marque_un_point a_marque_un_but victoire_equipe defaite_equipe",
    real="buts passes points tirs temps_de_glace temps_pp diff_buts_equipe buts_match_equipe buts_match_adversaire",
    text="date_match season_source team_player_match adversaire_match",
)


@query(
    "canonical_base",
    f"""WITH {D.BASE}, own AS (SELECT *, CASE WHEN is_home_player = 1 THEN buts_domicile ELSE buts_exterieur END AS buts_match_equipe,
    CASE WHEN is_home_player = 1 THEN buts_exterieur ELSE buts_domicile END AS buts_match_adversaire FROM base),
    outcome AS (SELECT *, buts_match_equipe - buts_match_adversaire AS diff_buts_equipe,
    CAST(buts_match_equipe > buts_match_adversaire AS INT) AS victoire_equipe, CAST(buts_match_equipe < buts_match_adversaire AS INT) AS defaite_equipe FROM own)
    SELECT {_base.sql} FROM outcome""",
)
def canonical_base(spark, folder):
    return _base.of(P.canonical_base(L.fused(spark, folder)))


_pp = Shape(whole="id_joueur id_match", real="temps_pp")


@query(
    "power_play_join",
    f"WITH {D.BASE} SELECT {Shape(whole='id_joueur id_match').sql}, "
    "round(CASE WHEN id_match % 3 = 0 THEN (id_match % 300) / 60.0::DOUBLE ELSE temps_pp END + 1e-9, 6) AS temps_pp FROM base",
)
def power_play_join(spark, folder):
    """Official times (seconds as text) for a third of the matches replace the box score's clock."""
    fused = L.fused(spark, folder)
    official = L.stats(spark, folder).filter(F.col("id_match") % 3 == 0).select(
        "id_joueur", "id_match", (F.col("id_match") % 300).cast("string").alias("ppTimeOnIce")
    )
    return _pp.of(P.with_pp_time(fused, official))


_cov = Shape(whole="season_start_year", real="known_share home_share")


@query(
    "join_coverage",
    f"WITH {D.BASE} SELECT {_cov.sql} FROM (SELECT season_start_year, avg(CAST(id_match % 3 = 0 AS INT)) AS known_share, "
    "avg(is_home_player) AS home_share FROM base GROUP BY 1)",
)
def join_coverage(spark, folder):
    official = L.stats(spark, folder).filter(F.col("id_match") % 3 == 0).select("id_joueur", "id_match", F.lit("60").alias("ppTimeOnIce"))
    joined = P.with_pp_time(L.fused(spark, folder), official).withColumn("season_start_year", S.season_start_year("season_source"))
    return _cov.of(Q.coverage(joined, {"known_share": F.col("temps_pp_officiel").isNotNull(), "home_share": F.col("is_home_player") == 1}, ["season_start_year"]))


# ------------------------------------------------------------------ windows

_form_real = ("tirs_moy_5 toi_moy_5 pp_moy_5 points_moy_5 buts_moy_5 passes_moy_5 tirs_moy_10 toi_moy_10 points_moy_10 buts_moy_10 "
              "passes_moy_10 point_hit_rate_last_5 point_hit_rate_last_10 point_hit_rate_last_20 goal_hit_rate_last_10")
_form = Shape(whole="id_joueur id_match nb_matchs_avant_match nb_matchs_joues_10 jours_repos_raw", real=_form_real)


@query("player_form", f"WITH {D.FORM} SELECT {_form.sql} FROM form")
def player_form(spark, folder):
    return _form.of(P.player_form(*timelines(spark, folder)))


_rest = Shape(whole="id_joueur id_match jours_repos is_premier_match_joueur hist_ok_5 hist_ok_10 hist_ok_20")


@query(
    "rest_and_history_flags",
    f"""WITH {D.FORM}, flags AS (SELECT id_joueur, id_match, least(greatest(coalesce(jours_repos_raw, 7), 0), 14) AS jours_repos,
    CAST(nb_matchs_avant_match = 0 AS INT) AS is_premier_match_joueur, CAST(nb_matchs_avant_match >= 5 AS INT) AS hist_ok_5,
    CAST(nb_matchs_avant_match >= 10 AS INT) AS hist_ok_10, CAST(nb_matchs_avant_match >= 20 AS INT) AS hist_ok_20 FROM form)
    SELECT {_rest.sql} FROM flags""",
)
def rest_and_history_flags(spark, folder):
    return _rest.of(P.player_form(*timelines(spark, folder)))


_std = Shape(
    whole="id_joueur id_match season_games_before_match",
    real="season_points_before_match season_toi_before_match point_hit_rate_season_pre goal_hit_rate_season_pre "
         "points_per_game_season_pre toi_moy_season_pre pp_moy_season_pre",
)


@query(
    "season_to_date",
    f"WITH {D.BASE}{D.SEASON}, named AS (SELECT *, g AS season_games_before_match, s_points AS season_points_before_match, "
    f"s_toi AS season_toi_before_match FROM to_date) SELECT {_std.sql} FROM named",
)
def season_to_date(spark, folder):
    return _std.of(P.season_to_date(*timelines(spark, folder)))


_prev = Shape(whole="id_joueur id_match prev_season_games", real="point_hit_rate_prev_season goal_hit_rate_prev_season "
              "points_per_game_prev_season toi_moy_prev_season pp_moy_prev_season")


@query("previous_season", f"WITH {D.BASE}{D.SEASON} SELECT {_prev.sql} FROM base LEFT JOIN season_means USING (id_joueur, season_start_year)")
def previous_season(spark, folder):
    return _prev.of(P.season_before(*timelines(spark, folder)))


_now = Shape(whole="id_joueur id_match current_point_streak_pre current_no_point_streak_pre")


@query("current_streaks", f"WITH {D.BASE}{D.STREAKS} SELECT {_now.sql} FROM streak_now")
def current_streaks(spark, folder):
    rows, hot = timelines(spark, folder)
    return _now.of(T.current_streaks(rows, ["id_joueur", "season_source"], P.LINE, "a_marque_un_point",
                                     "current_point_streak_pre", "current_no_point_streak_pre", hot))


_long = Shape(whole="id_joueur id_match max_point_streak_last_2_seasons_pre max_no_point_streak_last_2_seasons_pre "
              "count_5plus_point_streaks_last_2_seasons_pre count_matches_last_2_seasons_pre")


@query("two_season_streaks", f"WITH {D.BASE}{D.STREAKS} SELECT {_long.sql} FROM streak_long")
def two_season_streaks(spark, folder):
    names = tuple(_long.whole.split()[2:])
    rows, hot = timelines(spark, folder)
    return _long.of(T.two_season_streaks(rows, ["id_joueur"], P.LINE, P.SEASON_YEAR, "a_marque_un_point", names, hot=hot))


_vs = Shape(whole="id_joueur id_match nb_matchs_vs_adv_avant",
            real="points_vs_adv_5 buts_vs_adv_5 tirs_vs_adv_5 points_vs_adv_shrunk buts_vs_adv_shrunk tirs_vs_adv_shrunk")


@query("opponent_history", f"WITH {D.OPPONENT} SELECT {_vs.sql} FROM versus")
def opponent_history(spark, folder):
    rows, hot = timelines(spark, folder)
    return _vs.of(P.opponent_history(S.fill(P.player_form(rows, hot), fixed.TEMPORAL_DEFAULTS), hot))


_abs = Shape(
    whole="id_joueur id_match jours_absence_pre_match absence_longue_flag retour_episode matchs_depuis_retour_avant_match return_stabilized_flag",
    real="toi_pre_absence_ref pp_pre_absence_ref toi_moy_retour_3_avant_match pp_moy_retour_3_avant_match ratio_toi ratio_pp",
)


@query("absence_episodes", f"WITH {D.ABSENCE} SELECT {_abs.sql} FROM returned")
def absence_episodes(spark, folder):
    rows, hot = timelines(spark, folder)
    return _abs.of(P.absences(S.fill(P.player_form(rows, hot), fixed.TEMPORAL_DEFAULTS), hot).withColumnsRenamed(
        {"ratio_toi_retour_vs_pre_absence": "ratio_toi", "ratio_pp_retour_vs_pre_absence": "ratio_pp"}))


_exp = Shape(whole="id_joueur id_match hard_exclude_hot_streak_pre current_point_streak_pre",
             real="point_hit_rate_weighted_pre points_per_game_weighted_pre recent_vs_expected_gap recent_hit_rate_composite")


@query(
    "season_blend_and_gap",
    f"""WITH {D.ABSENCE}, gap AS (SELECT * EXCLUDE (recent_hit_rate_composite), recent_hit_rate_composite,
    point_hit_rate_weighted_pre - (0.6 * point_hit_rate_last_10 + 0.4 * point_hit_rate_last_20) AS recent_vs_expected_gap FROM blended)
    SELECT {_exp.sql} FROM gap""",
)
def season_blend_and_gap(spark, folder):
    rows, hot = timelines(spark, folder)
    return _exp.of(P.expectations(P.absences(P.temporal_features(rows, hot), hot)))


# ------------------------------------------------------------------ teams and standings

def _games(spark, folder):
    """The matches of the base, written once: their windows and counts read them several times."""
    return stable(P.distinct_matches(base(spark, folder)))


_team = Shape(
    whole="id_match is_home_team jours_repos_team team_back_to_back team_back_to_back_away consecutive_away_games team_games_played_pre_approx",
    real="team_winrate_5 team_gf_moy_5 team_ga_moy_5", text="team_code",
)


@query("team_form", f"WITH {D.BASE}{D.TEAM_FORM} SELECT {_team.sql} FROM team_form")
def team_form(spark, folder):
    return _team.of(P.team_form(_games(spark, folder)))


_cut = Shape(whole="points conference_sequence division_sequence conference_cutoff_points wildcard_distance games_remaining",
             real="point_pctg", text="date_snapshot team_abbrev conference_abbrev")


@query("standings_cutoff", f"WITH {D.MATCHES}{D.STANDINGS} SELECT {_cut.sql} FROM standing")
def standings_cutoff(spark, folder):
    return _cut.of(P.standings_with_cutoff(L.standings(spark, folder)))


_asof = Shape(whole="id_match games_played_pre points_pre conference_sequence_pre wildcard_distance_pre l10_points_pre",
              real="point_pctg_pre", text="team_code conference_abbrev_pre")


@query("standings_as_of", f"WITH {D.BASE}{D.TEAM_FORM}{D.STANDINGS}{D.ASOF} SELECT {_asof.sql} FROM team_context")
def standings_as_of(spark, folder):
    return _asof.of(P.team_context(_games(spark, folder), L.standings(spark, folder)))


_press = Shape(whole="id_match games_played_team_pre games_remaining_team_pre late_season_flag playoff_pressure_simple", text="team_code")


@query(
    "season_pressure",
    f"""WITH {D.BASE}{D.TEAM_FORM}{D.STANDINGS}{D.ASOF}, played AS (SELECT *, coalesce(games_played_pre, team_games_played_pre_approx) AS games_played_team_pre FROM team_context),
    remaining AS (SELECT *, least(greatest(coalesce(games_remaining_pre, 82 - games_played_team_pre), 0), 82) AS games_remaining_team_pre FROM played),
    late AS (SELECT *, CAST(games_remaining_team_pre <= 20 AS INT) AS late_season_flag FROM remaining),
    pressed AS (SELECT *, CASE WHEN late_season_flag = 1 AND abs(wildcard_distance_pre) >= 8 THEN -1
                               WHEN late_season_flag = 1 AND abs(wildcard_distance_pre) <= 4 THEN 1 ELSE 0 END AS playoff_pressure_simple FROM late)
    SELECT {_press.sql} FROM pressed""",
)
def season_pressure(spark, folder):
    return _press.of(P.season_pressure(P.team_context(_games(spark, folder), L.standings(spark, folder))))


_all_whole = ("id_joueur id_match nb_matchs_avant_match jours_repos prev_season_games current_point_streak_pre max_point_streak_last_2_seasons_pre "
              "nb_matchs_vs_adv_avant absence_longue_flag retour_episode return_stabilized_flag hard_exclude_hot_streak_pre jours_repos_team "
              "consecutive_away_games team_games_played_pre_approx games_remaining_team_pre late_season_flag")
_all_real = ("tirs_moy_5 toi_moy_10 pp_moy_5 point_hit_rate_last_20 point_hit_rate_season_pre point_hit_rate_prev_season points_vs_adv_shrunk "
             "point_hit_rate_weighted_pre team_winrate_5 team_gf_moy_5 point_pctg_pre")
_all = Shape(whole=_all_whole, real=_all_real, text="date_match team_player_match")


@query(
    "all_features",
    f"WITH {D.CONTEXT}, filled AS (SELECT * REPLACE (coalesce(team_winrate_5, 0.5) AS team_winrate_5, coalesce(team_gf_moy_5, 2.8) AS team_gf_moy_5) FROM context) "
    f"SELECT {_all.sql} FROM filled",
)
def all_features(spark, folder):
    """The flagship: every pre-match feature of every player row."""
    return _all.of(P.all_features(L.fused(spark, folder), L.standings(spark, folder)))


# Every other column of the feature table: those that the twin's last table holds under the same name, and expressions on it.
_HELD = """is_home_player buts passes points tirs temps_de_glace temps_pp buts_domicile buts_exterieur a_marque_un_point a_marque_un_but nb_matchs_joues_10
    jours_repos_raw toi_moy_5 points_moy_5 buts_moy_5 passes_moy_5 tirs_moy_10 points_moy_10 buts_moy_10 passes_moy_10 point_hit_rate_last_5 point_hit_rate_last_10
    goal_hit_rate_last_10 goal_hit_rate_season_pre goal_hit_rate_prev_season points_per_game_season_pre points_per_game_prev_season toi_moy_season_pre
    toi_moy_prev_season pp_moy_season_pre pp_moy_prev_season season_games_before_match current_no_point_streak_pre max_no_point_streak_last_2_seasons_pre
    count_5plus_point_streaks_last_2_seasons_pre count_matches_last_2_seasons_pre recent_hit_rate_composite points_vs_adv_5 buts_vs_adv_5 tirs_vs_adv_5
    buts_vs_adv_shrunk tirs_vs_adv_shrunk jours_absence_pre_match matchs_depuis_retour_avant_match toi_pre_absence_ref pp_pre_absence_ref
    toi_moy_retour_3_avant_match pp_moy_retour_3_avant_match points_per_game_weighted_pre is_home_team team_ga_moy_5 team_back_to_back team_back_to_back_away
    games_played_pre games_remaining_pre points_pre conference_sequence_pre division_sequence_pre wildcard_distance_pre conference_cutoff_points_pre
    goal_differential_pre l10_points_pre games_played_team_pre""".split()
_MORE = {
    "is_premier_match_joueur": "CAST(nb_matchs_avant_match = 0 AS INT)", "is_premier_match_saison_joueur": "CAST(season_games_before_match = 0 AS INT)",
    **{f"hist_ok_{n}": f"CAST(nb_matchs_avant_match >= {n} AS INT)" for n in (5, 10, 20)},
    **{f"season_{n}_before_match": f"coalesce({r}_season_pre, 0) * season_games_before_match" for n, r in (
        ("point_hits", "point_hit_rate"), ("goal_hits", "goal_hit_rate"), ("points", "points_per_game"), ("toi", "toi_moy"), ("pp", "pp_moy"))},
    **{f"{n}_par_60_5": f"CASE WHEN toi_moy_5 <> 0 THEN {n}_moy_5 * 60 / toi_moy_5 ELSE 0 END" for n in ("tirs", "points", "buts")},
    "games_missed_proxy": "greatest(jours_absence_pre_match - 4, 0)", "return_from_absence_flag": "CAST(retour_episode > 0 AS INT)",
    "ratio_toi_retour_vs_pre_absence": "coalesce(ratio_toi, 0)", "ratio_pp_retour_vs_pre_absence": "coalesce(ratio_pp, 0)",
    "historical_current_weight": "w", "historical_prev_weight": "1 - w",
    "recent_vs_expected_gap": "coalesce(point_hit_rate_weighted_pre, 0.45) - (0.6 * coalesce(point_hit_rate_last_10, 0.45) + 0.4 * coalesce(point_hit_rate_last_20, 0.45))",
    "team_points_pre": "points_pre", "conference_rank_pre": "coalesce(conference_sequence_pre, 8.5)", "division_rank_pre": "coalesce(division_sequence_pre, 4.5)",
    "wildcard_sequence_pre": "conference_sequence_pre - 4", "standings_context_found": "CAST(seen_day IS NOT NULL AS INT)",
    "team_context_found": "CAST(is_home_team IS NOT NULL AS INT)", "check_home_team_context_ok": "coalesce(CAST(is_home_player = is_home_team AS INT), 0)",
    "playoff_pressure_simple": "CASE WHEN late_season_flag = 1 AND abs(wildcard_distance_pre) >= 8 THEN -1 WHEN late_season_flag = 1 AND abs(wildcard_distance_pre) <= 4 THEN 1 ELSE 0 END",
    "buts_match_equipe": "CASE WHEN is_home_player = 1 THEN buts_domicile ELSE buts_exterieur END",
    "buts_match_adversaire": "CASE WHEN is_home_player = 1 THEN buts_exterieur ELSE buts_domicile END",
    "diff_buts_equipe": "CASE WHEN is_home_player = 1 THEN buts_domicile - buts_exterieur ELSE buts_exterieur - buts_domicile END",
    "victoire_equipe": "CAST(CASE WHEN is_home_player = 1 THEN buts_domicile > buts_exterieur ELSE buts_exterieur > buts_domicile END AS INT)",
    "defaite_equipe": "CAST(CASE WHEN is_home_player = 1 THEN buts_domicile < buts_exterieur ELSE buts_exterieur < buts_domicile END AS INT)",
}
_every = Shape(whole="id_joueur id_match", real=" ".join([*_HELD, *_MORE]),
               text="season_source adversaire_match id_equipe_domicile id_equipe_exterieur conference_abbrev_pre standings_lookup_date_pre")
_DEFAULTS = fixed.TEMPORAL_DEFAULTS | fixed.CONTEXT_DEFAULTS


@query(
    "all_feature_columns",
    f"WITH {D.CONTEXT}, every AS (SELECT id_joueur, id_match, season_source, adversaire_match, id_equipe_domicile, id_equipe_exterieur, conference_abbrev_pre, "
    "seen_day AS standings_lookup_date_pre, " + ", ".join(f"coalesce({c}, {_DEFAULTS[c]}) AS {c}" if c in _DEFAULTS else c for c in _HELD) + ", "
    + ", ".join(f"{x} AS {c}" for c, x in _MORE.items()) + f" FROM context) SELECT {_every.sql} FROM every",
)
def all_feature_columns(spark, folder):
    """The columns of the feature table that the flagship's comparison leaves out."""
    return _every.of(P.all_features(L.fused(spark, folder), L.standings(spark, folder)))


_med = Shape(real="median", text="column_name")


@query(
    "median_defaults",
    f"WITH {D.FORM}, filled AS (SELECT " + ", ".join(f"coalesce({s}_moy_10, 0) AS {s}_moy_10" for s in ("points", "buts", "tirs"))
    + " FROM form), long AS (" + " UNION ALL ".join(f"SELECT '{s}_moy_10' AS column_name, median({s}_moy_10) AS median FROM filled" for s in ("points", "buts", "tirs"))
    + f") SELECT {_med.sql} FROM long",
)
def median_defaults(spark, folder):
    columns = [f"{s}_moy_10" for s in ("points", "buts", "tirs")]
    # Every pass of the selection reads these means.
    form = written(S.fill(P.player_form(*timelines(spark, folder)), fixed.TEMPORAL_DEFAULTS).select(*columns))
    return _med.of(M.exact_median(form, columns).withColumnRenamed("column", "column_name"))


# ------------------------------------------------------------------ slate

_ahead = Shape(whole="id_match", text="date_match id_equipe_domicile id_equipe_exterieur")


@query(
    "slate_matches",
    f"WITH {D.MATCHES} SELECT {_ahead.sql} FROM matches WHERE status = 'FUT' AND date_match = (SELECT min(date_match) FROM matches WHERE status = 'FUT' AND date_match >= DATE '2001-07-01')",
)
def slate_matches(spark, folder):
    games = L.matches(spark, folder)
    return _ahead.of(X.future_matches(games, X.choose_day(games, "2001-07-01")))


_pool = Shape(whole="id_joueur id_match days_since_last_game", text="date_match team_player_match nom position")
_POOL_SQL = """,
day AS (SELECT min(date_match) AS d FROM matches WHERE status = 'FUT'),
slate AS (SELECT m.* FROM matches m, day WHERE status = 'FUT' AND date_match = d),
teams AS (SELECT id_equipe_domicile AS t FROM slate UNION SELECT id_equipe_exterieur FROM slate),
named AS (
  SELECT s_suppkey AS id_joueur, upper(substr(split_part(p_name, ' ', 1), 1, 1)) || '. ' || upper(substr(split_part(p_name, ' ', 2), 1, 1)) || lower(substr(split_part(p_name, ' ', 2), 2)) || 'sson' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS nom,
         ['L', 'R', 'C', 'D', 'D', 'G'][s_suppkey % 6 + 1] AS position
  FROM supplier JOIN part ON p_partkey = s_suppkey),
latest AS (
  SELECT * FROM (SELECT id_joueur, id_match, date_match, team_player_match,
                        row_number() OVER (PARTITION BY id_joueur ORDER BY date_match DESC, id_match DESC) AS k FROM base) WHERE k = 1),
pool AS (
  SELECT l.id_joueur, l.id_match, l.date_match, l.team_player_match, d - l.date_match AS days_since_last_game, nom, position
  FROM latest l JOIN teams ON team_player_match = t JOIN named USING (id_joueur), day
  WHERE position <> 'G' AND d - l.date_match BETWEEN 0 AND 45)"""


def _slate(spark, folder):
    games = L.matches(spark, folder)
    day = X.choose_day(games, L.FUTURE_FROM)
    ahead = X.future_matches(games, day)
    past = written(base(spark, folder))
    return games, day, ahead, past, X.player_pool(past, L.players(spark, folder), day, X.slate_sides(ahead))


@query("player_pool", f"WITH {D.BASE}{_POOL_SQL} SELECT {_pool.sql} FROM pool")
def player_pool(spark, folder):
    return _pool.of(_slate(spark, folder)[4])


_ahead_features = Shape(
    whole="id_joueur id_match is_home_player nb_matchs_avant_match season_games nb_matchs_vs_adv_avant team_games_played_pre_approx consecutive_away_games current_point_streak_pre",
    real="tirs_moy_5 points_moy_10 point_hit_rate_last_20 team_gf_moy_5",
    text="team_player_match adversaire_match",
)
# Slate rows are appended to the base before any window, exactly as the Spark side does it. Each has
# a copy of the player's history of its own, numbered inside id_joueur, so slate rows do not see each other.
_SLATE_BASE = D.BASE.replace("base AS (", "played AS (", 1) + _POOL_SQL.replace("FROM base", "FROM played") + """,
wanted AS (
  SELECT s.*, id_equipe_domicile AS team, id_equipe_exterieur AS opp, 1 AS home FROM slate s
  UNION ALL SELECT s.*, id_equipe_exterieur, id_equipe_domicile, 0 FROM slate s),
slots AS (
  SELECT p.id_joueur, p.id_joueur * 1000 + row_number() OVER (PARTITION BY p.id_joueur ORDER BY w.id_match) AS line,
         w.id_match, w.date_match, w.saison AS season_source, w.yr AS season_start_year, w.team AS team_player_match, w.opp AS adversaire_match,
         w.home AS is_home_player, w.id_equipe_domicile, w.id_equipe_exterieur
  FROM wanted w JOIN pool p ON p.team_player_match = w.team),
base AS (
  SELECT h.* REPLACE (line AS id_joueur), false AS ahead FROM played h JOIN (SELECT id_joueur, line FROM slots) USING (id_joueur)
  UNION ALL BY NAME
  SELECT * EXCLUDE (line) REPLACE (line AS id_joueur), 0 AS a_marque_un_point, 0 AS a_marque_un_but, true AS ahead FROM slots)"""
_SLATE_SQL = (
    "WITH " + _SLATE_BASE + D.FORM[len(D.BASE):] + D.SEASON + D.STREAKS
    + ",\nvs AS (SELECT id_joueur, id_match, row_number() OVER (PARTITION BY id_joueur, adversaire_match ORDER BY date_match, id_match) - 1 AS nb_matchs_vs_adv_avant FROM base)"
    + ",\ngames AS (SELECT DISTINCT id_match, date_match, season_source, id_equipe_domicile, id_equipe_exterieur, buts_domicile, buts_exterieur FROM played "
      "UNION ALL SELECT id_match, date_match, saison, id_equipe_domicile, id_equipe_exterieur, NULL, NULL FROM slate),"
    + D._TEAM_FORM_TAIL
    + f""",
scored AS (
  SELECT f.*, g AS season_games, nb_matchs_vs_adv_avant, t.team_games_played_pre_approx, t.consecutive_away_games, coalesce(t.team_gf_moy_5, 2.8) AS team_gf_moy_5, current_point_streak_pre
  FROM (SELECT * REPLACE (coalesce(tirs_moy_5, 0) AS tirs_moy_5, coalesce(points_moy_10, 0) AS points_moy_10, coalesce(point_hit_rate_last_20, 0.45) AS point_hit_rate_last_20) FROM form) f
  JOIN to_date USING (id_joueur, id_match) JOIN vs USING (id_joueur, id_match) JOIN streak_now USING (id_joueur, id_match)
  LEFT JOIN team_form t ON t.id_match = f.id_match AND t.team_code = f.team_player_match WHERE f.ahead),
own AS (SELECT * REPLACE (id_joueur // 1000 AS id_joueur) FROM scored)
SELECT {_ahead_features.sql} FROM own"""
)


@query("slate_features", _SLATE_SQL)
def slate_features(spark, folder):
    games, day, ahead, past, pool = _slate(spark, folder)
    found = X.slate_features(past, games, ahead, pool, L.standings(spark, folder))
    return _ahead_features.of(found.withColumnRenamed("season_games_before_match", "season_games"))


_ahead_standings = Shape(
    whole="id_joueur id_match standings_context_found", text="date_match team_player_match standings_lookup_date_pre conference_abbrev_pre",
    real="games_played_pre games_remaining_pre points_pre conference_sequence_pre conference_cutoff_points_pre wildcard_distance_pre point_pctg_pre "
         "goal_differential_pre l10_points_pre conference_rank_pre division_rank_pre",
)


@query(
    "slate_standings",
    f"""WITH {D.BASE}{_POOL_SQL}{D.STANDINGS},
    wanted AS (SELECT id_match, date_match, id_equipe_domicile AS team FROM slate UNION ALL SELECT id_match, date_match, id_equipe_exterieur FROM slate),
    rows AS (SELECT p.id_joueur, w.id_match, w.date_match, w.team AS team_player_match FROM wanted w JOIN pool p ON p.team_player_match = w.team),
    seen AS (
      SELECT r.*, CAST(s.date_snapshot IS NOT NULL AS INT) AS standings_context_found, s.date_snapshot AS standings_lookup_date_pre,
        s.conference_abbrev AS conference_abbrev_pre, s.games_played AS games_played_pre, s.games_remaining AS games_remaining_pre, s.points AS points_pre,
        s.conference_sequence AS conference_sequence_pre, s.conference_cutoff_points AS conference_cutoff_points_pre,
        coalesce(s.wildcard_distance, 0) AS wildcard_distance_pre, s.point_pctg AS point_pctg_pre, s.goal_differential AS goal_differential_pre,
        s.l10_points AS l10_points_pre, coalesce(s.conference_sequence, 8.5) AS conference_rank_pre, coalesce(s.division_sequence, 4.5) AS division_rank_pre
      FROM rows r ASOF LEFT JOIN standing s ON r.team_player_match = s.team_abbrev AND (r.date_match - 1) >= s.date_snapshot)
    SELECT {_ahead_standings.sql} FROM seen""",
)
def slate_standings(spark, folder):
    """Standings up to the day before, on the rows of the matches to come."""
    games, day, ahead, past, pool = _slate(spark, folder)
    return _ahead_standings.of(X.slate_features(past, games, ahead, pool, L.standings(spark, folder)))
