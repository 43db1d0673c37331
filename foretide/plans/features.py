"""Pre-match features per (player, match): canonical base, temporal block, context block.

All player windows hang on one shuffle by player; team form is computed on the much smaller
team-match table and standings on distinct (team, date) pairs, both joined back by equality.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretide import fixed
from foretide.functions import scalars as S
from foretide.operators import quality as Q
from foretide.operators import timeline as T
from foretide.operators.ordered import (
    HotKeys,
    find_hot,
    keep_first,
    keep_top,
    last_seen,
    over_order,
    previous,
    rolling_count,
    rolling_mean,
    running_count,
    running_sum,
)
from foretide.session import spread, written

PLAYER, MATCH, DAY = "id_joueur", "id_match", "date_match"
LINE = [DAY, MATCH]
SEASON, SEASON_YEAR = "season_source", "season_start_year"


# ------------------------------------------------------------------ canonical base


def fused_base(stats: DataFrame, matches: DataFrame) -> DataFrame:
    """Player rows with their match, a found flag and the expected teams."""
    known = matches.select(
        MATCH, F.col(DAY).alias("date_match_match"), "saison", "id_equipe_domicile", "id_equipe_exterieur",
        "buts_domicile", "buts_exterieur", "status", F.lit(1).alias("__found"),
    )
    base = stats.join(known, MATCH, "left")
    home = F.col("is_home_player") == 1
    base = base.withColumns(
        {
            "_merge": F.when(F.col("__found") == 1, "both").otherwise("left_only"),
            "match_trouve": F.coalesce("__found", F.lit(0)),
            "team_attendue_match": F.when(home, F.col("id_equipe_domicile")).otherwise(F.col("id_equipe_exterieur")),
            "adversaire_attendu_match": F.when(home, F.col("id_equipe_exterieur")).otherwise(F.col("id_equipe_domicile")),
        }
    ).drop("__found")
    return base.withColumns(
        {
            "check_team_ok": F.coalesce(F.col("team_player_match") == F.col("team_attendue_match"), F.lit(False)),
            "check_opp_ok": F.coalesce(F.col("adversaire_match") == F.col("adversaire_attendu_match"), F.lit(False)),
        }
    )


def fused_violations():
    """Rules every fused row must keep."""
    bad = lambda c: F.coalesce(S.flag(c) != 1.0, F.lit(True))
    return {"match_missing": bad("match_trouve"), "team_differs": bad("check_team_ok"), "opponent_differs": bad("check_opp_ok")}


def with_pp_time(base: DataFrame, pp: DataFrame) -> DataFrame:
    """Replace the power-play time of the box score by the official one where it is known."""
    official = pp.select(
        S.whole_from_decimal(PLAYER).alias(PLAYER),
        S.whole_from_decimal(MATCH).alias(MATCH),
        S.minutes_from_seconds("ppTimeOnIce").alias("temps_pp_officiel"),
    ).dropna(subset=[PLAYER, MATCH])
    joined = Q.join_many_to_one(base, official, [PLAYER, MATCH], "power-play times")
    return joined.withColumn("temps_pp", F.coalesce("temps_pp_officiel", S.minutes("temps_pp")))


def canonical_base(fused: DataFrame, check: bool = True, dropped: Q.Dropped | None = None) -> DataFrame:
    """Typed columns, targets, result columns; one row per (player, match). Raises on fused_violations.

    `dropped` counts the rows that are left out on the way.
    """
    Q.require_columns(fused, [PLAYER, MATCH, DAY, SEASON, "team_player_match", "adversaire_match"], "fused base")
    if check:
        Q.require_none(fused, fused_violations(), "fused base")
    base = fused.withColumns(
        {DAY: S.day(DAY)}
        | {c: S.identifier(fused, c) for c in (PLAYER, MATCH, "is_home_player")}
        | {c: S.numeric(fused, c) for c in ("buts", "passes", "points", "tirs", "plus_moins", "penalty_minutes",
                                            "buts_domicile", "buts_exterieur")}
        | {c: S.minutes(c) for c in ("temps_de_glace", "temps_pp")}
        | {c: S.team_code(c) for c in ("team_player_match", "adversaire_match", "id_equipe_domicile", "id_equipe_exterieur")}
        | {SEASON: S.upper_code(SEASON)}
    )
    home = F.col("is_home_player") == 1
    base = base.withColumns(
        {
            SEASON_YEAR: S.season_start_year(SEASON),
            "a_marque_un_point": S.reached("points"),
            "a_marque_un_but": S.reached("buts"),
            "buts_match_equipe": F.when(home, F.col("buts_domicile")).otherwise(F.col("buts_exterieur")),
            "buts_match_adversaire": F.when(home, F.col("buts_exterieur")).otherwise(F.col("buts_domicile")),
        }
    )
    gap = F.col("buts_match_equipe") - F.col("buts_match_adversaire")
    base = base.withColumns(
        {
            "victoire_equipe": F.coalesce((gap > 0).cast("int"), F.lit(0)),
            "defaite_equipe": F.coalesce((gap < 0).cast("int"), F.lit(0)),
            "diff_buts_equipe": gap,
        }
    )
    base = base.drop("_merge", "team_attendue_match", "adversaire_attendu_match", "check_team_ok", "check_opp_ok")
    # Rows without a key cannot be placed on a timeline: they are counted, not carried on.
    place = [DAY, SEASON, "team_player_match", "adversaire_match"]
    base = dropped.unkeyed(base, [PLAYER, MATCH]) if dropped else base.dropna(subset=[PLAYER, MATCH])
    base = keep_first(base, [PLAYER, MATCH], [DAY, "points", "temps_de_glace", "tirs", "team_player_match"])
    return dropped.unplaced(base, place) if dropped else base.dropna(subset=place)


# ------------------------------------------------------------------ temporal block


def player_form(base: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Rolling means, counts and rest over the player's earlier matches."""
    frames = [
        running_count("nb_matchs_avant_match"),
        previous("__prev_day", DAY),
        previous("__prev_season", SEASON),
        rolling_count("nb_matchs_joues_10", MATCH, 10),
    ]
    stats = {"tirs": "tirs", "toi": "temps_de_glace", "pp": "temps_pp", "points": "points", "buts": "buts", "passes": "passes"}
    frames += [rolling_mean(f"{n}_moy_5", c, 5) for n, c in stats.items()]
    frames += [rolling_mean(f"{n}_moy_10", c, 10) for n, c in stats.items() if n != "pp"]
    frames += [rolling_mean(f"point_hit_rate_last_{n}", "a_marque_un_point", n) for n in (5, 10, 20)]
    frames += [rolling_mean("goal_hit_rate_last_10", "a_marque_un_but", 10)]
    out = over_order(base, [PLAYER], LINE, frames, hot)
    rest = F.when(F.col("__prev_season") == F.col(SEASON), F.date_diff(F.col(DAY), F.col("__prev_day")))
    played = F.col("nb_matchs_avant_match")
    return (
        out.withColumn("jours_repos_raw", rest)
        .withColumns(
            {
                "jours_repos": F.coalesce(S.clip("jours_repos_raw", 0, 14), F.lit(7)),
                "is_premier_match_joueur": (played == 0).cast("int"),
                "hist_ok_5": (played >= 5).cast("int"),
                "hist_ok_10": (played >= 10).cast("int"),
                "hist_ok_20": (played >= 20).cast("int"),
            }
        )
        .drop("__prev_day", "__prev_season")
    )


def season_to_date(base: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Sums and rates over the player's earlier matches of the same season."""
    sums = {"point_hits": "a_marque_un_point", "goal_hits": "a_marque_un_but", "points": "points",
            "toi": "temps_de_glace", "pp": "temps_pp"}
    frames = [running_count("season_games_before_match")]
    frames += [running_sum(f"season_{n}_before_match", c) for n, c in sums.items()]
    out = over_order(base, [PLAYER, SEASON], LINE, frames, hot)
    rates = {"point_hit_rate_season_pre": "point_hits", "goal_hit_rate_season_pre": "goal_hits",
             "points_per_game_season_pre": "points", "toi_moy_season_pre": "toi", "pp_moy_season_pre": "pp"}
    games = "season_games_before_match"
    return out.withColumns(
        {n: S.ratio(f"season_{s}_before_match", games) for n, s in rates.items()}
        | {"is_premier_match_saison_joueur": (F.col(games) == 0).cast("int")}
    )


def season_before(base: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """The player's averages over the whole previous season."""
    means = {"point_hit_rate_prev_season": "a_marque_un_point", "goal_hit_rate_prev_season": "a_marque_un_but",
             "points_per_game_prev_season": "points", "toi_moy_prev_season": "temps_de_glace",
             "pp_moy_prev_season": "temps_pp"}
    return T.previous_season_means(base, [PLAYER], SEASON_YEAR, means, ("prev_season_games", MATCH), hot)


def streaks(base: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Runs of matches with and without a point, now and over two seasons."""
    hot = find_hot(base, [PLAYER]) if hot is None else hot
    out = T.current_streaks(base, [PLAYER, SEASON], LINE, "a_marque_un_point",
                            "current_point_streak_pre", "current_no_point_streak_pre", hot)
    names = ("max_point_streak_last_2_seasons_pre", "max_no_point_streak_last_2_seasons_pre",
             "count_5plus_point_streaks_last_2_seasons_pre", "count_matches_last_2_seasons_pre")
    return T.two_season_streaks(out, [PLAYER], LINE, SEASON_YEAR, "a_marque_un_point", names, fixed.LONG_STREAK, hot)


def temporal_features(base: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    hot = find_hot(base, [PLAYER]) if hot is None else hot
    out = streaks(season_before(season_to_date(player_form(base, hot), hot), hot), hot)
    out = out.withColumn("recent_hit_rate_composite", S.recent_blend("point_hit_rate_last_10", "point_hit_rate_last_20"))
    # The rates as known, before defaults; the season blend can be built on either (see opponent_and_return).
    kept = {f"__known_{c}": F.col(c) for c in KNOWN_RATES}
    out = out.withColumns(kept)
    out = S.fill(out, fixed.TEMPORAL_DEFAULTS)
    return out.withColumns({f"{n}_par_60_5": S.per_60(f"{n}_moy_5", "toi_moy_5") for n in ("tirs", "points", "buts")})


KNOWN_RATES = ["point_hit_rate_season_pre", "point_hit_rate_prev_season", "points_per_game_season_pre",
               "points_per_game_prev_season"]


# ------------------------------------------------------------------ context block


MEETING_STATS = ("points", "buts", "tirs")


def meetings(df: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Number of and means over the earlier meetings with this opponent."""
    hot = find_hot(df, [PLAYER]) if hot is None else hot
    frames = [running_count("nb_matchs_vs_adv_avant")] + [rolling_mean(f"{s}_vs_adv_5", s, 5) for s in MEETING_STATS]
    return over_order(df, [PLAYER, "adversaire_match"], LINE, frames, hot)


def shrunk_meetings(df: DataFrame) -> DataFrame:
    """The means of the meetings, shrunk towards the recent form."""
    return df.withColumns(
        {f"{s}_vs_adv_shrunk": S.shrink(f"{s}_vs_adv_5", "nb_matchs_vs_adv_avant", f"{s}_moy_10") for s in MEETING_STATS}
    )


def opponent_history(df: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Earlier meetings with this opponent, shrunk towards the recent form."""
    return shrunk_meetings(meetings(df, hot))


def absences(df: DataFrame, hot: HotKeys | None = None, days: int = fixed.ABSENCE_DAYS,
             min_ratio: float = fixed.RETURN_MIN_RATIO, min_toi: float = fixed.RETURN_MIN_TOI) -> DataFrame:
    """Long gaps inside a season, the episode each one opens, and the form since the return."""
    hot = find_hot(df, [PLAYER]) if hot is None else hot
    out = T.days_since_previous(df, [PLAYER], LINE, DAY, "__gap", SEASON, hot)
    out = out.withColumn("jours_absence_pre_match", T.clipped_gap(F.col("__gap"), 3, 0, 90))
    away = F.col("jours_absence_pre_match")
    out = out.withColumns(
        {
            "games_missed_proxy": F.greatest(away - 4, F.lit(0)),
            "absence_longue_flag": (F.col("__gap").isNotNull() & (away >= days)).cast("int"),
        }
    ).drop("__gap")
    out = T.episodes(out, [PLAYER], LINE, "absence_longue_flag", "retour_episode", hot)
    opened = F.col("absence_longue_flag") == 1
    out = over_order(
        out,
        [PLAYER, "retour_episode"],
        LINE,
        [
            running_count("matchs_depuis_retour_avant_match"),
            last_seen("toi_pre_absence_ref", F.when(opened, F.col("toi_moy_10")), current=True),
            last_seen("pp_pre_absence_ref", F.when(opened, F.col("pp_moy_5")), current=True),
            rolling_mean("toi_moy_retour_3_avant_match", "temps_de_glace", 3),
            rolling_mean("pp_moy_retour_3_avant_match", "temps_pp", 3),
        ],
        hot,
    )
    out = out.withColumns(
        {
            "ratio_toi_retour_vs_pre_absence": S.ratio("toi_moy_retour_3_avant_match", "toi_pre_absence_ref"),
            "ratio_pp_retour_vs_pre_absence": S.ratio("pp_moy_retour_3_avant_match", "pp_pre_absence_ref"),
            "return_from_absence_flag": (F.col("retour_episode") > 0).cast("int"),
        }
    )
    stable_again = (
        (F.col("retour_episode") > 0)
        & (F.col("matchs_depuis_retour_avant_match") >= 3)
        & (F.coalesce("toi_moy_retour_3_avant_match", F.lit(0.0)) >= min_toi)
        & (F.coalesce("ratio_toi_retour_vs_pre_absence", F.lit(0.0)) >= min_ratio)
    )
    return out.withColumn("return_stabilized_flag", stable_again.cast("int"))


def expectations(df: DataFrame, known_only: bool = False) -> DataFrame:
    """Season blends, gap to recent form and the hot-streak exclusion.

    By default the blend uses the rates after defaults, as the stored feature tables do;
    `known_only` blends the rates that are really known and lets one stand in for the other.
    """
    rate = (lambda c: f"__known_{c}") if known_only else (lambda c: c)
    weight = F.when(F.col("return_stabilized_flag") == 1, fixed.CURRENT_WEIGHT_AFTER_RETURN).otherwise(fixed.CURRENT_WEIGHT)
    out = df.withColumns({"historical_current_weight": weight, "historical_prev_weight": 1.0 - weight})
    out = out.withColumns(
        {
            f"{r}_weighted_pre": S.season_blend(rate(f"{r}_season_pre"), rate(f"{r}_prev_season"), "historical_current_weight")
            for r in ("point_hit_rate", "points_per_game")
        }
    )
    recent = S.recent_blend("point_hit_rate_last_10", "point_hit_rate_last_20")
    return out.withColumns(
        {
            "recent_vs_expected_gap": F.coalesce("point_hit_rate_weighted_pre", F.lit(0.45)) - F.coalesce(recent, F.lit(0.45)),
            "hard_exclude_hot_streak_pre": S.hot_streak(
                "current_point_streak_pre", "count_5plus_point_streaks_last_2_seasons_pre",
                "max_point_streak_last_2_seasons_pre"),
        }
    )


def distinct_matches(base: DataFrame) -> DataFrame:
    """One row per match out of the player rows (first row by player)."""
    fields = [DAY, SEASON, "id_equipe_domicile", "id_equipe_exterieur", "buts_domicile", "buts_exterieur"]
    return base.groupBy(MATCH).agg(F.min_by(F.struct(*fields), PLAYER).alias("m")).select(MATCH, "m.*")


def team_matches(matches: DataFrame) -> DataFrame:
    """Home and away view of every match."""
    return T.sides(
        matches,
        {"team_code": "id_equipe_domicile", "opp_code": "id_equipe_exterieur", "gf": "buts_domicile", "ga": "buts_exterieur"},
        {"team_code": "id_equipe_exterieur", "opp_code": "id_equipe_domicile", "gf": "buts_exterieur", "ga": "buts_domicile"},
        [MATCH, DAY, SEASON],
        "is_home_team",
    )


def team_form(matches: DataFrame) -> DataFrame:
    """Rest, travel and recent results of each team before each of its matches."""
    games = team_matches(matches).withColumn(
        "team_win", F.when(F.col("gf").isNotNull() & F.col("ga").isNotNull(), (F.col("gf") > F.col("ga")).cast("int"))
    ).filter(F.col("team_code").isNotNull())
    keys = ["team_code", SEASON]
    hot = find_hot(games, keys)
    out = over_order(
        games,
        keys,
        LINE,
        [
            running_count("team_games_played_pre_approx"),
            previous("__prev_day", DAY),
            rolling_mean("team_winrate_5", "team_win", 5),
            rolling_mean("team_gf_moy_5", "gf", 5),
            rolling_mean("team_ga_moy_5", "ga", 5),
        ],
        hot,
    )
    out = T.run_since(out, keys, LINE, F.coalesce(F.col("is_home_team"), F.lit(1)) != 0, "consecutive_away_games", hot)
    rest = F.date_diff(F.col(DAY), F.col("__prev_day"))
    out = out.withColumn("jours_repos_team", T.clipped_gap(rest, 3, 0, 14)).drop("__prev_day")
    short = (F.col("jours_repos_team") <= 1).cast("int")
    return out.withColumns(
        {"team_back_to_back": short, "team_back_to_back_away": short * (1 - F.col("is_home_team"))}
    )


TEAM_CONTEXT = ["is_home_team", "jours_repos_team", "team_back_to_back", "team_back_to_back_away",
                "consecutive_away_games", "team_winrate_5", "team_gf_moy_5", "team_ga_moy_5",
                "team_games_played_pre_approx"]


def add_team_context(df: DataFrame, context: DataFrame) -> DataFrame:
    """Join the team context on (match, team), one row each, and compare the home flags."""
    extra = [c for c in context.columns if c not in (MATCH, "team_code", "opp_code", DAY, SEASON, "gf", "ga", "team_win")]
    right = context.select(MATCH, F.col("team_code").alias("team_player_match"), *extra, F.lit(1).alias("__found"))
    out = df.join(right, [MATCH, "team_player_match"], "left")
    agrees = F.coalesce((F.col("is_home_player") == F.col("is_home_team")).cast("double"), F.lit(0.0))
    return out.withColumns(
        {"team_context_found": F.coalesce("__found", F.lit(0)), "check_home_team_context_ok": agrees}
    ).drop("__found")


def standings_with_cutoff(standings: DataFrame) -> DataFrame:
    """Points of the last qualifying rank per day and conference, and each team's distance to it.

    The cut-off is the points of rank 8, else the eighth best points, else the lowest. Only the best
    eight rows per group travel: rank-8 row and top 8 are picked before the shuffle.
    """
    numbers = ["games_played", "games_remaining", "points", "conference_sequence", "division_sequence",
               "wildcard_sequence", "point_pctg", "goal_differential", "l10_points"]
    table = standings.withColumns(
        {"date_snapshot": S.day("date_snapshot"), "team_abbrev": S.team_code("team_abbrev"),
         "conference_abbrev": S.upper_code("conference_abbrev"), "division_abbrev": S.upper_code("division_abbrev")}
        | {c: S.numeric(standings, c) for c in numbers if c in standings.columns}
    ).filter(F.col("date_snapshot").isNotNull())
    group = ["date_snapshot", "conference_abbrev"]
    # Among the rows that count, rank 8 is looked at through the same pass as the best eight.
    scored = table.filter(F.col("points").isNotNull()).select(*group, "team_abbrev", "points", "conference_sequence")
    best = keep_top(scored, group, [F.col("points").desc(), "team_abbrev"], fixed.CUTOFF_RANK)
    lowest = best.groupBy(*group).agg(F.min("points").alias("__eighth"))
    ranked = (
        scored.filter(F.col("conference_sequence") == fixed.CUTOFF_RANK)
        .groupBy(*group).agg(F.min_by("points", "team_abbrev").alias("__ranked"))
    )
    cutoff = lowest.join(ranked, group, "left").select(
        *group, F.coalesce("__ranked", "__eighth").alias("conference_cutoff_points")
    )
    return table.join(cutoff, group, "left").withColumns(
        {"wildcard_distance": F.col("points") - F.col("conference_cutoff_points"),
         "standings_lookup_date": F.col("date_snapshot")}
    )


def add_standings(df: DataFrame, standings: DataFrame | None, team: str = "team_code") -> DataFrame:
    """Latest standings up to the day before the match; NULL columns when there is no table.

    Runs on team-match rows (or any table with a team and a match day), not on the player rows.
    """
    if standings is None:
        absent = {f"{c}_pre": F.lit(None).cast("string" if c.endswith("abbrev") else "date" if c.endswith("date") else "double")
                  for c in fixed.STANDINGS_ASOF}
        return df.withColumns(absent | {"standings_context_found": F.lit(0)})
    day_before = df.withColumn("__lookup", F.date_sub(DAY, 1))
    unique = keep_first(
        standings.withColumnRenamed("team_abbrev", team),
        [team, "standings_lookup_date"],
        [F.col("games_played").desc_nulls_last(), "points"],
    )
    out = T.as_of(day_before, unique, team, "__lookup", "standings_lookup_date", fixed.STANDINGS_ASOF, "_pre")
    found = F.col("standings_lookup_date_pre").isNotNull().cast("int")
    return out.withColumn("standings_context_found", found).drop("__lookup")


def season_pressure(df: DataFrame) -> DataFrame:
    out = df.withColumn("games_played_team_pre", F.coalesce("games_played_pre", F.col("team_games_played_pre_approx").cast("double")))
    left = F.coalesce("games_remaining_pre", fixed.GAMES_PER_SEASON - F.col("games_played_team_pre"))
    out = out.withColumns(
        {
            "games_remaining_team_pre": S.clip(left, 0, fixed.GAMES_PER_SEASON),
            "team_points_pre": F.col("points_pre"),
            "conference_rank_pre": F.col("conference_sequence_pre"),
            "division_rank_pre": F.col("division_sequence_pre"),
        }
    )
    out = out.withColumn("late_season_flag", S.late_season("games_remaining_team_pre"))
    return out.withColumn("playoff_pressure_simple", S.pressure("late_season_flag", "wildcard_distance_pre"))


def team_context(matches: DataFrame, standings: DataFrame | None) -> DataFrame:
    """Everything known about a team before each of its matches: form and standings."""
    ready = None if standings is None else standings_with_cutoff(standings)
    return add_standings(team_form(matches), ready)


def context_features(df: DataFrame, context: DataFrame, hot: HotKeys | None = None, known_only: bool = False) -> DataFrame:
    """Opponent, absence and expectation columns, then the team context."""
    hot = find_hot(df, [PLAYER]) if hot is None else hot
    return with_team_context(expectations(absences(opponent_history(df, hot), hot), known_only), context)


def with_team_context(df: DataFrame, context: DataFrame) -> DataFrame:
    """The team context of rows that have all columns of the player, and defaults where nothing is known."""
    out = season_pressure(add_team_context(df, context))
    return S.fill(out.drop(*[f"__known_{c}" for c in KNOWN_RATES]), fixed.CONTEXT_DEFAULTS)


def all_features(fused: DataFrame, standings: DataFrame | None, matches: DataFrame | None = None,
                 check: bool = True, known_only: bool = False) -> DataFrame:
    """Fused player rows -> every pre-match feature.

    `matches` (one row per match) may be passed when it is at hand; else it is taken from the rows.
    """
    # Checks and counts read these rows, matches and windows those without copies: both are written once instead of joined
    # and sorted out anew, and the shuffles behind them are gone before the wide ones come.
    fused = written(fused)
    base = written(canonical_base(fused, check))
    # Counted before copies are dropped, which takes a look at one column instead of all of them.
    hot = find_hot(fused.select(S.identifier(fused, PLAYER).alias(PLAYER)), [PLAYER])
    rows = fused.count()
    # The match table is far smaller than the player rows and read several times: write it once.
    games = written(distinct_matches(base)) if matches is None else matches
    context = team_context(games, standings)
    return context_features(temporal_features(spread(base, [PLAYER], rows), hot), context, hot, known_only)
