"""The derived league and its features as plain SQL, for checking results in another engine."""

from __future__ import annotations

from foretide.plans.league import FUTURE_FROM, TEAMS

_TEAMS = "[" + ", ".join(f"'{t}'" for t in TEAMS) + "]"

MATCHES = f"""
numbered AS (
  SELECT o_orderkey AS id_match, CAST(o_orderdate AS DATE) AS date_match,
         year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END AS yr,
         o_custkey % 32 AS h, (o_custkey % 32 + 1 + o_orderkey % 31) % 32 AS a,
         CAST(o_orderdate AS DATE) < DATE '{FUTURE_FROM}' AS played, o_custkey, o_orderkey
  FROM orders),
matches AS (
  SELECT id_match, date_match, CAST(yr AS VARCHAR) || CAST(yr + 1 AS VARCHAR) AS saison, yr,
         {_TEAMS}[h + 1] AS id_equipe_domicile, {_TEAMS}[a + 1] AS id_equipe_exterieur,
         CASE WHEN played THEN o_orderkey % 7 END AS buts_domicile,
         CASE WHEN played THEN (o_custkey * 3 + o_orderkey) % 6 END AS buts_exterieur,
         CASE WHEN played THEN 'OFF' ELSE 'FUT' END AS status
  FROM numbered)"""

BASE = MATCHES + """,
lines AS (
  SELECT l_orderkey AS id_match, l_suppkey AS id_joueur, CAST(sum(l_quantity) AS BIGINT) AS q
  FROM lineitem GROUP BY 1, 2),
raw AS (
  SELECT l.*, m.date_match, m.saison, m.yr, m.id_equipe_domicile, m.id_equipe_exterieur, m.buts_domicile, m.buts_exterieur,
         l.id_joueur % 2 = 1 AS home,
         CASE WHEN q % 5 = 0 THEN 1 + q % 2 ELSE 0 END AS buts, CASE WHEN q % 3 = 0 THEN 1 ELSE 0 END AS passes
  FROM lines l JOIN matches m USING (id_match) WHERE m.status = 'OFF'),
base AS (
  SELECT id_joueur, id_match, date_match, saison AS season_source, yr AS season_start_year,
         CASE WHEN home THEN id_equipe_domicile ELSE id_equipe_exterieur END AS team_player_match,
         CASE WHEN home THEN id_equipe_exterieur ELSE id_equipe_domicile END AS adversaire_match,
         CAST(home AS INT) AS is_home_player, id_equipe_domicile, id_equipe_exterieur,
         CAST(buts AS DOUBLE) AS buts, CAST(passes AS DOUBLE) AS passes, CAST(buts + passes AS DOUBLE) AS points,
         CAST(q % 8 AS DOUBLE) AS tirs,
         (8 + q % 15) + ((q * 7 + id_match) % 60) / 60.0::DOUBLE AS temps_de_glace,
         (q % 5) + ((q * 11) % 60) / 60.0::DOUBLE AS temps_pp,
         CAST(buts_domicile AS DOUBLE) AS buts_domicile, CAST(buts_exterieur AS DOUBLE) AS buts_exterieur,
         CASE WHEN buts + passes >= 1 THEN 1 ELSE 0 END AS a_marque_un_point,
         CASE WHEN buts >= 1 THEN 1 ELSE 0 END AS a_marque_un_but
  FROM raw)"""

_ROLL5 = ", ".join(
    f"avg({c}) OVER (p ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS {n}_moy_5"
    for n, c in dict(tirs="tirs", toi="temps_de_glace", pp="temps_pp", points="points", buts="buts", passes="passes").items()
)
_ROLL10 = ", ".join(
    f"avg({c}) OVER (p ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS {n}_moy_10"
    for n, c in dict(tirs="tirs", toi="temps_de_glace", points="points", buts="buts", passes="passes").items()
)
_HITS = ", ".join(
    f"avg(a_marque_un_point) OVER (p ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS point_hit_rate_last_{n}" for n in (5, 10, 20)
)

FORM = BASE + f""",
form AS (
  SELECT *, CASE WHEN prev_season = season_source THEN date_match - prev_day END AS jours_repos_raw
  FROM (
    SELECT *, count(*) OVER (p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS nb_matchs_avant_match,
           count(id_match) OVER (p ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS nb_matchs_joues_10,
           lag(date_match) OVER p AS prev_day, lag(season_source) OVER p AS prev_season,
           {_ROLL5}, {_ROLL10}, {_HITS},
           avg(a_marque_un_but) OVER (p ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS goal_hit_rate_last_10
    FROM base WINDOW p AS (PARTITION BY id_joueur ORDER BY date_match, id_match)))"""

_SUMS = dict(point_hits="a_marque_un_point", goal_hits="a_marque_un_but", points="points", toi="temps_de_glace", pp="temps_pp")
SEASON = """,
to_date AS (
  SELECT *, CASE WHEN g > 0 THEN s_point_hits / g END AS point_hit_rate_season_pre, CASE WHEN g > 0 THEN s_goal_hits / g END AS goal_hit_rate_season_pre,
         CASE WHEN g > 0 THEN s_points / g END AS points_per_game_season_pre,
         CASE WHEN g > 0 THEN s_toi / g END AS toi_moy_season_pre, CASE WHEN g > 0 THEN s_pp / g END AS pp_moy_season_pre
  FROM (
    SELECT id_joueur, id_match, row_number() OVER s - 1 AS g, """ + ", ".join(
    f"coalesce(CAST(sum({c}) OVER (s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE), 0) AS s_{n}" for n, c in _SUMS.items()
) + """
    FROM base WINDOW s AS (PARTITION BY id_joueur, season_source ORDER BY date_match, id_match))),
season_means AS (
  SELECT id_joueur, season_start_year + 1 AS season_start_year, count(id_match) AS prev_season_games,
         avg(a_marque_un_point) AS point_hit_rate_prev_season, avg(a_marque_un_but) AS goal_hit_rate_prev_season,
         avg(points) AS points_per_game_prev_season, avg(temps_de_glace) AS toi_moy_prev_season, avg(temps_pp) AS pp_moy_prev_season
  FROM base GROUP BY 1, 2)"""

STREAKS = """,
marked AS (
  SELECT *, sum(1 - a_marque_un_point) OVER s AS misses, sum(a_marque_un_point) OVER s AS hits
  FROM base WINDOW s AS (PARTITION BY id_joueur, season_source ORDER BY date_match, id_match ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
runs AS (
  SELECT id_joueur, id_match, season_source, date_match,
         sum(a_marque_un_point) OVER (PARTITION BY id_joueur, season_source, misses ORDER BY date_match, id_match ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hit_run,
         sum(1 - a_marque_un_point) OVER (PARTITION BY id_joueur, season_source, hits ORDER BY date_match, id_match ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS miss_run
  FROM marked),
streak_now AS (
  SELECT id_joueur, id_match, coalesce(lag(hit_run) OVER s, 0) AS current_point_streak_pre, coalesce(lag(miss_run) OVER s, 0) AS current_no_point_streak_pre
  FROM runs WINDOW s AS (PARTITION BY id_joueur, season_source ORDER BY date_match, id_match)),
spans AS (
  SELECT id_joueur, id_match, date_match, season_start_year, a_marque_un_point AS hit, season_start_year + d AS span
  FROM base, (VALUES (0), (1)) v(d)),
span_marked AS (
  SELECT *, sum(1 - hit) OVER s AS misses, sum(hit) OVER s AS hits
  FROM spans WINDOW s AS (PARTITION BY id_joueur, span ORDER BY date_match, id_match ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
span_runs AS (
  SELECT *, sum(hit) OVER (PARTITION BY id_joueur, span, misses ORDER BY date_match, id_match ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hit_run,
         sum(1 - hit) OVER (PARTITION BY id_joueur, span, hits ORDER BY date_match, id_match ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS miss_run
  FROM span_marked),
streak_long AS (
  SELECT * FROM (
    SELECT id_joueur, id_match, span, season_start_year,
           coalesce(max(hit_run) OVER b, 0) AS max_point_streak_last_2_seasons_pre,
           coalesce(max(miss_run) OVER b, 0) AS max_no_point_streak_last_2_seasons_pre,
           coalesce(sum(CASE WHEN hit_run = 5 AND hit = 1 THEN 1 ELSE 0 END) OVER b, 0) AS count_5plus_point_streaks_last_2_seasons_pre,
           count(*) OVER b AS count_matches_last_2_seasons_pre
    FROM span_runs WINDOW b AS (PARTITION BY id_joueur, span ORDER BY date_match, id_match ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
  WHERE span = season_start_year)"""

_TEMPORAL_FILL = {"0.45": ["point_hit_rate_last_5", "point_hit_rate_last_10", "point_hit_rate_last_20", "point_hit_rate_season_pre", "point_hit_rate_prev_season"],
                  "0.2": ["goal_hit_rate_last_10", "goal_hit_rate_season_pre", "goal_hit_rate_prev_season"],
                  "0.55": ["points_per_game_season_pre", "points_per_game_prev_season"],
                  "15.0": ["toi_moy_season_pre", "toi_moy_prev_season"], "1.5": ["pp_moy_season_pre", "pp_moy_prev_season"]}
_FILLED = ", ".join(f"coalesce({c}, {v}::DOUBLE) AS {c}" for v, cs in _TEMPORAL_FILL.items() for c in cs)
_ZEROED = ", ".join(
    f"coalesce({n}, 0::DOUBLE) AS {n}"
    for n in ("tirs_moy_5", "toi_moy_5", "pp_moy_5", "points_moy_5", "buts_moy_5", "passes_moy_5", "tirs_moy_10", "toi_moy_10",
              "points_moy_10", "buts_moy_10", "passes_moy_10")
)
_OWN = ("id_joueur, id_match, date_match, season_source, season_start_year, team_player_match, adversaire_match, is_home_player, "
        "id_equipe_domicile, id_equipe_exterieur, buts, passes, points, tirs, temps_de_glace, temps_pp, buts_domicile, buts_exterieur, "
        "a_marque_un_point, a_marque_un_but, nb_matchs_avant_match, nb_matchs_joues_10, jours_repos_raw")
TEMPORAL = FORM + SEASON + STREAKS + f""",
temporal AS (
  SELECT {_OWN}, {_ZEROED}, {_FILLED}, g AS season_games_before_match, coalesce(prev_season_games, 0) AS prev_season_games,
         least(greatest(coalesce(jours_repos_raw, 7), 0), 14) AS jours_repos,
         current_point_streak_pre, current_no_point_streak_pre, max_point_streak_last_2_seasons_pre, max_no_point_streak_last_2_seasons_pre,
         count_5plus_point_streaks_last_2_seasons_pre, count_matches_last_2_seasons_pre,
         coalesce(0.6 * coalesce(point_hit_rate_last_10, point_hit_rate_last_20) + 0.4 * coalesce(point_hit_rate_last_20, point_hit_rate_last_10), 0.45) AS recent_hit_rate_composite
  FROM form JOIN to_date USING (id_joueur, id_match) LEFT JOIN season_means USING (id_joueur, season_start_year)
  JOIN streak_now USING (id_joueur, id_match)
  JOIN (SELECT * EXCLUDE (span, season_start_year) FROM streak_long) USING (id_joueur, id_match))"""

_VS = ("points", "buts", "tirs")
OPPONENT = TEMPORAL + """,
versus AS (
  SELECT *, """ + ", ".join(f"(coalesce({s}_vs_adv_5, {s}_moy_10) * nb_matchs_vs_adv_avant + {s}_moy_10 * 3.0) / (nb_matchs_vs_adv_avant + 3.0) AS {s}_vs_adv_shrunk" for s in _VS) + """
  FROM (SELECT *, row_number() OVER o - 1 AS nb_matchs_vs_adv_avant, """ + ", ".join(
    f"avg({s}) OVER (o ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS {s}_vs_adv_5" for s in _VS
) + """
        FROM temporal WINDOW o AS (PARTITION BY id_joueur, adversaire_match ORDER BY date_match, id_match)))"""

ABSENCE = OPPONENT + """,
gaps AS (
  SELECT *, least(greatest(coalesce(jours_repos_raw, 3), 0), 90) AS jours_absence_pre_match,
         CASE WHEN jours_repos_raw >= 10 THEN 1 ELSE 0 END AS absence_longue_flag
  FROM versus),
opened AS (
  SELECT *, sum(absence_longue_flag) OVER (PARTITION BY id_joueur ORDER BY date_match, id_match ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS retour_episode
  FROM gaps),
since AS (
  SELECT *, row_number() OVER e - 1 AS matchs_depuis_retour_avant_match,
         max(CASE WHEN absence_longue_flag = 1 THEN toi_moy_10 END) OVER (PARTITION BY id_joueur, retour_episode) AS toi_pre_absence_ref,
         max(CASE WHEN absence_longue_flag = 1 THEN pp_moy_5 END) OVER (PARTITION BY id_joueur, retour_episode) AS pp_pre_absence_ref,
         avg(temps_de_glace) OVER (e ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS toi_moy_retour_3_avant_match,
         avg(temps_pp) OVER (e ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS pp_moy_retour_3_avant_match
  FROM opened WINDOW e AS (PARTITION BY id_joueur, retour_episode ORDER BY date_match, id_match)),
rated AS (
  SELECT *, CASE WHEN toi_pre_absence_ref <> 0 THEN toi_moy_retour_3_avant_match / toi_pre_absence_ref END AS ratio_toi,
         CASE WHEN pp_pre_absence_ref <> 0 THEN pp_moy_retour_3_avant_match / pp_pre_absence_ref END AS ratio_pp
  FROM since),
returned AS (
  SELECT *, CASE WHEN retour_episode > 0 AND matchs_depuis_retour_avant_match >= 3 AND coalesce(toi_moy_retour_3_avant_match, 0) >= 15
                  AND coalesce(ratio_toi, 0) >= 0.75 THEN 1 ELSE 0 END AS return_stabilized_flag
  FROM rated),
expected AS (
  SELECT *, CASE WHEN return_stabilized_flag = 1 THEN 0.8::DOUBLE ELSE 0.6::DOUBLE END AS w FROM returned),
blended AS (
  SELECT *, w * point_hit_rate_season_pre + (1 - w) * point_hit_rate_prev_season AS point_hit_rate_weighted_pre,
         w * points_per_game_season_pre + (1 - w) * points_per_game_prev_season AS points_per_game_weighted_pre,
         CASE WHEN current_point_streak_pre >= 5 AND count_5plus_point_streaks_last_2_seasons_pre < 2
               AND current_point_streak_pre >= max_point_streak_last_2_seasons_pre THEN 1 ELSE 0 END AS hard_exclude_hot_streak_pre
  FROM expected)"""

# `games` is the table of matches the team form is built on: id, day, season, teams, goals.
TEAM_FORM = """,
games AS (SELECT DISTINCT id_match, date_match, season_source, id_equipe_domicile, id_equipe_exterieur, buts_domicile, buts_exterieur FROM base),"""
_TEAM_FORM_TAIL = """
two_sides AS (
  SELECT id_match, date_match, season_source, id_equipe_domicile AS team_code, id_equipe_exterieur AS opp_code, buts_domicile AS gf, buts_exterieur AS ga, 1 AS is_home_team FROM games
  UNION ALL
  SELECT id_match, date_match, season_source, id_equipe_exterieur, id_equipe_domicile, buts_exterieur, buts_domicile, 0 FROM games),
team_line AS (
  SELECT *, row_number() OVER t - 1 AS team_games_played_pre_approx,
         least(greatest(coalesce(date_match - lag(date_match) OVER t, 3), 0), 14) AS jours_repos_team,
         avg(CASE WHEN gf > ga THEN 1 WHEN gf IS NOT NULL THEN 0 END) OVER (t ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS team_winrate_5,
         avg(gf) OVER (t ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS team_gf_moy_5,
         avg(ga) OVER (t ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS team_ga_moy_5,
         sum(is_home_team) OVER (t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stand
  FROM two_sides WINDOW t AS (PARTITION BY team_code, season_source ORDER BY date_match, id_match)),
team_form AS (
  SELECT *, sum(1 - is_home_team) OVER (PARTITION BY team_code, season_source, stand ORDER BY date_match, id_match ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS consecutive_away_games,
         CASE WHEN jours_repos_team <= 1 THEN 1 ELSE 0 END AS team_back_to_back,
         CASE WHEN jours_repos_team <= 1 AND is_home_team = 0 THEN 1 ELSE 0 END AS team_back_to_back_away
  FROM team_line)"""
TEAM_FORM = TEAM_FORM + _TEAM_FORM_TAIL

STANDINGS = """,
month_rows AS (
  SELECT last_day(date_match) AS date_snapshot, saison, id_equipe_domicile AS team_abbrev, buts_domicile AS gf, buts_exterieur AS ga FROM matches WHERE status = 'OFF'
  UNION ALL
  SELECT last_day(date_match), saison, id_equipe_exterieur, buts_exterieur, buts_domicile FROM matches WHERE status = 'OFF'),
month_teams AS (
  SELECT date_snapshot, saison, team_abbrev, count(*) AS n, sum(CASE WHEN gf > ga THEN 2 ELSE 0 END) AS p, sum(gf - ga) AS d FROM month_rows GROUP BY 1, 2, 3),
table_rows AS (
  SELECT date_snapshot, team_abbrev, sum(n) OVER s AS games_played, sum(p) OVER s AS points, sum(d) OVER s AS goal_differential, p AS l10_points,
         CASE WHEN ascii(team_abbrev) % 2 = 0 THEN 'E' ELSE 'W' END AS conference_abbrev,
         CASE WHEN ascii(team_abbrev) % 2 = 0 THEN 'E' ELSE 'W' END || CASE WHEN ascii(substr(team_abbrev, 2, 1)) % 2 = 0 THEN '1' ELSE '2' END AS division_abbrev
  FROM month_teams WINDOW s AS (PARTITION BY team_abbrev, saison ORDER BY date_snapshot)),
ranked_rows AS (
  SELECT *, row_number() OVER (PARTITION BY date_snapshot, conference_abbrev ORDER BY points DESC, team_abbrev) AS conference_sequence,
         row_number() OVER (PARTITION BY date_snapshot, division_abbrev ORDER BY points DESC, team_abbrev) AS division_sequence,
         greatest(0, 82 - games_played) AS games_remaining, points / (2.0 * games_played) AS point_pctg FROM table_rows),
cutoffs AS (
  SELECT date_snapshot, conference_abbrev, coalesce(max(CASE WHEN conference_sequence = 8 THEN points END), min(points)) AS conference_cutoff_points
  FROM ranked_rows GROUP BY 1, 2),
standing AS (
  SELECT r.*, r.conference_sequence - 4 AS wildcard_sequence, c.conference_cutoff_points, r.points - c.conference_cutoff_points AS wildcard_distance
  FROM ranked_rows r JOIN cutoffs c USING (date_snapshot, conference_abbrev))"""

ASOF = """,
team_context AS (
  SELECT f.*, s.date_snapshot AS seen_day, s.games_played AS games_played_pre, s.games_remaining AS games_remaining_pre, s.points AS points_pre,
         s.conference_sequence AS conference_sequence_pre, s.division_sequence AS division_sequence_pre, s.wildcard_distance AS wildcard_distance_pre,
         s.conference_cutoff_points AS conference_cutoff_points_pre, s.point_pctg AS point_pctg_pre, s.goal_differential AS goal_differential_pre,
         s.l10_points AS l10_points_pre, s.conference_abbrev AS conference_abbrev_pre
  FROM team_form f ASOF LEFT JOIN standing s ON f.team_code = s.team_abbrev AND (f.date_match - 1) >= s.date_snapshot)"""

CONTEXT = ABSENCE + TEAM_FORM + STANDINGS + ASOF + """,
pressed AS (
  SELECT b.*, c.* EXCLUDE (id_match, date_match, season_source, team_code, opp_code, gf, ga, stand),
         coalesce(c.games_played_pre, c.team_games_played_pre_approx) AS games_played_team_pre,
         least(greatest(coalesce(c.games_remaining_pre, 82 - coalesce(c.games_played_pre, c.team_games_played_pre_approx)), 0), 82) AS games_remaining_team_pre
  FROM blended b LEFT JOIN team_context c ON b.id_match = c.id_match AND b.team_player_match = c.team_code),
context AS (
  SELECT *, CASE WHEN games_remaining_team_pre <= 20 THEN 1 ELSE 0 END AS late_season_flag FROM pressed)"""
