"""Values that results depend on: column contracts, defaults, word lists and lookup tables."""

# ---- FIXED VALUES: team and position codes --------------------------------------------------
TEAM_CODE_ALIASES = {"ARI": "UTA", "PHX": "UTA", "PHO": "UTA"}

POSITION_ALIASES = {"LW": "L", "RW": "R", "LD": "D", "RD": "D"}

DEFENCE_BUCKETS = ["defensemen", "defense"]
DEFENCE_BUCKETS_BOXSCORE = ["defense", "defensemen", "defencemen"]
GOALIE_BUCKETS = ["goalies", "goalie"]

# Normalised names each team code is sold under, main name first.
TEAM_NAMES = {
    "ANA": ["anaheim ducks"],
    "BOS": ["boston bruins"],
    "BUF": ["buffalo sabres"],
    "CGY": ["calgary flames"],
    "CAR": ["carolina hurricanes"],
    "CHI": ["chicago blackhawks"],
    "COL": ["colorado avalanche"],
    "CBJ": ["columbus blue jackets"],
    "DAL": ["dallas stars"],
    "DET": ["detroit red wings"],
    "EDM": ["edmonton oilers"],
    "FLA": ["florida panthers"],
    "LAK": ["los angeles kings", "la kings"],
    "MIN": ["minnesota wild"],
    "MTL": ["montreal canadiens"],
    "NSH": ["nashville predators"],
    "NJD": ["new jersey devils"],
    "NYI": ["new york islanders"],
    "NYR": ["new york rangers"],
    "OTT": ["ottawa senators"],
    "PHI": ["philadelphia flyers"],
    "PIT": ["pittsburgh penguins"],
    "SJS": ["san jose sharks"],
    "SEA": ["seattle kraken"],
    "STL": ["st. louis blues", "st louis blues"],
    "TBL": ["tampa bay lightning"],
    "TOR": ["toronto maple leafs"],
    "UTA": ["utah mammoth", "utah hockey club"],
    "VAN": ["vancouver canucks"],
    "VGK": ["vegas golden knights"],
    "WSH": ["washington capitals"],
    "WPG": ["winnipeg jets"],
}

# Short names used when a box score does not carry one.
TEAM_NICKNAMES = {
    "ANA": "Ducks", "ARI": "Coyotes", "BOS": "Bruins", "BUF": "Sabres",
    "CAR": "Hurricanes", "CBJ": "Blue Jackets", "CGY": "Flames", "CHI": "Blackhawks",
    "COL": "Avalanche", "DAL": "Stars", "DET": "Red Wings", "EDM": "Oilers",
    "FLA": "Panthers", "LAK": "Kings", "MIN": "Wild", "MTL": "Canadiens",
    "NJD": "Devils", "NSH": "Predators", "NYI": "Islanders", "NYR": "Rangers",
    "OTT": "Senators", "PHI": "Flyers", "PIT": "Penguins", "SEA": "Kraken",
    "SJS": "Sharks", "STL": "Blues", "TBL": "Lightning", "TOR": "Maple Leafs",
    "UTA": "Utah Hockey Club", "VAN": "Canucks", "VGK": "Golden Knights", "WPG": "Jets",
    "WSH": "Capitals",
}

# (team, first season, last season) for teams that do not exist in every season.
TEAM_SEASONS = [("UTA", 20242025, None), ("ARI", None, 20232024), ("SEA", 20212022, None)]

TEAMS_PER_DAY = 32
GAMES_PER_SEASON = 82
PLAYER_NAME_OVERRIDES = {"sebastian aho fin": "sebastian aho"}

# ---- FIXED VALUES: text read as true, false or missing ---------------------------------------
TRUE_WORDS = ["1", "1.0", "true", "t", "yes", "y", "ok"]
FALSE_WORDS = ["0", "0.0", "false", "f", "no", "n"]
DISPLAY_TRUE_WORDS = ["true", "1", "yes"]

# ---- FIXED VALUES: feature constants and defaults --------------------------------------------
SHRINK_GAMES = 3.0
ABSENCE_DAYS = 10
RETURN_MIN_RATIO = 0.75
RETURN_MIN_TOI = 15.0
CURRENT_WEIGHT = 0.60
CURRENT_WEIGHT_AFTER_RETURN = 0.80
LONG_STREAK = 5
LATE_SEASON_GAMES = 20
LOOKBACK_DAYS = 45
CUTOFF_RANK = 8

TEMPORAL_DEFAULTS = {
    "tirs_moy_5": 0.0, "toi_moy_5": 0.0, "pp_moy_5": 0.0, "points_moy_5": 0.0,
    "buts_moy_5": 0.0, "passes_moy_5": 0.0, "tirs_moy_10": 0.0, "toi_moy_10": 0.0,
    "points_moy_10": 0.0, "buts_moy_10": 0.0, "passes_moy_10": 0.0,
    "season_point_hits_before_match": 0.0, "season_goal_hits_before_match": 0.0,
    "season_points_before_match": 0.0, "season_toi_before_match": 0.0, "season_pp_before_match": 0.0,
    "prev_season_games": 0,
    "point_hit_rate_last_5": 0.45, "point_hit_rate_last_10": 0.45, "point_hit_rate_last_20": 0.45,
    "goal_hit_rate_last_10": 0.20,
    "point_hit_rate_season_pre": 0.45, "goal_hit_rate_season_pre": 0.20,
    "points_per_game_season_pre": 0.55, "toi_moy_season_pre": 15.0, "pp_moy_season_pre": 1.5,
    "point_hit_rate_prev_season": 0.45, "goal_hit_rate_prev_season": 0.20,
    "points_per_game_prev_season": 0.55, "toi_moy_prev_season": 15.0, "pp_moy_prev_season": 1.5,
    "recent_hit_rate_composite": 0.45,
}

CONTEXT_DEFAULTS = {
    "jours_repos_team": 3, "team_back_to_back": 0, "team_back_to_back_away": 0,
    "consecutive_away_games": 0, "team_winrate_5": 0.5, "team_gf_moy_5": 2.8, "team_ga_moy_5": 2.8,
    "team_games_played_pre_approx": 0,
    "ratio_toi_retour_vs_pre_absence": 0.0, "ratio_pp_retour_vs_pre_absence": 0.0,
    "point_hit_rate_weighted_pre": 0.45, "points_per_game_weighted_pre": 0.55,
    "recent_vs_expected_gap": 0.0,
    "games_played_team_pre": 0.0, "games_remaining_team_pre": 82.0,
    "conference_rank_pre": 8.5, "division_rank_pre": 4.5, "wildcard_distance_pre": 0.0,
}

# ---- FIXED VALUES: pricing -------------------------------------------------------------------
FUZZY_MIN_SCORE = 0.965
MIN_ODDS = 1.40
OVERRIDE_PROBABILITY = 0.90
VALUE_GAP = 0.02
PROBABILITY_EDGE = 1e-6
JUDGE_TOLERANCE = 1e-12

LOWER_IS_BETTER = ["logloss", "brier"]
HIGHER_IS_BETTER = ["auc", "avg_precision"]

# Published quality of the stored model: split -> metric -> value.
BASELINE_METRICS = {
    "validation_raw": {"brier": 0.222318, "logloss": 0.636226, "auc": 0.686842, "avg_precision": 0.523736},
    "test_raw": {"brier": 0.224014, "logloss": 0.640154, "auc": 0.678702, "avg_precision": 0.522698},
    "validation_calibrated": {"brier": 0.202690, "logloss": 0.592299, "auc": 0.686842, "avg_precision": 0.523736},
    "test_calibrated": {"brier": 0.205518, "logloss": 0.599639, "auc": 0.678702, "avg_precision": 0.522698},
}

ODDS_ENVELOPE = ["bookmaker", "market", "stat", "threshold", "outcome_label", "rows"]
ODDS_ROW = [
    "bookmaker", "market", "stat", "threshold", "outcome_label", "outcome_key", "event_url", "event_id",
    "event_slug", "home_team", "away_team", "team", "player_name", "odds_decimal", "implied_probability",
]
PREDICTION_COLUMNS = [
    "date_match", "id_match", "id_joueur", "nom", "position", "team_player_match", "adversaire_match",
    "is_home_player", "proba_point_1p_calibree", "proba_point_1p_raw", "rank_proba_sur_date",
    "rank_proba_sur_match",
]
HISTORY_COLUMNS = [
    "bet_id", "run_date", "date_match", "player_name", "team", "opponent", "bookmaker", "market", "stat",
    "threshold", "odds_decimal", "implied_probability_pct", "model_probability_pct", "edge_probability_pct",
    "bet_status", "result", "actual_stat_value", "settled_at",
]

# Standings measures: stored name -> field in the document.
STANDINGS_TEXT = {
    "api_date": "date", "season_id": "seasonId", "conference_abbrev": "conferenceAbbrev",
    "conference_name": "conferenceName", "division_abbrev": "divisionAbbrev",
    "division_name": "divisionName", "streak_code": "streakCode", "team_logo": "teamLogo",
}
STANDINGS_LOCALISED = {
    "team_abbrev": "teamAbbrev", "team_name": "teamName", "team_common_name": "teamCommonName",
}
STANDINGS_NUMBERS = {
    "games_played": "gamesPlayed", "points": "points", "point_pctg": "pointPctg", "wins": "wins",
    "losses": "losses", "ot_losses": "otLosses", "regulation_wins": "regulationWins",
    "regulation_plus_ot_wins": "regulationPlusOtWins", "goal_for": "goalFor", "goal_against": "goalAgainst",
    "goal_differential": "goalDifferential", "league_sequence": "leagueSequence",
    "conference_sequence": "conferenceSequence", "division_sequence": "divisionSequence",
    "wildcard_sequence": "wildcardSequence", "waivers_sequence": "waiversSequence",
    "streak_count": "streakCount", "l10_games_played": "l10GamesPlayed", "l10_wins": "l10Wins",
    "l10_losses": "l10Losses", "l10_ot_losses": "l10OtLosses", "l10_points": "l10Points",
    "home_games_played": "homeGamesPlayed", "home_points": "homePoints",
    "road_games_played": "roadGamesPlayed", "road_points": "roadPoints",
}

STANDINGS_ASOF = [
    "conference_abbrev", "division_abbrev", "games_played", "games_remaining", "points",
    "conference_sequence", "division_sequence", "wildcard_sequence", "conference_cutoff_points",
    "wildcard_distance", "point_pctg", "goal_differential", "l10_points", "standings_lookup_date",
]

# ---- FIXED VALUES: pick selection ------------------------------------------------------------
MAX_PICKS = 10

# ---- FIXED VALUES: model features ------------------------------------------------------------
TARGET = "a_marque_un_point"

CORE_FEATURES = [
    "is_home_player", "jours_repos", "nb_matchs_avant_match", "nb_matchs_joues_10", "tirs_moy_5",
    "toi_moy_5", "pp_moy_5", "points_moy_5", "buts_moy_5", "passes_moy_5", "tirs_moy_10", "toi_moy_10",
    "points_moy_10", "buts_moy_10", "tirs_par_60_5", "points_par_60_5", "buts_par_60_5", "hist_ok_5",
    "hist_ok_10", "is_premier_match_joueur",
]
TEAM_FEATURES = [
    "jours_repos_team", "team_back_to_back", "team_back_to_back_away", "consecutive_away_games",
    "team_winrate_5", "team_gf_moy_5", "team_ga_moy_5", "team_context_found",
]
OPPONENT_FEATURES = [
    "nb_matchs_vs_adv_avant", "points_vs_adv_shrunk", "buts_vs_adv_shrunk", "tirs_vs_adv_shrunk",
]
RETURN_FEATURES = [
    "jours_absence_pre_match", "absence_longue_flag", "matchs_depuis_retour_avant_match",
    "ratio_toi_retour_vs_pre_absence", "ratio_pp_retour_vs_pre_absence",
]
FEATURE_FAMILIES = {
    "core": CORE_FEATURES,
    "core_plus_team": CORE_FEATURES + TEAM_FEATURES,
    "core_plus_vs_adv": CORE_FEATURES + OPPONENT_FEATURES,
    "core_plus_return_absence": CORE_FEATURES + RETURN_FEATURES,
    "core_plus_team_vs_adv": CORE_FEATURES + TEAM_FEATURES + OPPONENT_FEATURES,
    "full": CORE_FEATURES + TEAM_FEATURES + OPPONENT_FEATURES + RETURN_FEATURES,
}
# FIXED VALUES: what stands for a missing value of each feature in the ablation.
ABLATION_FILLS = {
    "is_home_player": 0, "jours_repos": 7, "nb_matchs_avant_match": 0, "nb_matchs_joues_10": 0,
    "tirs_moy_5": 0.0, "toi_moy_5": 0.0, "pp_moy_5": 0.0, "points_moy_5": 0.0, "buts_moy_5": 0.0, "passes_moy_5": 0.0,
    "tirs_moy_10": 0.0, "toi_moy_10": 0.0, "points_moy_10": 0.0, "buts_moy_10": 0.0,
    "tirs_par_60_5": 0.0, "points_par_60_5": 0.0, "buts_par_60_5": 0.0,
    "hist_ok_5": 0, "hist_ok_10": 0, "is_premier_match_joueur": 0,
    "jours_repos_team": 3, "team_back_to_back": 0, "team_back_to_back_away": 0, "consecutive_away_games": 0,
    "team_winrate_5": 0.5, "team_gf_moy_5": 2.8, "team_ga_moy_5": 2.8, "team_context_found": 0,
    "nb_matchs_vs_adv_avant": 0, "points_vs_adv_shrunk": 0.0, "buts_vs_adv_shrunk": 0.0, "tirs_vs_adv_shrunk": 0.0,
    "jours_absence_pre_match": 3, "absence_longue_flag": 0, "matchs_depuis_retour_avant_match": 0,
    "ratio_toi_retour_vs_pre_absence": 0.0, "ratio_pp_retour_vs_pre_absence": 0.0, "eligible_post_retour": 0,
}

BASELINE_FEATURES = [
    "is_home_player", "saison", "nb_matchs_avant_match", "jours_repos_raw", "is_premier_match_joueur",
    "jours_repos", "tirs_moy_5", "toi_moy_5", "pp_moy_5", "points_moy_5", "buts_moy_5", "passes_moy_5",
    "tirs_moy_10", "toi_moy_10", "points_moy_10", "buts_moy_10", "passes_moy_10", "nb_matchs_joues_10",
    "hist_ok_5", "hist_ok_10", "tirs_par_60_5", "points_par_60_5", "buts_par_60_5",
    "nb_matchs_vs_adv_avant", "points_vs_adv_5", "buts_vs_adv_5", "tirs_vs_adv_5", "points_vs_adv_shrunk",
    "buts_vs_adv_shrunk", "tirs_vs_adv_shrunk", "jours_absence_pre_match", "games_missed_proxy",
    "absence_longue_flag", "retour_episode", "return_from_absence_flag", "matchs_depuis_retour_avant_match",
    "toi_pre_absence_ref", "pp_pre_absence_ref", "toi_moy_retour_3_avant_match",
    "pp_moy_retour_3_avant_match", "ratio_toi_retour_vs_pre_absence", "ratio_pp_retour_vs_pre_absence",
    "return_stabilized_flag", "historical_current_weight", "historical_prev_weight",
    "point_hit_rate_last_5", "point_hit_rate_last_10", "point_hit_rate_last_20",
    "point_hit_rate_season_pre", "point_hit_rate_prev_season", "point_hit_rate_weighted_pre",
    "points_per_game_season_pre", "points_per_game_prev_season", "points_per_game_weighted_pre",
    "recent_vs_expected_gap", "current_point_streak_pre", "current_no_point_streak_pre",
    "max_point_streak_last_2_seasons_pre", "max_no_point_streak_last_2_seasons_pre",
    "count_5plus_point_streaks_last_2_seasons_pre",
]
ENRICHED_FEATURES = BASELINE_FEATURES + [
    "is_home_team", "jours_repos_team", "team_back_to_back", "team_back_to_back_away",
    "consecutive_away_games", "team_winrate_5", "team_gf_moy_5", "team_ga_moy_5",
    "team_games_played_pre_approx", "games_played_team_pre", "games_remaining_team_pre", "team_points_pre",
    "conference_rank_pre", "division_rank_pre", "conference_cutoff_points_pre", "wildcard_distance_pre",
    "point_pctg_pre", "goal_differential_pre", "l10_points_pre", "late_season_flag",
    "playoff_pressure_simple",
]
# Never allowed as features: the target, this match's own results, ids, dates, texts, selection rules.
FORBIDDEN_FEATURES = [
    "target_point_1p", "target_points_1p", "target_point", "label_point_1p", "y_point", "point_1p",
    "a_marque_un_point", "a_marque_un_but", "buts", "passes", "points", "tirs", "temps_de_glace",
    "temps_pp", "plus_moins", "penalty_minutes", "buts_domicile", "buts_exterieur", "buts_match_equipe",
    "buts_match_adversaire", "victoire_equipe", "defaite_equipe", "diff_buts_equipe", "status", "_merge",
    "match_trouve", "team_attendue_match", "adversaire_attendu_match", "check_team_ok", "check_opp_ok",
    "team_context_found", "check_home_team_context_ok", "id_match", "id_joueur", "date_match",
    "date_match_match", "date", "match_date", "game_date", "date_game", "team_player_match",
    "adversaire_match", "team_name_match", "opponent_name_match", "nom", "player_name", "position",
    "home_road_flag", "season_source", "standings_lookup_date_pre", "hard_exclude_hot_streak_pre",
    "is_value_bet", "value_gap", "id_equipe_domicile", "id_equipe_exterieur",
]

# FIXED VALUES: fewest usable features of a model variant.
LEAST_FEATURES = {"baseline": 8}

# Accepted names of a table's date column, in order.
DATE_COLUMNS = ("date_match", "game_date", "date", "match_date")
