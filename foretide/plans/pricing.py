"""Scores to priced edges, daily picks, settlement and display tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foretide import fixed
from foretide.functions import pricing as P
from foretide.functions import scalars as S
from foretide.operators import keyed as K
from foretide.operators import quality as Q
from foretide.operators.matching import Matches, match_rows, prepare_odds, prepare_predictions
from foretide.operators.ordered import keep_first, rank_rows
from foretide.session import written


def priced_edges(predictions: DataFrame, odds: DataFrame, run_date: str, fuzzy: bool = True,
                 by_day: bool | None = None) -> tuple[DataFrame, Matches]:
    """Match predictions to prices and price each match. Optional prediction flags are carried along."""
    result = match_rows(prepare_predictions(predictions), prepare_odds(odds), fuzzy=fuzzy, by_day=by_day)
    return edge_rows(result.matched, run_date), result


def edge_rows(matched: DataFrame, run_date: str) -> DataFrame:
    """All fields of a priced match."""
    p, o = F.col("proba_point_1p_calibree"), F.col("price.odds_decimal")
    implied, line = F.col("price.implied_probability"), F.col("price.threshold")
    day = F.date_format("date_match", "yyyy-MM-dd")
    gain = P.expected_value(p, o)
    hot = F.col("hard_exclude_hot_streak_pre") if "hard_exclude_hot_streak_pre" in matched.columns else F.lit(0)
    price = lambda c: F.col(f"price.{c}").alias(c)
    return matched.select(
        P.bet_id(day, F.col("price.bookmaker"), F.col("price.market"), F.col("price.stat"), line,
                 "player_name_normalized", "team_player_match", "adversaire_match").alias("bet_id"),
        F.lit(run_date).alias("run_date"),
        F.lit("pending").alias("bet_status"),
        F.lit("").alias("result"),
        F.lit(None).cast("double").alias("actual_stat_value"),
        F.lit("").alias("settled_at"),
        F.lit(False).alias("recommended_flag"),
        F.lit(None).cast("bigint").alias("recommendation_rank"),
        day.alias("date_match"),
        "id_match",
        "id_joueur",
        F.col("nom").alias("player_name"),
        "player_name_normalized",
        F.col("price.player_name").alias("player_name_bookmaker"),
        "position",
        F.col("team_player_match").alias("team"),
        F.col("adversaire_match").alias("opponent"),
        F.col("is_home_player").alias("is_home"),
        F.col("team_primary_name").alias("team_name_model"),
        F.col("opponent_primary_name").alias("opponent_name_model"),
        price("bookmaker"), price("market"), price("stat"),
        line.cast("bigint").alias("threshold"),
        price("outcome_label"), price("outcome_key"), price("event_url"), price("event_id"), price("event_slug"),
        price("home_team"), price("away_team"),
        F.col("price.team").alias("team_name_bookmaker"),
        o.alias("odds_decimal"),
        implied.alias("implied_probability"),
        F.col("proba_point_1p_raw").alias("model_probability_raw"),
        p.alias("model_probability"),
        P.fair_odds(p).alias("fair_odds_model"),
        P.edge(p, implied).alias("edge_probability"),
        (P.edge(p, implied) * 100.0).alias("edge_probability_pct_points"),
        gain.alias("ev_per_unit"),
        P.kelly(p, o).alias("kelly_fraction"),
        F.coalesce(gain > 0, F.lit(False)).alias("is_positive_ev"),
        "rank_proba_sur_date",
        "rank_proba_sur_match",
        F.col("stage").alias("match_method"),
        "fuzzy_score",
        F.coalesce(hot.cast("int"), F.lit(0)).alias("hard_exclude_hot_streak_pre"),
    )


def positive_edges(edges: DataFrame) -> DataFrame:
    return edges.filter(F.col("ev_per_unit") > 0)


def by_value(edges: DataFrame) -> DataFrame:
    """Best expected value first."""
    return edges.orderBy(F.desc("ev_per_unit"), F.desc("edge_probability"), F.desc("model_probability"), "bet_id")


# ------------------------------------------------------------------ daily picks

RANKING = ["model_probability", "edge_probability", "odds_decimal"]


def _best_first(*ids):
    return [F.col(c).desc_nulls_last() for c in RANKING] + [F.col(i) for i in ids]


def load_candidates(edges: DataFrame) -> DataFrame:
    """Typed candidates with optional columns created and statuses normalised."""
    Q.require_columns(edges, ["bet_id", "run_date", "player_name", "odds_decimal", "implied_probability", "model_probability"], "candidates")
    out = Q.with_missing(edges, {"hard_exclude_hot_streak_pre": F.lit(0), "result": F.lit(""), "settled_at": F.lit("")})
    return out.withColumns(
        {
            "bet_status": P.status("bet_status"),
            "result": F.coalesce(F.nullif("result", F.lit("nan")), F.lit("")),
            "value_gap": P.edge("model_probability", "implied_probability"),
            "hard_exclude_hot_streak_pre": F.coalesce(F.col("hard_exclude_hot_streak_pre").cast("int"), F.lit(0)),
        }
    )


def latest_run(candidates: DataFrame) -> str:
    """Greatest non-empty run date."""
    run = candidates.agg(F.max(F.when(~F.col("run_date").isin("", "nan"), F.col("run_date")))).first()[0]
    if run is None:
        raise Q.DataProblem("no run_date in the candidates")
    return run


def daily_picks(candidates: DataFrame, run_date: str, max_picks: int = fixed.MAX_PICKS, min_odds: float = fixed.MIN_ODDS,
                override: float = fixed.OVERRIDE_PROBABILITY, value_gap: float = fixed.VALUE_GAP,
                one_per_player: bool = True, exclude_hot: bool = True) -> DataFrame:
    """Ranked short list of a run: long enough odds or a very likely outcome, best row per player."""
    picks = eligible(candidates.filter(F.col("run_date") == run_date), min_odds, override)
    if exclude_hot:
        picks = picks.filter(F.col("hard_exclude_hot_streak_pre") != 1)
    if one_per_player:
        picks = keep_first(picks, ["player_name"], _best_first("bet_id"))
    # The limit is the feature; it runs as a distributed top-k. 0 means no limit. Ranks count the rows before they number
    # them, and a display ranks again: the picks are written, so that this does not match and price everything once more.
    if max_picks > 0:
        w = Window.orderBy(*_best_first("bet_id"))  # at most max_picks rows
        picks = written(picks.orderBy(*_best_first("bet_id")).limit(max_picks)).withColumn("recommendation_rank", F.row_number().over(w))
    else:
        picks = rank_rows(written(picks.drop("recommendation_rank")), [], _best_first("bet_id"), "recommendation_rank")
    picks = picks.withColumns(
        {
            "recommended_flag": F.lit(True),
            "display_rank": F.col("recommendation_rank"),
            "bet_status": P.status("bet_status"),
            "is_value_bet": P.value_flag("value_gap", value_gap),
        }
    )
    picks = picks.withColumn("is_value_bet_label", P.value_label("is_value_bet"))
    front = ["bet_id", "run_date", "recommended_flag", "recommendation_rank", "display_rank", "bet_status", "result"]
    return Q.known_first(picks, front)


def eligible(candidates: DataFrame, min_odds: float = fixed.MIN_ODDS, override: float = fixed.OVERRIDE_PROBABILITY) -> DataFrame:
    return candidates.filter((F.col("odds_decimal") >= min_odds) | (F.col("model_probability") >= override))


def pick_counts(candidates: DataFrame, run_date: str, min_odds: float = fixed.MIN_ODDS,
                override: float = fixed.OVERRIDE_PROBABILITY) -> DataFrame:
    """What each step of the pick builder removes, in one aggregation."""
    keep = F.coalesce((F.col("odds_decimal") >= min_odds) | (F.col("model_probability") >= override), F.lit(False))
    hot = F.col("hard_exclude_hot_streak_pre") == 1
    return candidates.filter(F.col("run_date") == run_date).agg(
        F.count(F.lit(1)).alias("rows_after_run_date_filter"),
        F.count_if(~keep).alias("rows_removed_low_odds"),
        F.count_if(keep & hot).alias("rows_removed_hot_streak"),
        F.count_distinct(F.when(keep & ~hot, F.col("player_name"))).alias("rows_after_player_dedup"),
    )


# ------------------------------------------------------------------ settlement


def settle(history: DataFrame, stats: DataFrame, run_date: str, settled_at: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(updated history, settled rows, unresolved rows) for pending bets on matches before run_date."""
    Q.require_columns(history, ["bet_id", "run_date", "bet_status", "date_match", "id_match", "id_joueur", "threshold", "outcome_key"], "history")
    actual = K.keep_last(stats, ["id_match", "id_joueur"], ["date_match", "points"]).select(
        "id_match", "id_joueur", F.col("points").cast("double").alias("actual_points")
    )
    due = history.filter(
        (F.col("bet_status") == "pending") & (S.day("date_match") < F.lit(run_date).cast("date"))
    )
    looked_up = due.drop("actual_stat_value").join(actual, ["id_match", "id_joueur"], "left")
    looked_up = looked_up.withColumnRenamed("actual_points", "actual_stat_value").withColumn(
        "result", P.settle("actual_stat_value", "threshold", "outcome_key")
    )
    settled = looked_up.filter(F.col("actual_stat_value").isNotNull())
    unresolved = looked_up.filter(F.col("actual_stat_value").isNull())
    # One change row per bet: a bet listed under two matches of one id would otherwise multiply rows.
    changes = keep_first(settled, ["bet_id", "id_match", "id_joueur"], ["run_date", "threshold", "outcome_key"]).select(
        "bet_id", "id_match", "id_joueur", "actual_stat_value", "result",
        F.lit("settled").alias("bet_status"), F.lit(settled_at).alias("settled_at"),
    )
    pending = history.filter(F.col("bet_status") == "pending")
    others = history.filter(F.coalesce(F.col("bet_status") != "pending", F.lit(True)))
    updated = K.set_where_found(pending, changes, ["bet_id", "id_match", "id_joueur"],
                                ["actual_stat_value", "result", "bet_status", "settled_at"])
    return updated.unionByName(others), settled, unresolved


# ------------------------------------------------------------------ display


def daily_display(picks: DataFrame) -> DataFrame:
    """Recommended picks as text, best first."""
    shown = picks.filter(S.shown_as_true("recommended_flag"))
    shown = rank_rows(shown.drop("display_rank"), [], _best_first("bet_id"), "display_rank")
    return shown.select(
        "display_rank", "run_date", "date_match", _shown_name(picks).alias("player_name"), "team", "opponent", "market",
        P.fixed_text("odds_decimal", 2).alias("odds_decimal"),
        P.percent_text("implied_probability").alias("implied_probability_pct"),
        P.percent_text("model_probability").alias("model_probability_pct"),
        P.fixed_text(F.col("edge_probability") * 100, 2).alias("edge_probability_pct"),
    )


def history_display(history: DataFrame) -> DataFrame:
    """History as text columns."""
    return history.select(
        "bet_id", "run_date", "date_match", _shown_name(history).alias("player_name"), "team", "opponent", "bookmaker", "market", "stat",
        P.fixed_text("threshold", 0).alias("threshold"),
        P.fixed_text("odds_decimal", 2).alias("odds_decimal"),
        P.percent_text("implied_probability").alias("implied_probability_pct"),
        P.percent_text("model_probability").alias("model_probability_pct"),
        P.fixed_text(F.col("edge_probability") * 100, 2).alias("edge_probability_pct"),
        "bet_status", "result", P.fixed_text("actual_stat_value", 0).alias("actual_stat_value"), "settled_at",
    )


def _shown_name(df):
    return F.col("player_name_bookmaker" if "player_name_bookmaker" in df.columns else "player_name")


def merge_display_history(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Filled fields of the new display rows replace stored ones; new ids are added."""
    blank = {c: F.lit("") for c in fixed.HISTORY_COLUMNS}
    stored = Q.with_missing(stored, blank).select(*fixed.HISTORY_COLUMNS)
    batch = Q.with_missing(batch, blank).select(*fixed.HISTORY_COLUMNS)
    return K.merge_filled(stored, batch, ["bet_id"])
