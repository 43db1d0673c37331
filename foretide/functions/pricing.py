"""Odds arithmetic, ids, settlement and display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foretide import fixed
from foretide.functions.scalars import clip, col


def clip_probability(p) -> Column:
    return clip(p, fixed.PROBABILITY_EDGE, 1.0 - fixed.PROBABILITY_EDGE)


def logit(p) -> Column:
    q = clip_probability(p)
    return F.log(q / (1.0 - q))


def fair_odds(p) -> Column:
    return F.when(col(p) > 0, 1.0 / col(p))


def edge(p, implied) -> Column:
    return col(p) - col(implied)


def expected_value(p, odds) -> Column:
    """Expected profit of one unit staked at decimal odds."""
    return col(p) * (col(odds) - 1.0) - (1.0 - col(p))


def kelly(p, odds) -> Column:
    """Kelly stake, never negative; 0 for p <= 0 or odds <= 1; NULL in -> NULL out."""
    p, odds = col(p), col(odds)
    win = odds - 1.0
    stake = F.when((p <= 0) | (odds <= 1), 0.0).otherwise(F.greatest((win * p - (1.0 - p)) / win, F.lit(0.0)))
    return F.when(p.isNotNull() & odds.isNotNull(), stake)


def bet_id(date, bookmaker, market, stat, threshold, player, team, opponent) -> Column:
    """First 20 hex digits of SHA-1 over the eight fields; a whole threshold is written without decimals, any other
    with all of them."""
    number = col(threshold).cast("double")
    whole = F.when(number == F.floor(number), number.cast("bigint").cast("string"))
    line = F.when(number != 0, F.coalesce(whole, number.cast("string")))
    parts = [date, bookmaker, market, stat, line, player, team, opponent]
    text = [F.coalesce(col(p).cast("string"), F.lit("")) for p in parts]
    return F.substring(F.sha1(F.concat_ws("|", *text).cast("binary")), 1, 20)


def settle(actual, threshold, outcome_key) -> Column:
    """'win' / 'loss'; a key ending in _minus wins below the threshold, any other at or above it."""
    key = F.lower(F.trim(F.coalesce(col(outcome_key), F.lit(""))))
    actual, threshold = col(actual), col(threshold)
    won = F.when(key.endswith("_minus"), actual < threshold).otherwise(actual >= threshold)
    return F.when(actual.isNull() | threshold.isNull(), "").when(won, "win").otherwise("loss")


def value_flag(gap, threshold: float = fixed.VALUE_GAP) -> Column:
    return F.coalesce((col(gap) >= threshold).cast("int"), F.lit(0))


def value_label(value) -> Column:
    return F.when(col(value) == 1, "yes").otherwise("no")


def status(c) -> Column:
    """Missing, blank and 'nan' count as pending."""
    text = col(c)
    return F.when(text.isNull() | text.isin("", "nan"), "pending").otherwise(text)


def percent_text(c, digits: int = 2) -> Column:
    shown = F.format_string(f"%.{digits}f%%", col(c).cast("double") * 100)
    return F.when(col(c).isNull(), "").otherwise(shown)


def fixed_text(c, digits: int) -> Column:
    shown = F.format_string(f"%.{digits}f", col(c).cast("double"))
    return F.when(col(c).isNull(), "").otherwise(shown)


def judge(metric, current, baseline, tolerance: float = fixed.JUDGE_TOLERANCE) -> Column:
    """better / worse / equal against a stored value, by the direction of the metric; na if unknown."""
    metric = col(metric)
    sign = F.when(metric.isin(*fixed.LOWER_IS_BETTER), -1.0).when(metric.isin(*fixed.HIGHER_IS_BETTER), 1.0)
    gain = (col(current) - col(baseline)) * sign
    return (
        F.when(gain.isNull() | F.isnan(gain), "na")
        .when(gain > tolerance, "better")
        .when(gain < -tolerance, "worse")
        .otherwise("equal")
    )


def roll_up(better, worse) -> Column:
    better, worse = col(better) > 0, col(worse) > 0
    return (
        F.when(better & worse, "mixed").when(better, "improved").when(worse, "degraded").otherwise("unchanged")
    )


def recommendation(roll) -> Column:
    return (
        F.when(col(roll) == "improved", "keep_new_version")
        .when(col(roll) == "mixed", "review_new_version")
        .otherwise("rollback_or_debug")
    )
