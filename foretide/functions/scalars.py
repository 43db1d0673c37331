"""Cleaning and conversion expressions. Bad input gives NULL, never an error (ANSI mode safe)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foretide import fixed

_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_CLOCK = r"^[0-9]+:[0-9]+$"
_WHOLE = r"^[+-]?[0-9]+$"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use) -> Column:
    """use(value), with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def lookup(table: dict) -> Column:
    """A fixed text -> text table as a map. One literal, folded to a constant by the optimizer."""
    packed = "\u0001".join(f"{k}\u0002{v}" for k, v in table.items())
    return F.str_to_map(F.lit(packed), F.lit("\u0001"), F.lit("\u0002"))


# ------------------------------------------------------------------ text and numbers


def clean_text(c) -> Column:
    """Trimmed text, empty -> NULL."""
    return F.nullif(F.trim(col(c).cast("string")), F.lit(""))


def number(c) -> Column:
    """Text or number -> double; anything else -> NULL (also NaN)."""
    text = F.trim(col(c).cast("string"))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def real(c) -> Column:
    """Numeric column -> double with NaN and infinities as NULL."""
    x = col(c).cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def numeric(df: DataFrame, name: str) -> Column:
    """Column as double: a plain cast for numeric types, text parsing only for text."""
    if isinstance(df.schema[name].dataType, T.NumericType):
        return real(name) if isinstance(df.schema[name].dataType, T.FractionalType) else col(name).cast("double")
    return number(name)


def identifier(df: DataFrame, name: str) -> Column:
    """Column as bigint, parsed only when it is text."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return col(name).cast("bigint")
    return whole_from_decimal(name)


def whole(c) -> Column:
    """Integer text or number -> bigint; decimals in text -> NULL."""
    text = F.trim(col(c).cast("string"))
    return F.when(text.rlike(_WHOLE), text.try_cast("bigint"))


def whole_from_decimal(c) -> Column:
    """Like `whole`, but 12.7 gives 12."""
    return number(c).try_cast("bigint")


def day(c) -> Column:
    """Text or timestamp -> date; bad -> NULL."""
    return col(c).try_cast("date")


def day_text(c) -> Column:
    return F.date_format(day(c), "yyyy-MM-dd")


def first_of(*cs) -> Column:
    return F.coalesce(*[col(c) for c in cs])


# ------------------------------------------------------------------ codes


def recode(c: Column, table: dict) -> Column:
    """Replace a few listed codes; every other code stays."""
    return F.coalesce(F.try_element_at(lookup(table), c), c)


def team_code(c) -> Column:
    """Upper-case code with relocated teams mapped to their present code; blank -> NULL."""
    return recode(upper_code(c), fixed.TEAM_CODE_ALIASES)


def upper_code(c) -> Column:
    return F.upper(clean_text(c))


def position(c) -> Column:
    return recode(upper_code(c), fixed.POSITION_ALIASES)


def bucket_position(bucket, defence=tuple(fixed.DEFENCE_BUCKETS)) -> Column:
    """Position implied by the name of the list a player stands in."""
    name = F.lower(col(bucket))
    return F.when(name.isin(*defence), "D").when(is_goalie_bucket(bucket), "G")


def is_goalie_bucket(bucket) -> Column:
    return F.lower(col(bucket)).isin(*fixed.GOALIE_BUCKETS)


def team_valid_for_season(team, season) -> Column:
    """False for a team outside the seasons it played in."""
    ok = F.lit(True)
    for code, first, last in fixed.TEAM_SEASONS:
        inside = F.lit(True)
        if first is not None:
            inside = inside & (col(season) >= first)
        if last is not None:
            inside = inside & (col(season) <= last)
        ok = F.when(col(team) == code, inside).otherwise(ok)
    return ok


# ------------------------------------------------------------------ seasons and dates


def season_code(c) -> Column:
    """Eight-character season code ('20232024'); shorter -> NULL."""
    text = F.regexp_replace(F.trim(col(c).cast("string")), r"[.]0$", "")
    return F.when(F.length(text) >= 8, F.substring(text, 1, 8))


def season_start_year(c) -> Column:
    return F.substring(F.trim(col(c).cast("string")), 1, 4).try_cast("int")


def previous_season(c) -> Column:
    code = season_code(c)
    start = F.substring(code, 1, 4).try_cast("int") - 1
    end = F.substring(code, 5, 4).try_cast("int") - 1
    return F.when(start.isNotNull() & end.isNotNull(), F.concat(start.cast("string"), end.cast("string")))


def month_chunks(start, end) -> Column:
    """Array of (chunk_start, chunk_end), one per calendar month touched, clipped to the range."""
    start, end = col(start), col(end)
    months = F.sequence(F.trunc(start, "month"), end, F.expr("interval 1 month"))
    chunk = lambda m: F.struct(
        F.greatest(m, start).alias("chunk_start"), F.least(F.last_day(m), end).alias("chunk_end")
    )
    return F.when(start <= end, F.transform(months, chunk))


def days_between(start, end) -> Column:
    start, end = col(start), col(end)
    return F.when(start <= end, F.sequence(start, end, F.expr("interval 1 day")))


def today_in(zone: str, now_utc=None) -> Column:
    """Calendar day in a time zone; pass `now_utc` for a repeatable result."""
    now = F.current_timestamp() if now_utc is None else col(now_utc)
    return F.to_date(F.from_utc_timestamp(now, zone)) if now_utc is not None else F.to_date(
        F.convert_timezone(F.current_timezone(), F.lit(zone), now.cast("timestamp_ntz"))
    )


# ------------------------------------------------------------------ durations and flags


def minutes(c) -> Column:
    """'MM:SS', 'HH:MM:SS' or plain minutes -> minutes."""
    return _minutes(c, 1.0)


def minutes_from_seconds(c) -> Column:
    """Like `minutes`, but a plain number counts seconds."""
    return _minutes(c, 60.0)


def _minutes(c, per_minute: float) -> Column:
    text = F.trim(col(c).cast("string"))

    def other(text):
        first, last = F.substring_index(text, ":", 1), F.substring_index(text, ":", -1)
        middle = F.substring_index(F.substring_index(text, ":", 2), ":", -1)
        colons = F.length(text) - F.length(F.replace(text, F.lit(":"), F.lit("")))
        return (
            F.when(colons == 0, number(text) / per_minute)
            .when(colons == 1, number(first) + number(last) / 60.0)
            .when(colons == 2, number(first) * 60.0 + number(middle) + number(last) / 60.0)
        )

    # The plain clock form comes first: it needs one pattern test and two casts. The other forms stand in a lambda, which keeps
    # their many tests out of the generated code; with them it is too long to be compiled.
    first, last = F.substring_index(text, ":", 1), F.substring_index(text, ":", -1)
    return F.when(text.rlike(_CLOCK), first.cast("double") + last.cast("double") / 60.0).otherwise(let(text, other))


def flag(c) -> Column:
    """True / yes / 1 -> 1.0, false / no / 0 -> 0.0, other numbers unchanged, anything else NULL."""
    text = F.lower(F.trim(col(c).cast("string")))
    return F.when(text.isin(*fixed.TRUE_WORDS), 1.0).when(text.isin(*fixed.FALSE_WORDS), 0.0).otherwise(number(text))


def shown_as_true(c) -> Column:
    """Flag test used for display tables."""
    return F.coalesce(F.lower(F.trim(col(c).cast("string"))).isin(*fixed.DISPLAY_TRUE_WORDS), F.lit(False))


# ------------------------------------------------------------------ arithmetic


def clip(c, low=None, high=None) -> Column:
    """Limit to [low, high]; NULL stays NULL (greatest / least alone would hide it)."""
    x = col(c)
    out = x
    if low is not None:
        out = F.greatest(F.lit(low), out)
    if high is not None:
        out = F.least(F.lit(high), out)
    return F.when(x.isNotNull(), out)


def divide_or_zero(num, den) -> Column:
    """num / den, 0.0 when either is missing or den <= 0."""
    num, den = col(num).cast("double"), col(den).cast("double")
    return F.when(num.isNotNull() & (den > 0), num / den).otherwise(0.0)


def ratio(num, den) -> Column:
    """num / den, NULL when either is missing or den = 0."""
    num, den = col(num).cast("double"), col(den).cast("double")
    return F.when(den != 0, num / den)


def per_60(value, time_on_ice) -> Column:
    return divide_or_zero(col(value) * 60.0, time_on_ice)


def recent_blend(last10, last20) -> Column:
    """0.6 x last 10 + 0.4 x last 20; one stands in for the other when missing."""
    a, b = col(last10), col(last20)
    return 0.6 * F.coalesce(a, b) + 0.4 * F.coalesce(b, a)


def shrink(mean, games, prior, weight: float = fixed.SHRINK_GAMES) -> Column:
    """Mean over few games pulled towards a prior worth `weight` games."""
    mean, games, prior = col(mean), col(games), col(prior)
    return (F.coalesce(mean, prior) * games + prior * weight) / (games + weight)


def season_blend(current, last, weight) -> Column:
    """weight x this season + (1 - weight) x last season, or the one that is known."""
    current, last, weight = col(current), col(last), col(weight)
    both = weight * current + (1.0 - weight) * last
    return F.when(current.isNotNull() & last.isNotNull(), both).otherwise(F.coalesce(current, last))


def late_season(games_remaining) -> Column:
    return F.coalesce((col(games_remaining) <= fixed.LATE_SEASON_GAMES).cast("int"), F.lit(0))


def pressure(late, distance) -> Column:
    """Late in the season: 1 near the cut-off, -1 far from it, else 0."""
    late, d = col(late) == 1, col(distance)
    return (
        F.when(late & ((d >= 8) | (d <= -8)), -1)
        .when(late & d.between(-4, 4), 1)
        .otherwise(0)
    )


def hot_streak(current_run, long_runs, longest_run) -> Column:
    """A run of 5 or more that is the longest so far, by someone who rarely has such runs."""
    hot = (
        (col(current_run) >= fixed.LONG_STREAK)
        & (col(long_runs) < 2)
        & (col(current_run) >= F.coalesce(col(longest_run), F.lit(0)))
    )
    return F.coalesce(hot.cast("int"), F.lit(0))


def reached(c, threshold=1) -> Column:
    """Binary target; missing counts as not reached."""
    return F.coalesce((col(c) >= threshold).cast("int"), F.lit(0))


def as_double(c) -> Column:
    """Booleans and numbers as double for modelling."""
    return real(col(c).cast("double"))


def fill(df: DataFrame, defaults: dict) -> DataFrame:
    """Defaults for those of the columns the table has."""
    return df.fillna({c: v for c, v in defaults.items() if c in df.columns})
