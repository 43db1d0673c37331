import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from foretide.functions import pricing as V
from foretide.functions import scalars as S
from foretide.functions import text as X


def run(spark, values, kind, expression):
    df = spark.createDataFrame([(i, *v) if isinstance(v, tuple) else (i, v) for i, v in enumerate(values)], f"i int, {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_accents_for_every_character(spark):
    chars = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    lines = ["".join(chars[i:i + 500]) for i in range(0, len(chars), 500)]
    want = [unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode("ascii") for t in lines]
    assert run(spark, lines, "t string", X.strip_accents("t")) == want


def test_names(spark):
    cases = {"J. Hughes": "j hughes", "Jack Hughes": "j hughes", "Jean-Gabriel Pageau": "j pageau", "J.T. Miller": "j miller",
             "Sebastian Aho (FIN)": "s aho", "Tim Stützle": "t stutzle", "John Doe Jr.": "j doe", "": "", "Cher": "cher", "  A  B ": "a b"}
    assert run(spark, list(cases), "t string", X.join_name("t")) == list(cases.values())
    assert run(spark, ["12", "a1", ""], "t string", X.is_digits("t")) == [True, False, False]


def test_durations(spark):
    values = ["12:34", "1:02:03", "15.5", "", "nan", "a:b", "90", None]
    assert run(spark, values, "t string", S.minutes("t")) == [pytest.approx(12 + 34 / 60), pytest.approx(62.05), 15.5, None, None, None, 90.0, None]
    assert run(spark, ["90", "1:30"], "t string", S.minutes_from_seconds("t")) == [1.5, 1.5]


def test_flags_and_numbers(spark):
    assert run(spark, ["True", "yes", "0", "0.0", "2", "maybe", None], "t string", S.flag("t")) == [1.0, 1.0, 0.0, 0.0, 2.0, None, None]
    assert run(spark, ["1d", "NaN", "1e3", " 7 ", "-.5"], "t string", S.number("t")) == [None, None, 1000.0, 7.0, -0.5]


def test_odds_limits(spark):
    kind = "p double, o double"
    cases = [(0.0, 2.0), (None, 2.0), (0.5, 1.0), (0.5, None), (0.2, 2.0), (0.6, 2.0)]
    assert run(spark, cases, kind, V.kelly("p", "o")) == [0.0, None, 0.0, None, 0.0, pytest.approx(0.2)]


def test_settlement_rules(spark):
    kind = "v double, t double, k string"
    cases = [(1.0, 1.0, "1_plus"), (0.0, 1.0, "1+"), (1.0, 1.0, "1_minus"), (0.0, 1.0, "1_minus"), (1.0, 1.0, "other"), (None, 1.0, "1_plus")]
    assert run(spark, cases, kind, V.settle("v", "t", "k")) == ["win", "loss", "loss", "win", "win", ""]


def test_pressure_limits(spark):
    cases = [(1, -8.0), (1, -4.0), (1, 0.0), (1, 4.0), (1, 5.0), (1, 8.0), (1, None), (0, 0.0)]
    assert run(spark, cases, "l int, d double", S.pressure("l", "d")) == [-1, 1, 1, 1, 0, -1, 0, 0]
    assert run(spark, [20.0, 21.0, None], "r double", S.late_season("r")) == [1, 0, 0]


def test_bet_id_does_not_depend_on_number_form(spark):
    ids = [V.bet_id(F.lit("2024-01-01"), F.lit("b"), F.lit("m"), F.lit("s"), t, F.lit("p"), F.lit("T"), F.lit(None)) for t in (F.lit(1), F.lit(1.0))]
    row = spark.range(1).select(*ids).first()
    assert row[0] == row[1] and len(row[0]) == 20


def test_names_are_normalised_once(spark):
    """A name key holds its text once, not once for every place that uses it."""
    from foretide.functions import text as X

    df = spark.createDataFrame([("Jean-Luc Núñez jr",)], "n string").select(X.join_name("n").alias("k"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("lower(") == 1
    assert df.first().k == "j nunez"


def test_rare_clock_forms_stay_out_of_the_generated_code(spark):
    """The plain form needs one pattern test; the tests of the others stand in a lambda."""
    texts = ["12:30", " 1:02:30 ", "7.5", "x", "1:x", "", "1:2:3:4", "1.5:30", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(S.minutes("t")).collect()] == [12.5, 62.5, 7.5, None, None, None, None, 2.0, None]
    plan = df.select(S.minutes("t").alias("m"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.split("lambdafunction")[0].count("RLIKE") == 1


def test_normalised_columns_are_the_normalised_text(spark):
    texts = ["Sebastian Aho (FIN)", "Sebastian Aho-FIN", "sebastian  aho fin", "O`Neil sr.", "J. T. Miller", "Núñez-Éa", "ﬁn x", " a\tb ", "bjrk", "", None, "12"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = X.with_normalized(df, {"n": "t", "m": F.reverse("t")}).select(
        "n", X.normalize_text("t").alias("one"), X.join_name_of("n").alias("k"), X.join_name("t").alias("key"),
        X.pair_of("n", "m").alias("p"), X.pair_key("t", F.reverse("t")).alias("pair"),
    ).collect()
    assert [r.n for r in got] == ["sebastian aho", "sebastian aho", "sebastian aho fin", "o'neil", "j t miller", "nunez ea", "fin x", "a b", "bjrk", "", "", "12"]
    assert all((r.n, r.k, r.p) == (r.one, r.key, r.pair) for r in got)
