import random

import pytest
from pyspark.sql import functions as F

from foretide.operators import metrics as M
from foretide.operators import ordered as O
from foretide.operators import timeline as T


def frames():
    return [
        O.rolling_mean("mean3", "x", 3),
        O.rolling_mean("mean10", "x", 10),
        O.rolling_count("count4", "x", 4),
        O.previous("prev", "x"),
        O.running_sum("sum", "x"),
        O.running_sum("sum_now", "x", current=True),
        O.running_count("n"),
        O.running_count("place", current=True),
        O.running_max("top", "x"),
        O.last_seen("last", "x"),
        O.last_seen("last_now", "x", current=True),
    ]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    # Key 0 holds about a third of all rows; key None exists; many rows share a day; values go missing.
    keys = [0] * 70 + [1] * 45 + [2] * 21 + [3] * 20 + [4] * 3 + [5] + [None] * 30
    out = [(k, rng.randrange(6), i, rng.choice([None, 1.0, 2.0, 5.0, -3.0])) for i, k in enumerate(keys)]
    rng.shuffle(out)
    return spark.createDataFrame(out, "k int, d int, i int, x double")


def same(a, b):
    assert a.columns == b.columns
    left = sorted(map(repr, [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in a.collect()]))
    right = sorted(map(repr, [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in b.collect()]))
    assert left == right


def test_split_keys_give_the_same_frames(spark, rows, tiny_keys):
    plain = O.over_order(rows, ["k"], ["d", "i"], frames(), O.HotKeys(("k",)))
    hot = O.find_hot(rows, ["k"])
    assert {r[0] for r in hot.listed.collect()} == {0, 1, 2, None}
    same(O.over_order(rows, ["k"], ["d", "i"], frames(), hot), plain)


def test_split_without_any_key(spark, rows, tiny_keys):
    order = [F.col("x").desc_nulls_last(), F.col("i")]
    plain = O.over_order(rows, [], order, frames(), O.HotKeys(()))
    same(O.over_order(rows, [], order, frames()), plain)


def test_finer_keys_reuse_the_coarse_hot_keys(spark, rows, tiny_keys):
    plain = O.over_order(rows, ["k", "d"], ["i"], frames(), O.HotKeys(("k", "d")))
    same(O.over_order(rows, ["k", "d"], ["i"], frames(), O.find_hot(rows, ["k"])), plain)


def test_rank_and_top_rows(spark, rows, tiny_keys):
    ranked = O.rank_rows(rows, ["k"], [F.col("x").desc_nulls_last(), F.col("i")], "place")
    best = ranked.filter("place <= 2").drop("place")
    same(O.keep_top(rows, ["k"], [F.col("x").desc_nulls_last(), F.col("i")], 2), best)


def test_top_rows_are_cut_before_the_shuffle(spark, rows):
    plan = O.keep_first(rows, ["k"], ["d", "i"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_streaks_and_previous_season_on_split_keys(spark, rows, tiny_keys):
    data = rows.filter("k is not null").withColumns({"hit": (F.col("x") > 0).cast("int"), "s": F.col("d")})
    cold, hot = O.HotKeys(("k",)), O.find_hot(data, ["k"])
    names = ("a", "b", "c", "e")
    same(
        T.two_season_streaks(data, ["k"], ["d", "i"], "s", "hit", names, 2, hot) if False else T.two_season_streaks(data, ["k"], ["i"], "s", "hit", names, 2, hot),
        T.two_season_streaks(data, ["k"], ["i"], "s", "hit", names, 2, cold),
    )
    args = (["k"], "s", {"m": "x"}, ("n", "x"))
    same(T.previous_season_means(data, *args, hot), T.previous_season_means(data, *args, cold))


def test_ranking_metrics_match_all_pairs(spark, tiny_keys):
    rng = random.Random(5)
    data = [(rng.random() < 0.4, rng.randrange(40) / 40) for _ in range(300)]
    df = spark.createDataFrame([(int(y), p) for y, p in data], "y int, p double")
    pos, neg = [p for y, p in data if y], [p for y, p in data if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap, seen, before = 0.0, 0, 0
    for s in sorted({p for _, p in data}, reverse=True):
        hits = sum(y for y, p in data if p == s)
        seen, before = seen + sum(p == s for _, p in data), before + hits
        ap += hits / len(pos) * before / seen
    got = M.ranking(df, "y", "p").first()
    assert got["auc"] == pytest.approx(auc) and got["avg_precision"] == pytest.approx(ap)
    one = M.ranking(df.filter("y = 1"), "y", "p").first()
    assert one["auc"] is None and one["avg_precision"] is None


def test_exact_median_on_split_column(spark, rows, tiny_keys):
    got = M.exact_median(rows.withColumn("i", F.col("i").cast("double")), ["i", "x"]).collect()
    import statistics

    values = {c: [r[c] for r in rows.collect() if r[c] is not None] for c in ("i", "x")}
    assert {r["column"]: r["median"] for r in got} == {c: statistics.median(v) for c, v in values.items()}


def test_small_samples(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (2, 0, 0.1), (3, 1, 0.5)], "id int, y int, p double")
    top = M.top_share(df, "y", "p", ["id"]).first()
    assert (top["top_k_count"], top["precision_top"]) == (1, 1.0)
