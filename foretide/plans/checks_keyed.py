"""Queries for dedup, upserts, snapshot refresh, splits and metrics."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from foretide import fixed
from foretide.functions import pricing as V
from foretide.functions import scalars as S
from foretide.operators import keyed as K
from foretide.operators import metrics as M
from foretide.operators import modelling as G
from foretide.operators import quality as Q
from foretide.operators import splits as T
from foretide.operators.ordered import rank_rows
from foretide.plans import league as L
from foretide.plans import league_sql as D
from foretide.plans.catalogue import Shape, query
from foretide.plans.checks_features import base
from foretide.plans.features import player_form
from foretide.plans.pricing import latest_run as latest
from foretide.session import run_folder
from foretide.sources import stored as B
from foretide.streaming import refresh as R


def _orders(spark, folder):
    return L.read(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("day"), "o_orderpriority"
    )


# ------------------------------------------------------------------ dedup and upserts

_last = Shape(whole="event_id user_id", real="value", text="event_type")


@query(
    "dedup_keep_last",
    f"WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) SELECT {_last.sql} FROM r WHERE n = 1",
)
def dedup_keep_last(spark, folder):
    return _last.of(K.keep_last(L.read(spark, folder, "events"), ["user_id", "event_type"], ["ts", "event_id"]))


_src = Shape(whole="user_id source_priority", real="value", text="day")


@query(
    "source_priority_union",
    f"""WITH a AS (SELECT user_id, CAST(ts AS DATE) AS day, max(value) AS value, 1 AS source_priority FROM events WHERE event_type IN ('view', 'signup', 'purchase') GROUP BY 1, 2),
    b AS (SELECT user_id, CAST(ts AS DATE) AS day, min(value) AS value, 2 AS source_priority FROM events WHERE event_type NOT IN ('view', 'signup', 'purchase') GROUP BY 1, 2),
    u AS (SELECT * FROM a UNION ALL SELECT * FROM b),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day DESC, source_priority DESC) AS n FROM u) SELECT {_src.sql} FROM r WHERE n = 1""",
)
def source_priority_union(spark, folder):
    rows = L.read(spark, folder, "events").withColumn("day", F.to_date("ts"))
    wanted = F.col("event_type").isin("view", "signup", "purchase")
    part = lambda kind, best: rows.filter(kind).groupBy("user_id", "day").agg(best("value").alias("value"))
    return _src.of(K.combine_sources(part(wanted, F.max), part(~wanted, F.min), ["user_id"], ["day"]))


_up = Shape(whole="o_custkey o_orderkey", real="o_totalprice", text="day")
_HALVES = """stored AS (SELECT o_custkey, o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS day, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n
      FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' OR o_custkey % 2 = 1),
    batch AS (SELECT o_custkey, o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS day, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n
      FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_custkey % 2 = 0),
    old AS (SELECT * EXCLUDE (n) FROM stored WHERE n = 1), new AS (SELECT * EXCLUDE (n) FROM batch WHERE n = 1)"""


def _halves(spark, folder):
    """(stored, batch): latest order per even customer since 1998 is the batch, that of all other orders is stored."""
    rows = _orders(spark, folder).select("o_custkey", "o_orderkey", "o_totalprice", "day")
    new = (F.col("day") >= F.lit("1998-01-01").cast("date")) & (F.col("o_custkey") % 2 == 0)
    last = lambda df: K.keep_last(df, ["o_custkey"], ["day", "o_orderkey"])
    return last(rows.filter(~new)), last(rows.filter(new))


@query("upsert_last_wins", f"WITH {_HALVES}, u AS (SELECT * FROM new UNION ALL SELECT * FROM old WHERE o_custkey NOT IN (SELECT o_custkey FROM new)) SELECT {_up.sql} FROM u")
def upsert_last_wins(spark, folder):
    stored, batch = _halves(spark, folder)
    return _up.of(K.upsert(stored, batch, ["o_custkey"], ["day", "o_orderkey"]))


def _stored(spark, folder, change):
    """The older half as a stored table in the shared folder, after `change(path, newer half)`."""
    stored, batch = _halves(spark, folder)
    path = f"{run_folder(spark)}/stored-{uuid.uuid4().hex}"
    B.create(stored, path, ["o_custkey"], 16)
    change(path, batch)
    return B.read(spark, path)


@query("stored_upsert", f"WITH {_HALVES}, u AS (SELECT * FROM new UNION ALL SELECT * FROM old WHERE o_custkey NOT IN (SELECT o_custkey FROM new)) SELECT {_up.sql} FROM u")
def stored_upsert(spark, folder):
    """The upsert on a stored table."""
    return _up.of(_stored(spark, folder, lambda path, batch: B.upsert(path, batch, ["day", "o_orderkey"])))


@query("stored_insert", f"WITH {_HALVES}, u AS (SELECT * FROM old UNION ALL SELECT * FROM new WHERE o_custkey NOT IN (SELECT o_custkey FROM old)) SELECT {_up.sql} FROM u")
def stored_insert(spark, folder):
    """Rows of new keys on a stored table."""
    return _up.of(_stored(spark, folder, B.insert_absent))


@query("insert_absent", f"WITH {_HALVES}, u AS (SELECT * FROM old UNION ALL SELECT * FROM new WHERE o_custkey NOT IN (SELECT o_custkey FROM old)) SELECT {_up.sql} FROM u")
def insert_absent(spark, folder):
    stored, batch = _halves(spark, folder)
    return _up.of(K.insert_absent(stored, batch, ["o_custkey"]))


_merge = Shape(whole="o_custkey", real="price", text="note")


@query(
    "coalescing_upsert",
    f"""WITH {_HALVES}, u AS (SELECT coalesce(n.o_custkey, o.o_custkey) AS o_custkey,
      coalesce(CASE WHEN n.o_orderkey % 3 <> 0 THEN n.o_totalprice END, o.o_totalprice) AS price,
      coalesce(CASE WHEN n.o_orderkey % 2 = 0 THEN 'n' || n.o_orderkey END, 'o' || o.o_orderkey) AS note
      FROM old o FULL JOIN new n USING (o_custkey)) SELECT {_merge.sql} FROM u""",
)
def coalescing_upsert(spark, folder):
    stored, batch = _halves(spark, folder)
    old = stored.select("o_custkey", F.col("o_totalprice").alias("price"), F.concat(F.lit("o"), "o_orderkey").alias("note"))
    new = batch.select(
        "o_custkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("n"), "o_orderkey")).otherwise("").alias("note"),
    )
    return _merge.of(K.merge_filled(old, new, ["o_custkey"]).withColumn("note", F.nullif("note", F.lit(""))))


_set = Shape(whole="o_custkey", real="o_totalprice", text="state")


@query(
    "keyed_update",
    f"""WITH {_HALVES}, u AS (SELECT o.o_custkey, coalesce(n.o_totalprice, o.o_totalprice) AS o_totalprice, CASE WHEN n.o_custkey IS NULL THEN 'open' ELSE 'done' END AS state
      FROM old o LEFT JOIN new n USING (o_custkey)) SELECT {_set.sql} FROM u""",
)
def keyed_update(spark, folder):
    stored, batch = _halves(spark, folder)
    changes = batch.select("o_custkey", "o_totalprice", F.lit("done").alias("state"))
    return _set.of(K.set_where_found(stored.withColumn("state", F.lit("open")), changes, ["o_custkey"], ["o_totalprice", "state"]))


_bal = Shape(whole="n", text="side")


@query(
    "set_balance",
    f"""WITH {_HALVES}, s AS (SELECT CASE WHEN o.o_custkey IS NULL THEN 'right' WHEN n.o_custkey IS NULL THEN 'left' ELSE 'both' END AS side FROM old o FULL JOIN new n USING (o_custkey)),
    c AS (SELECT side, count(*) AS n FROM s GROUP BY 1) SELECT {_bal.sql} FROM c""",
)
def set_balance(spark, folder):
    stored, batch = _halves(spark, folder)
    return _bal.of(K.key_balance(stored, batch, ["o_custkey"]).groupBy("side").agg(F.count(F.lit(1)).alias("n")))


_snap = Shape(real="points", text="date_snapshot team_abbrev")
_SNAP = """days AS (SELECT CAST(ts AS DATE) AS date_snapshot, upper(event_type) AS team_abbrev, sum(value) AS points, count(*) AS n FROM events GROUP BY 1, 2),
    stored AS (SELECT date_snapshot, team_abbrev, points FROM days WHERE NOT (day(date_snapshot) % 4 = 0 AND team_abbrev = 'ERROR') AND day(date_snapshot) % 5 <> 0),
    expected AS (SELECT count(DISTINCT team_abbrev) AS e FROM days),
    done AS (SELECT date_snapshot FROM stored GROUP BY 1 HAVING count(DISTINCT team_abbrev) = (SELECT e FROM expected))"""


def _snapshots(spark, folder):
    days = L.read(spark, folder, "events").groupBy(F.to_date("ts").alias("date_snapshot"), F.upper("event_type").alias("team_abbrev")).agg(F.sum("value").alias("points"))
    d = F.dayofmonth("date_snapshot")
    stored = days.filter(~((d % 4 == 0) & (F.col("team_abbrev") == "ERROR")) & (d % 5 != 0))
    return days, stored, days.agg(F.count_distinct("team_abbrev")).first()[0]


_miss = Shape(text="date_snapshot")


@query("missing_snapshot_days", f"WITH {_SNAP}, m AS (SELECT DISTINCT date_snapshot FROM days WHERE date_snapshot <= DATE '2024-01-25' AND date_snapshot >= DATE '2024-01-03' AND date_snapshot NOT IN (SELECT * FROM done)) SELECT {_miss.sql} FROM m")
def missing_snapshot_days(spark, folder):
    days, stored, expected = _snapshots(spark, folder)
    targets = R.target_days(days.withColumnRenamed("date_snapshot", "date_match"), "2024-01-03", "2024-02-10", "2024-01-25")
    return _miss.of(R.missing_days(targets, stored, expected))


@query("snapshot_refresh", f"WITH {_SNAP}, r AS (SELECT date_snapshot, team_abbrev, points FROM stored WHERE date_snapshot IN (SELECT * FROM done) "
       "UNION ALL SELECT date_snapshot, team_abbrev, points + 1 FROM days WHERE date_snapshot NOT IN (SELECT * FROM done)) " f"SELECT {_snap.sql} FROM r")
def snapshot_refresh(spark, folder):
    days, stored, expected = _snapshots(spark, folder)
    due = R.missing_days(days.select("date_snapshot").distinct(), stored, expected)
    fresh = days.join(due, "date_snapshot", "left_semi").withColumn("points", F.col("points") + 1)
    return _snap.of(R.merge_snapshots(stored, fresh, expected))


# ------------------------------------------------------------------ splits

_bounds = Shape(whole="rows days", text="split first_day last_day")


def _split_sql(case, where="TRUE"):
    return f"""WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day FROM orders WHERE {where}),
    d AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS pos, count(*) OVER () AS n FROM (SELECT DISTINCT day FROM o)),
    l AS (SELECT day, {case} AS split FROM d),
    b AS (SELECT split, min(day) AS first_day, max(day) AS last_day, count(*) AS rows, count(DISTINCT day) AS days FROM o JOIN l USING (day) GROUP BY 1)
    SELECT {_bounds.sql} FROM b"""


@query(
    "split_three_way",
    _split_sql("CASE WHEN pos < greatest(1, CAST(floor(n * 0.70) AS INT)) THEN 'train' WHEN pos < least(greatest(greatest(1, CAST(floor(n * 0.70) AS INT)) + 1, CAST(floor(n * 0.85) AS INT)), n - 1) THEN 'validation' ELSE 'test' END"),
)
def split_three_way(spark, folder):
    return _bounds.of(T.bounds(T.three_way(_orders(spark, folder), "day"), "day"))


_T = "greatest(1, least(CAST(floor(n * 0.80) AS INT), n - 1))"


@query("split_nested", _split_sql(f"CASE WHEN pos >= {_T} THEN 'test' WHEN pos >= greatest(1, least(CAST(floor({_T} * 0.85) AS INT), {_T} - 1)) THEN 'validation' ELSE 'train' END"))
def split_nested(spark, folder):
    return _bounds.of(T.bounds(T.nested(_orders(spark, folder), "day"), "day"))


@query("split_halves", _split_sql("CASE WHEN pos < greatest(1, least(CAST(floor(n * 0.5) AS INT), n - 1)) THEN 'fit' ELSE 'eval' END"))
def split_halves(spark, folder):
    return _bounds.of(T.bounds(T.halves(_orders(spark, folder), "day"), "day"))


@query("split_before_target", _split_sql("CASE WHEN pos < least(greatest(1, CAST(floor(n * 0.85) AS INT)), n - 1) THEN 'fit' ELSE 'calib' END", "o_orderdate < TIMESTAMP '2000-03-01'"))
def split_before_target(spark, folder):
    return _bounds.of(T.bounds(T.before_target(_orders(spark, folder), "day", "2000-03-01"), "day"))


# ------------------------------------------------------------------ metrics

_SCORED = """scored AS (SELECT l.doc_id, l.quality AS y, CASE WHEN d.lang IN ('en', 'fr') THEN 'a' ELSE 'b' END AS part,
      greatest(0.000001, least(0.999999, round(0.05 + 0.9 * d.n_chars / (d.n_chars + 900.0::DOUBLE), 3))) AS p FROM labels l JOIN documents d USING (doc_id))"""


def _scored(spark, folder):
    score = F.round(0.05 + 0.9 * F.col("n_chars") / (F.col("n_chars") + 900.0), 3)
    part = F.when(F.col("lang").isin("en", "fr"), "a").otherwise("b")
    docs = L.read(spark, folder, "documents").select("doc_id", part.alias("part"), V.clip_probability(score).alias("p"))
    return L.read(spark, folder, "labels").select("doc_id", F.col("quality").alias("y")).join(docs, "doc_id")


_ll = Shape(whole="rows", real="positive_rate mean_predicted_proba logloss brier", text="part")


@query(
    "logloss_brier",
    f"WITH {_SCORED}, m AS (SELECT part, count(*) AS rows, avg(y) AS positive_rate, avg(p) AS mean_predicted_proba, avg(-(y * ln(p) + (1 - y) * ln(1 - p))) AS logloss, avg((p - y) * (p - y)) AS brier FROM scored GROUP BY 1) SELECT {_ll.sql} FROM m",
)
def logloss_brier(spark, folder):
    return _ll.of(M.log_loss_and_brier(_scored(spark, folder), "y", "p", ["part"]))


_rank = Shape(real="auc avg_precision", text="part")


@query(
    "auc_average_precision",
    f"""WITH {_SCORED}, c AS (SELECT part, p, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY 1, 2),
    r AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY part) AS np, sum(neg) OVER (PARTITION BY part) AS nn
      FROM c WINDOW w AS (PARTITION BY part ORDER BY p DESC)),
    m AS (SELECT part, sum(pos * ((nn - fp) + neg / 2.0::DOUBLE)) / (max(np) * max(nn)) AS auc, sum(pos * (tp / CAST(tp + fp AS DOUBLE))) / max(np) AS avg_precision FROM r GROUP BY part)
    SELECT {_rank.sql} FROM m""",
)
def auc_average_precision(spark, folder):
    return _rank.of(M.ranking(_scored(spark, folder), "y", "p", ["part"]))


_top = Shape(whole="top_k_count", real="precision_top lift_top", text="part")


@query(
    "top_share_lift",
    f"""WITH {_SCORED}, r AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY p DESC, doc_id) AS k, count(*) OVER (PARTITION BY part) AS n, avg(y) OVER (PARTITION BY part) AS b FROM scored),
    m AS (SELECT part, count(*) AS top_k_count, avg(y) AS precision_top, avg(y) / max(b) AS lift_top FROM r WHERE k <= greatest(1, ceil(n * 0.10)) GROUP BY 1) SELECT {_top.sql} FROM m""",
)
def top_share_lift(spark, folder):
    return _top.of(M.top_share(_scored(spark, folder), "y", "p", ["doc_id"], ["part"]))


_w = Shape(whole="y rows", real="weight")


@query("class_weights", f"WITH t AS (SELECT avg(quality) AS m FROM labels), w AS (SELECT quality AS y, count(*) AS rows, CASE WHEN quality = 1 THEN (1 - m) / m ELSE 1 END AS weight FROM labels, t GROUP BY quality, m) SELECT {_w.sql} FROM w")
def class_weights(spark, folder):
    rows = M.class_weights(L.read(spark, folder, "labels").withColumnRenamed("quality", "y"), "y")
    return _w.of(rows.groupBy("y", "weight").agg(F.count(F.lit(1)).alias("rows")))


_judge = Shape(real="baseline current delta", text="split metric judgment")
_CURRENT = """CURRENT_ROWS AS (SELECT CASE part WHEN 'a' THEN 'test_raw' ELSE 'test_calibrated' END AS split, metric, v AS current FROM (
      SELECT part, 'logloss' AS metric, avg(-(y * ln(p) + (1 - y) * ln(1 - p))) AS v FROM scored GROUP BY 1 UNION ALL SELECT part, 'brier', avg((p - y) * (p - y)) FROM scored GROUP BY 1))"""
_STORED = "stored AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{s}', '{m}', {v}::DOUBLE)" for s, ms in fixed.BASELINE_METRICS.items() for m, v in ms.items()) + ") v(split, metric, baseline))"
_JUDGED = f"""WITH {_SCORED}, {_CURRENT}, {_STORED}, j AS (SELECT s.*, c.current, c.current - s.baseline AS delta,
      CASE WHEN c.current IS NULL THEN 'na' WHEN c.current < s.baseline - 1e-12 THEN 'better' WHEN c.current > s.baseline + 1e-12 THEN 'worse' ELSE 'equal' END AS judgment
      FROM stored s LEFT JOIN CURRENT_ROWS c USING (split, metric))"""


def _judged(spark, folder):
    split = F.when(F.col("part") == "a", "test_raw").otherwise("test_calibrated")
    now = M.log_loss_and_brier(_scored(spark, folder).withColumn("split", split), "y", "p", ["split"])
    return M.compare(M.unpivot_metrics(now, "split", ["logloss", "brier"]), M.stored_baseline(spark))


@query("metric_judgement", f"{_JUDGED} SELECT {_judge.sql} FROM j")
def metric_judgement(spark, folder):
    return _judge.of(_judged(spark, folder))


_sum = Shape(whole="better_metrics worse_metrics equal_metrics", text="split status")


@query(
    "metric_roll_up",
    f"""{_JUDGED}, c AS (SELECT split, count(*) FILTER (judgment = 'better') AS better_metrics, count(*) FILTER (judgment = 'worse') AS worse_metrics, count(*) FILTER (judgment = 'equal') AS equal_metrics FROM j GROUP BY 1),
    s AS (SELECT *, CASE WHEN better_metrics > 0 AND worse_metrics > 0 THEN 'mixed' WHEN better_metrics > 0 THEN 'improved' WHEN worse_metrics > 0 THEN 'degraded' ELSE 'unchanged' END AS status FROM c)
    SELECT {_sum.sql} FROM s""",
)
def metric_roll_up(spark, folder):
    return _sum.of(M.summarize(_judged(spark, folder)))


_rec = Shape(text="split recommendation")


@query(
    "metric_recommendation",
    f"""{_JUDGED}, c AS (SELECT split, count(*) FILTER (judgment = 'better') AS b, count(*) FILTER (judgment = 'worse') AS w FROM j WHERE split = 'test_calibrated' GROUP BY 1),
    s AS (SELECT split, CASE WHEN b > 0 AND w = 0 THEN 'keep_new_version' WHEN b > 0 AND w > 0 THEN 'review_new_version' ELSE 'rollback_or_debug' END AS recommendation FROM c)
    SELECT {_rec.sql} FROM s""",
)
def metric_recommendation(spark, folder):
    return _rec.of(M.recommend(M.summarize(_judged(spark, folder))))


# ------------------------------------------------------------------ ranks, universe, features

_PREDICTED = """predicted AS (SELECT id_joueur, id_match, date_match, team_player_match, adversaire_match, is_home_player,
      (50 + (id_joueur * 37 + id_match * 11) % 900) / 1000.0::DOUBLE AS p FROM base)"""


def predicted(spark, folder):
    """Player rows with a made-up but fixed probability."""
    p = (50 + (F.col("id_joueur") * 37 + F.col("id_match") * 11) % 900) / 1000.0
    return base(spark, folder).select(
        "id_joueur", "id_match", "date_match", "team_player_match", "adversaire_match", "is_home_player", p.alias("proba_point_1p_calibree")
    )


_ranks = Shape(whole="id_joueur id_match rank_proba_sur_date rank_proba_sur_match", real="cote_juste")


@query(
    "prediction_ranks",
    f"""WITH {D.BASE}, {_PREDICTED}, r AS (SELECT *, 1 / p AS cote_juste, row_number() OVER (PARTITION BY date_match ORDER BY p DESC, id_match, id_joueur) AS rank_proba_sur_date,
      row_number() OVER (PARTITION BY id_match ORDER BY p DESC, id_match, id_joueur) AS rank_proba_sur_match FROM predicted) SELECT {_ranks.sql} FROM r""",
)
def prediction_ranks(spark, folder):
    return _ranks.of(G.ranked_predictions(predicted(spark, folder)))


_rn = Shape(whole="o_orderkey place")


@query("rank_per_day", f"WITH r AS (SELECT o_orderkey, row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders) SELECT {_rn.sql} FROM r")
def rank_per_day(spark, folder):
    return _rn.of(rank_rows(_orders(spark, folder), ["day"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], "place"))


_std = Shape(whole="doc_id target", real="score", text="day")


@query(
    "standard_predictions",
    f"""WITH s AS (SELECT doc_id, quality AS target, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE greatest(0.000001, least(0.999999, (doc_id % 50) / 49.0::DOUBLE)) END AS score,
      '2024-01-' || lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0') AS day FROM labels WHERE doc_id % 13 <> 0) SELECT {_std.sql} FROM s WHERE score IS NOT NULL""",
)
def standard_predictions(spark, folder):
    d = F.col("doc_id")
    rows = L.read(spark, folder, "labels").select(
        "doc_id", F.col("quality").cast("string").alias("label_point_1p"),
        F.when(d % 9 != 0, (d % 50) / 49.0).alias("proba"),
        F.when(d % 13 != 0, F.concat(F.lit("2024-01-"), F.lpad((1 + d % 28).cast("string"), 2, "0"))).otherwise("?").alias("game_date"),
    )
    out, target, score, date = G.standard_predictions(rows, ["target_point_1p", "label_point_1p"], ["proba_point_1p", "proba"], ["date_match", "game_date"])
    return _std.of(out.withColumnsRenamed({target: "target", score: "score", date: "day"}))


_uni = Shape(whole="id_joueur id_match", real="toi_moy_5")


@query("model_universe", f"WITH {D.FORM} SELECT {_uni.sql} FROM form WHERE nb_matchs_avant_match >= 5 AND toi_moy_5 >= 10.0")
def model_universe(spark, folder):
    return _uni.of(G.model_universe(player_form(base(spark, folder))))


_spread = Shape(whole="kept", text="feature")


@query(
    "feature_prune",
    "WITH f AS (" + " UNION ALL ".join(
        f"SELECT '{n}' AS feature, CAST(min({e}) < max({e}) AS INT) AS kept FROM lineitem"
        for n, e in dict(quantity="l_quantity", price="l_extendedprice", discount="l_discount", tax="l_tax", line="l_linenumber").items()
    ) + f" UNION ALL SELECT 'constant', 0 UNION ALL SELECT 'empty', 0) SELECT {_spread.sql} FROM f",
)
def feature_prune(spark, folder):
    names = dict(quantity="l_quantity", price="l_extendedprice", discount="l_discount", tax="l_tax", line="l_linenumber")
    rows = L.read(spark, folder, "lineitem").select(
        *[F.col(c).cast("double").alias(n) for n, c in names.items()], F.lit(1.0).alias("constant"), F.lit(None).cast("double").alias("empty")
    )
    wanted = [*names, "constant", "empty"]
    kept = Q.useful_features(rows, wanted)
    return _spread.of(rows.agg(F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(int(c in kept)).alias("kept")) for c in wanted]).alias("a")).select(F.inline("a")))


_imp = Shape(whole="event_id", real="value filled")


@query(
    "median_impute",
    """WITH e AS (SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN value END AS value, ts FROM events), m AS (SELECT median(value) AS m FROM e WHERE ts < TIMESTAMP '2024-01-20')
    """ + f", f AS (SELECT event_id, value, coalesce(value, m) AS filled FROM e, m) SELECT {_imp.sql} FROM f",
)
def median_impute(spark, folder):
    rows = L.read(spark, folder, "events").withColumn("value", F.when(F.col("event_id") % 4 != 0, F.col("value")))
    train = rows.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    filled = G.feature_matrix(rows.withColumn("filled", F.col("value")), ["filled"], medians_of=train.withColumn("filled", F.col("value")))
    return _imp.of(filled)


_run = Shape(text="run_date")


@query("latest_run", f"WITH r AS (SELECT max(CAST(CAST(ts AS DATE) AS VARCHAR)) AS run_date FROM events WHERE event_type <> 'error') SELECT {_run.sql} FROM r")
def latest_run(spark, folder):
    rows = L.read(spark, folder, "events").select(F.when(F.col("event_type") == "error", "nan").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("run_date"))
    return _run.of(rows.filter(F.col("run_date") == latest(rows)).distinct())


_tp = Shape(whole="doc_id", real="logit inverse")


@query("probability_transforms", f"WITH {_SCORED}, t AS (SELECT doc_id, ln(p / (1 - p)) AS logit, 1 / p AS inverse FROM scored) SELECT {_tp.sql} FROM t")
def probability_transforms(spark, folder):
    return _tp.of(_scored(spark, folder).select("doc_id", V.logit("p").alias("logit"), V.fair_odds("p").alias("inverse")))


_typed = Shape(whole="target", text="status")


@query("status_and_target", f"WITH s AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'pending' WHEN 'O' THEN 'pending' ELSE o_orderstatus END AS status, CAST(o_totalprice >= 250000 AS INT) AS target FROM orders), g AS (SELECT DISTINCT status, target FROM s) SELECT {_typed.sql} FROM g")
def status_and_target(spark, folder):
    raw = F.when(F.col("o_orderstatus") == "F", "").when(F.col("o_orderstatus") == "O", "nan").otherwise(F.col("o_orderstatus"))
    return _typed.of(_orders(spark, folder).select(V.status(raw).alias("status"), S.reached("o_totalprice", 250000).alias("target")).distinct())
