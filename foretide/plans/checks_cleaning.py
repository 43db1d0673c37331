"""Queries for the column expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from foretide import fixed
from foretide.functions import scalars as S
from foretide.functions import text as X
from foretide.operators import quality as Q
from foretide.plans import league as L
from foretide.plans.catalogue import Shape, query

_EVENT_TEXT = """raw AS (SELECT event_id, user_id, value, ts, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"""


def _events(spark, folder):
    return L.read(spark, folder, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))


_clean = Shape(whole="event_id whole_text whole_decimal", real="as_number", text="trimmed team pos bucket_pos day_text first_known code_upper")


@query(
    "scalar_cleaning",
    f"""WITH {_EVENT_TEXT}, made AS (SELECT *, CASE k % 4 WHEN 0 THEN '  ' || event_type || ' ' WHEN 1 THEN '   ' ELSE event_type END AS t,
      ['ari', ' PHX ', 'mtl', 'PHO'][k % 4 + 1] AS team0, ['lw', 'RW ', 'ld', 'C'][k % 4 + 1] AS pos0,
      CASE k % 5 WHEN 0 THEN ' ' || k || ' ' WHEN 1 THEN k || '.7' WHEN 2 THEN 'x' || k WHEN 3 THEN '' ELSE '-' || k END AS n FROM raw),
    done AS (SELECT event_id, nullif(trim(t), '') AS trimmed,
      ['UTA', 'UTA', 'MTL', 'UTA'][k % 4 + 1] AS team, ['L', 'R', 'D', 'C'][k % 4 + 1] AS pos,
      CASE k % 3 WHEN 0 THEN 'D' WHEN 1 THEN 'G' END AS bucket_pos,
      CASE WHEN k % 5 = 0 THEN k WHEN k % 5 = 4 THEN -k END AS whole_text,
      CASE WHEN k % 5 IN (0, 1) THEN k WHEN k % 5 = 4 THEN -k END AS whole_decimal,
      CASE WHEN k % 5 = 0 THEN k WHEN k % 5 = 1 THEN k + 0.7 WHEN k % 5 = 4 THEN -k END AS as_number,
      CASE WHEN k % 3 = 0 THEN strftime(ts, '%Y-%m-%d') END AS day_text,
      coalesce(CASE WHEN k % 4 <> 1 THEN trim(t) END, event_type) AS first_known, upper(event_type) AS code_upper FROM made)
    SELECT {_clean.sql} FROM done""",
)
def scalar_cleaning(spark, folder):
    k = F.col("k")
    pick = lambda values, n: F.element_at(F.array(*[F.lit(v) for v in values]), (k % n + 1).cast("int"))
    text = F.when(k % 4 == 0, F.concat(F.lit("  "), "event_type", F.lit(" "))).when(k % 4 == 1, "   ").otherwise(F.col("event_type"))
    numeral = (
        F.when(k % 5 == 0, F.concat(F.lit(" "), k, F.lit(" "))).when(k % 5 == 1, F.concat(k, F.lit(".7")))
        .when(k % 5 == 2, F.concat(F.lit("x"), k)).when(k % 5 == 3, "").otherwise(F.concat(F.lit("-"), k))
    )
    day = F.when(k % 3 == 0, F.date_format("ts", "yyyy-MM-dd")).when(k % 3 == 1, "2024-13-45").otherwise("soon")
    return _clean.of(
        _events(spark, folder).select(
            "event_id",
            S.clean_text(text).alias("trimmed"),
            S.team_code(pick(["ari", " PHX ", "mtl", "PHO"], 4)).alias("team"),
            S.position(pick(["lw", "RW ", "ld", "C"], 4)).alias("pos"),
            S.bucket_position(pick(["Defensemen", "goalies", "forwards"], 3)).alias("bucket_pos"),
            S.whole(numeral).alias("whole_text"),
            S.whole_from_decimal(numeral).alias("whole_decimal"),
            S.number(numeral).alias("as_number"),
            S.day_text(day).alias("day_text"),
            S.first_of(S.clean_text(text), "event_type").alias("first_known"),
            S.upper_code("event_type").alias("code_upper"),
        )
    )


_dur = Shape(whole="event_id", real="as_minutes pp_minutes", text="form")


@query(
    "durations",
    f"""WITH {_EVENT_TEXT}, made AS (SELECT event_id, CASE k % 6 WHEN 0 THEN k || ':' || lpad(CAST(k % 60 AS VARCHAR), 2, '0') WHEN 1 THEN '1:02:0' || k % 10 WHEN 2 THEN k || '.5'
      WHEN 3 THEN 'nan' WHEN 4 THEN 'a:b' ELSE ' ' END AS form, k FROM raw),
    done AS (SELECT *, CASE k % 6 WHEN 0 THEN k + (k % 60) / 60.0::DOUBLE WHEN 1 THEN 62 + (k % 10) / 60.0::DOUBLE WHEN 2 THEN k + 0.5 END AS as_minutes,
      CASE k % 6 WHEN 0 THEN k + (k % 60) / 60.0::DOUBLE WHEN 1 THEN 62 + (k % 10) / 60.0::DOUBLE WHEN 2 THEN (k + 0.5) / 60.0::DOUBLE END AS pp_minutes FROM made)
    SELECT {_dur.sql} FROM done""",
)
def durations(spark, folder):
    k = F.col("k")
    form = (
        F.when(k % 6 == 0, F.concat(k, F.lit(":"), F.lpad((k % 60).cast("string"), 2, "0"))).when(k % 6 == 1, F.concat(F.lit("1:02:0"), k % 10))
        .when(k % 6 == 2, F.concat(k, F.lit(".5"))).when(k % 6 == 3, "nan").when(k % 6 == 4, "a:b").otherwise(" ")
    )
    rows = _events(spark, folder).select("event_id", form.alias("form"))
    return _dur.of(rows.withColumns({"as_minutes": S.minutes("form"), "pp_minutes": S.minutes_from_seconds("form")}))


_flag = Shape(whole="event_id shown", real="coerced as_model_input", text="word")
_WORDS = ["True", "yes", "0", "0.0", "2", "maybe", "N", " ok "]


@query(
    "flags",
    f"""WITH {_EVENT_TEXT}, made AS (SELECT event_id, value, {_WORDS}[k % 8 + 1] AS word, k % 8 AS j FROM raw),
    done AS (SELECT *, CASE WHEN j IN (0, 1, 7) THEN 1 WHEN j IN (2, 3, 6) THEN 0 WHEN j = 4 THEN 2 END AS coerced,
      CAST(j IN (0, 1) AS INT) AS shown, CAST(value > 10 AS INT) AS as_model_input FROM made)
    SELECT {_flag.sql} FROM done""",
)
def flags(spark, folder):
    word = F.element_at(F.array(*[F.lit(w) for w in _WORDS]), (F.col("k") % 8 + 1).cast("int"))
    return _flag.of(
        _events(spark, folder).select(
            "event_id", word.alias("word"), S.flag(word).alias("coerced"), S.shown_as_true(word).cast("int").alias("shown"),
            S.as_double(F.col("value") > 10).alias("as_model_input"),
        )
    )


_seas = Shape(whole="id_match start_year valid_team", text="code previous")


@query(
    "season_codes",
    f"""WITH o AS (SELECT o_orderkey AS id_match, year(o_orderdate) AS y, o_orderkey % 3 AS j, ['UTA', 'ARI', 'SEA', 'BOS'][o_custkey % 4 + 1] AS team FROM orders),
    coded AS (SELECT *, CASE WHEN j < 2 THEN CAST(y AS VARCHAR) || CAST(y + 1 AS VARCHAR) END AS code, y AS start_year,
      CASE WHEN j < 2 THEN CAST(y - 1 AS VARCHAR) || CAST(y AS VARCHAR) END AS previous,
      CASE WHEN team IN ('UTA', 'SEA') THEN 0 ELSE 1 END AS valid_team FROM o)
    SELECT {_seas.sql} FROM coded""",
)
def season_codes(spark, folder):
    y, j = F.year("o_orderdate"), F.col("o_orderkey") % 3
    eight = F.concat(y, y + 1)
    made = F.when(j == 0, eight).when(j == 1, F.concat(F.lit(" "), eight, F.lit(".0"))).otherwise(y.cast("string"))
    team = F.element_at(F.array(*[F.lit(t) for t in ("UTA", "ARI", "SEA", "BOS")]), (F.col("o_custkey") % 4 + 1).cast("int"))
    return _seas.of(
        L.read(spark, folder, "orders").select(
            F.col("o_orderkey").alias("id_match"), S.season_code(made).alias("code"), S.season_start_year(made).alias("start_year"),
            S.previous_season(made).alias("previous"),
            S.team_valid_for_season(team, eight.cast("int")).cast("int").alias("valid_team"),
        )
    )


_chunks = Shape(whole="o_custkey days", text="chunk_start chunk_end")


@query(
    "month_chunks",
    f"""WITH spans AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders GROUP BY 1),
    months AS (SELECT o_custkey, a, b, CAST(unnest(generate_series(CAST(date_trunc('month', a) AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS m FROM spans),
    chunks AS (SELECT o_custkey, greatest(m, a) AS chunk_start, least(last_day(m), b) AS chunk_end, least(last_day(m), b) - greatest(m, a) + 1 AS days FROM months)
    SELECT {_chunks.sql} FROM chunks""",
)
def month_chunks(spark, folder):
    spans = L.read(spark, folder, "orders").groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b")
    )
    rows = spans.select("o_custkey", F.explode(S.month_chunks("a", "b")).alias("c")).select("o_custkey", "c.*")
    return _chunks.of(rows.withColumn("days", F.size(S.days_between("chunk_start", "chunk_end"))))


_arith = Shape(whole="l_orderkey", real="clipped safe_zero safe_null rate blend shrunk")


@query(
    "clip_and_ratio",
    f"""WITH x AS (SELECT l_orderkey, l_quantity AS q, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_discount END AS d, l_tax AS t, l_extendedprice AS e FROM lineitem),
    y AS (SELECT l_orderkey, least(greatest(q, 5), 40) AS clipped, CASE WHEN d > 0 THEN q / d ELSE 0 END AS safe_zero,
      CASE WHEN d <> 0 THEN q / d END AS safe_null, CASE WHEN t > 0 THEN q * 60 / t ELSE 0 END AS rate,
      0.6 * coalesce(d, t) + 0.4 * coalesce(t, d) AS blend, (coalesce(d, t) * q + t * 3) / (q + 3) AS shrunk FROM x)
    SELECT {_arith.sql} FROM y""",
)
def clip_and_ratio(spark, folder):
    rows = L.read(spark, folder, "lineitem").withColumn("d", F.when(F.col("l_linenumber") % 3 != 0, F.col("l_discount")))
    return _arith.of(
        rows.select(
            "l_orderkey", S.clip("l_quantity", 5.0, 40.0).alias("clipped"), S.divide_or_zero("l_quantity", "d").alias("safe_zero"),
            S.ratio("l_quantity", "d").alias("safe_null"), S.per_60("l_quantity", "l_tax").alias("rate"),
            S.recent_blend("d", "l_tax").alias("blend"), S.shrink("d", "l_quantity", "l_tax").alias("shrunk"),
        )
    )


_names = Shape(whole="p_partkey digits", text="plain key_short key_full pair")
_ACCENTS = "JÉÀN-Çlaudé Ñúñez Jr. (FIN) "


@query(
    "name_keys",
    f"""WITH n AS (SELECT p_partkey, p_name, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b, p_brand, p_partkey % 7 = 0 AS num FROM part),
    k AS (SELECT p_partkey, CASE WHEN num THEN CAST(p_partkey AS VARCHAR) ELSE 'jean claude nunez ' || p_name END AS plain,
      substr(a, 1, 1) || ' ' || b AS key_short, substr(a, 1, 1) || ' ' || b AS key_full, CAST(num AS INT) AS digits,
      least(p_name, replace(lower(p_brand), '#', ' ')) || '+' || greatest(p_name, replace(lower(p_brand), '#', ' ')) AS pair FROM n)
    SELECT {_names.sql} FROM k""",
)
def name_keys(spark, folder):
    numeric = F.col("p_partkey") % 7 == 0
    shown = F.when(numeric, F.col("p_partkey").cast("string")).otherwise(F.concat(F.lit(_ACCENTS), F.upper("p_name")))
    words = F.split("p_name", " ")
    short = F.concat(F.upper(F.substring("p_name", 1, 1)), F.lit(". "), F.initcap(F.get(words, F.lit(1))))
    # The narrow rows are spread before their names are worked on: one file would be one task.
    parts = L.read(spark, folder, "part").select("p_partkey", "p_name", "p_brand").repartition("p_partkey")
    return _names.of(
        parts.select(
            "p_partkey", X.normalize_text(shown).alias("plain"), X.join_name(short).alias("key_short"), X.join_name("p_name").alias("key_full"),
            X.is_digits(shown).cast("int").alias("digits"), F.array_join(X.pair_key("p_brand", "p_name"), "+").alias("pair"),
        )
    )


_doc = Shape(whole="doc_id words letters", text="digest")


@query(
    "document_text_keys",
    f"""WITH a AS (SELECT doc_id, regexp_replace(strip_accents(lower(trim(text))), '[^\\x00-\\x7F]', '', 'g') AS t FROM documents),
    b AS (SELECT doc_id, regexp_replace(replace(regexp_replace(regexp_replace(replace(t, '`', ''''), '\\([^)]*\\)', ' ', 'g'), '[^a-z0-9'' -]+', ' ', 'g'), '-', ' '), '\\b(jr|sr)\\b', ' ', 'g') AS t FROM a),
    c AS (SELECT doc_id, trim(regexp_replace(t, '\\s+', ' ', 'g')) AS t FROM b),
    d AS (SELECT doc_id, length(string_split(t, ' ')) AS words, length(t) AS letters, md5(t) AS digest FROM c)
    SELECT {_doc.sql} FROM d""",
)
def document_text_keys(spark, folder):
    """The name normaliser over whole documents in four languages."""
    plain = L.read(spark, folder, "documents").select("doc_id", X.normalize_text("text").alias("t"))
    return _doc.of(plain.select("doc_id", F.size(F.split("t", " ")).alias("words"), F.length("t").alias("letters"), F.md5(F.col("t").cast("binary")).alias("digest")))


_tl = Shape(whole="c_custkey known", text="team main_name alias_count")
_MAIN = "map {" + ", ".join(f"'{k}': '{v[0]}'" for k, v in fixed.TEAM_NAMES.items()) + "}"
_COUNT = "map {" + ", ".join(f"'{k}': {len(v)}" for k, v in fixed.TEAM_NAMES.items()) + "}"


@query(
    "team_lookup",
    f"""WITH t AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 'XXX' ELSE {L.TEAMS}[c_custkey % 32 + 1] END AS team FROM customer),
    f AS (SELECT *, {_MAIN}[team] AS main_name, coalesce({_COUNT}[team], 0) AS alias_count, CAST(team <> 'XXX' AS INT) AS known FROM t)
    SELECT {_tl.sql} FROM f""",
)
def team_lookup(spark, folder):
    code = F.element_at(F.array(*[F.lit(t) for t in L.TEAMS]), (F.col("c_custkey") % 32 + 1).cast("int"))
    team = F.when(F.col("c_custkey") % 11 == 0, "XXX").otherwise(code)
    return _tl.of(
        L.read(spark, folder, "customer").select(
            "c_custkey", team.alias("team"), X.team_main_name(team).alias("main_name"), F.size(X.team_aliases(team)).alias("alias_count"),
            F.coalesce((X.team_code_of_name(F.get(X.team_aliases(team), F.lit(0))) == team).cast("int"), F.lit(0)).alias("known"),
        )
    )


_today = Shape(whole="event_id", text="paris_day")


@query("local_day", f"WITH x AS (SELECT event_id, strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%d') AS paris_day FROM events) SELECT {_today.sql} FROM x")
def local_day(spark, folder):
    """Calendar day in Paris of a UTC time (winter data, so one hour ahead)."""
    return _today.of(_events(spark, folder).select("event_id", S.today_in("Europe/Paris", F.col("ts").cast("timestamp")).alias("paris_day")))


# ------------------------------------------------------------------ checks and profiles

_dups = Shape(whole="l_orderkey l_linenumber copies")


@query("key_duplicates", f"WITH d AS (SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1) SELECT {_dups.sql} FROM d")
def key_duplicates(spark, folder):
    return _dups.of(Q.duplicates(L.read(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]))


_rules = Shape(whole="missing_k negative empty_type")


@query(
    "rule_violations",
    f"""WITH {_EVENT_TEXT}, r AS (SELECT count(*) FILTER (k % 10 = 0) AS missing_k, count(*) FILTER (value < 5) AS negative, count(*) FILTER (trim(event_type) = '') AS empty_type FROM raw)
    SELECT {_rules.sql} FROM r""",
)
def rule_violations(spark, folder):
    rows = _events(spark, folder).withColumn("kk", F.when(F.col("k") % 10 != 0, F.col("k")))
    return _rules.of(Q.violations(rows, {"missing_k": F.col("kk").isNull(), "negative": F.col("value") < 5, "empty_type": F.trim("event_type") == ""}))


_audit = Shape(whole="o_orderkey")


@query("missing_dimension_audit", f"WITH a AS (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) SELECT {_audit.sql} FROM a")
def missing_dimension_audit(spark, folder):
    seen = L.read(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return _audit.of(Q.missing_from(L.read(spark, folder, "orders"), seen, "o_orderkey"))


_prof = Shape(whole="rows filled distinct_values", text="column_name least greatest")


@query(
    "table_profile",
    "WITH p AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS rows, count({c}) AS filled, count(DISTINCT {c}) AS distinct_values, CAST(min({c}) AS VARCHAR) AS least, CAST(max({c}) AS VARCHAR) AS greatest FROM orders"
        for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    ) + f") SELECT {_prof.sql} FROM p",
)
def table_profile(spark, folder):
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    return _prof.of(Q.profile(L.read(spark, folder, "orders"), columns).withColumnRenamed("column", "column_name"))


_full = Shape(whole="members complete", text="day")


@query(
    "complete_days",
    f"WITH d AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(DISTINCT event_type) AS members FROM events WHERE NOT (event_type = 'error' AND day(ts) % 3 = 0) GROUP BY 1), "
    f"e AS (SELECT *, CAST(members = (SELECT count(DISTINCT event_type) FROM events) AS INT) AS complete FROM d) SELECT {_full.sql} FROM e",
)
def complete_days(spark, folder):
    rows = _events(spark, folder).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    expected = rows.agg(F.count_distinct("event_type")).first()[0]
    seen = rows.filter(~((F.col("event_type") == "error") & (F.dayofmonth("ts") % 3 == 0)))
    return _full.of(Q.complete_groups(seen, "day", "event_type", expected))


_vc = Shape(whole="n", text="event_type")


@query("value_counts", f"WITH v AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1) SELECT {_vc.sql} FROM v")
def value_counts(spark, folder):
    return _vc.of(L.read(spark, folder, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n")))


_sample = Shape(whole="l_orderkey l_linenumber", real="l_quantity l_extendedprice")


@query("violation_examples", f"SELECT {_sample.sql} FROM (SELECT * FROM lineitem WHERE l_quantity = 50 ORDER BY l_orderkey, l_linenumber, l_quantity, l_extendedprice LIMIT 20)")
def violation_examples(spark, folder):
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    return _sample.of(Q.examples(L.read(spark, folder, "lineitem"), F.col("l_quantity") == 50, columns, 20))
