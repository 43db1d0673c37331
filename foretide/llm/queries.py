"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foretide.llm import audit, bpe, infill, language, lines, minhash, packing, pieces, pivots, quality, suffix, topk, toxicity
from foretide.llm.common import remainder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the 50-byte strings that earlier documents hold."""
    found = suffix.removed(_read(spark, folder, "documents"))
    gone = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    return found.select(
        "doc_id", "n_bytes", gone.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate class and number of links of every embedding."""
    return pivots.near_duplicates(_read(spark, folder, "embeddings"))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in windows of 1024 ids."""
    return packing.pack(_read(spark, folder, "documents"), VOCABULARY)


def op4_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's lines, how many of them are later copies, and what stays."""
    found = lines.marked(_read(spark, folder, "documents"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("n_lines").cast("long").alias("n_lines"),
        F.col("n_deleted").cast("long").alias("n_deleted"),
        F.md5("kept").alias("kept_md5"),
    )


LINES_SQL = f"""
WITH texts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS held FROM documents),
every AS (SELECT doc_id, unnest(held) AS line, generate_subscripts(held, 1) AS n FROM texts),
pairs AS (SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY n) AS next FROM every),
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, n) > 1 AS again,
    next IS NOT NULL AND row_number() OVER (PARTITION BY line, next ORDER BY doc_id, n) > 1 AS pair_again
  FROM pairs),
gone AS (
  SELECT *, pair_again OR coalesce(lag(pair_again) OVER (PARTITION BY doc_id ORDER BY n), false)
    OR (again AND length(line) - length(replace(line, ' ', '')) + 1 >= {lines.ALONE_WORDS}) AS deleted
  FROM firsts)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(deleted AS INT)) AS BIGINT) AS n_deleted,
  md5(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT deleted), '')) AS kept_md5
FROM gone GROUP BY doc_id
"""


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learned from the labels that are not held out."""
    docs, labels = _read(spark, folder, "documents"), _read(spark, folder, "labels")
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    scored = quality.score(docs, quality.fit(docs, labels, ~held_out))
    predicted = F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted)


def op6_top_products(spark: SparkSession, folder: str) -> DataFrame:
    """Ten best inner products of every hundredth embedding."""
    return topk.top_products(_read(spark, folder, "embeddings"))


def _digests(coded: DataFrame) -> DataFrame:
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op7_byte_pair(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return _digests(bpe.encode(_read(spark, folder, "documents"), VOCABULARY, decoded=True))


def op8_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return minhash.classes(_read(spark, folder, "documents"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    docs, labels = _read(spark, folder, "documents"), _read(spark, folder, "labels")
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    scored = toxicity.score(docs, toxicity.fit(docs, labels, ~held_out))
    predicted = F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted)


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    docs = _read(spark, folder, "documents")
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    found = language.classify(docs, language.fit(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and decoded text of every document by the piece vocabulary, as digests."""
    return _digests(pieces.encode(_read(spark, folder, "documents"), PIECES, decoded=True))


def op12_infill(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its middle at the end, as digests of that output and of the text rebuilt from it."""
    return infill.digests(_read(spark, folder, "documents"))


INFILL_SQL = """
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
numbers AS (
  SELECT doc_id, t, length(t) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM hashed),
cuts AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers),
parts AS (
  SELECT *, substring(t, 1, low) AS a, substring(t, low + 1, high - low) AS m, substring(t, high + 1) AS z FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN low END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || m
    ELSE '<S>' || z || '<P>' || a || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What five filters remove from every source, in all 120 orders."""
    counted = audit.counters(spark, f"{folder}/documents.parquet", _read(spark, folder, "labels"))
    return audit.interactions(counted)


AUDIT_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part FROM documents),
words AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts),
marks AS (
  SELECT doc_id, part,
    CASE WHEN len(w) < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM words),
flags AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels GROUP BY doc_id),
counted AS (
  SELECT part, mask, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
  FROM marks LEFT JOIN flags USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders),
bits AS (
  SELECT filter_order, step, bit,
    coalesce(sum(bit) OVER (PARTITION BY filter_order ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS before
  FROM steps JOIN letters ON f = substr(filter_order, step, 1)),
sums AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (bit | before) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit > 0 AND mask & before = 0 AND good THEN n ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & bit > 0 AND mask & before = 0 AND toxic THEN n ELSE 0 END) AS toxic_lost
  FROM counted, bits GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM sums
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_array": op1_suffix_array,
    "op2_embeddings": op2_embeddings,
    "op3_packing": op3_packing,
    "op4_lines": op4_lines,
    "op5_quality": op5_quality,
    "op6_top_products": op6_top_products,
    "op7_byte_pair": op7_byte_pair,
    "op8_minhash": op8_minhash,
    "op9_toxicity": op9_toxicity,
    "op10_language": op10_language,
    "op11_pieces": op11_pieces,
    "op12_infill": op12_infill,
    "op13_filter_audit": op13_filter_audit,
}
ORACLES: dict[str, str] = {"op4_lines": LINES_SQL, "op12_infill": INFILL_SQL, "op13_filter_audit": AUDIT_SQL}
