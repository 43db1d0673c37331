"""Queries for table readers, writers and scopes: what is written in the shared folder is what is read."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from foretide import fixed
from foretide.operators import quality as Q
from foretide.operators.ordered import rank_rows
from foretide.plans import league as L
from foretide.plans import league_sql as D
from foretide.plans import pricing as P
from foretide.plans.catalogue import Shape, query
from foretide.session import run_folder, stable
from foretide.sources import tables as B


def _folder(spark, name):
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


_csv = Shape(whole="o_orderkey o_custkey", real="o_totalprice", text="o_orderstatus")


@query(
    "csv_scan",
    f"""WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS o_custkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS o_totalprice,
      o_orderstatus FROM orders) SELECT {_csv.sql} FROM o""",
)
def csv_scan(spark, folder):
    """Orders written as CSV with empty and unreadable cells, read with a declared schema; a missing file is no table."""
    path = _folder(spark, "csv")
    rows = L.read(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")).alias("o_custkey"),
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice").cast("string")).otherwise("a lot").alias("o_totalprice"), "o_orderstatus",
    )
    B.write_table(rows, path, "csv")
    schema = "o_orderkey long, o_custkey long, o_totalprice double, o_orderstatus string"
    none, why = B.read_optional(spark, f"{path}-absent", spark.read.csv)
    if none is not None or why != "file_missing":
        raise Q.DataProblem(f"{path}-absent: {why}")
    return _csv.of(B.read_optional(spark, path, lambda p: B.read_csv(spark, p, schema, schema.split()[::2]))[0])


_dated = Shape(whole="o_orderkey version", text="run_date")


@query(
    "dated_sink",
    f"""WITH o AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-01-01') AS run_date, CASE WHEN year(o_orderdate) >= 2000 THEN 2 ELSE 1 END AS version
      FROM orders WHERE year(o_orderdate) < 2000 OR o_orderkey % 2 = 0) SELECT {_dated.sql} FROM o""",
)
def dated_sink(spark, folder):
    """Dated snapshots of which a second run replaces only the dates it has."""
    path = _folder(spark, "dated")
    rows = L.read(spark, folder, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-01-01").alias("run_date"), F.lit(1).alias("version"))
    B.write_dated(rows, path)
    B.write_dated(rows.filter("run_date >= '2000' and o_orderkey % 2 = 0").withColumn("version", F.lit(2)), path)
    return _dated.of(spark.read.schema("o_orderkey long, version int, run_date string").parquet(path))


_range = Shape(text="first last")


@query("first_date_range", f"WITH {D.MATCHES}, r AS (SELECT CAST(min(date_match) AS VARCHAR) AS first, CAST(max(date_match) AS VARCHAR) AS last FROM matches) SELECT {_range.sql} FROM r")
def first_date_range(spark, folder):
    """First and last day of the finished table or, as here, of the matches it is made of."""
    path = _folder(spark, "matches")
    B.write_table(L.matches(spark, folder).select("id_match", F.col("date_match").alias("match_date")), path)
    first, last = B.first_date_range(spark, [f"{path}-finished", path], spark.read.parquet)
    return _range.of(spark.createDataFrame([(str(first), str(last))], "first string, last string"))


_scope = Shape(whole="id_match", text="saison")


@query("season_scope", f"WITH {D.MATCHES}, s AS (SELECT * FROM matches WHERE CAST(saison AS BIGINT) BETWEEN 19961997 AND 19992000) SELECT {_scope.sql} FROM s")
def season_scope(spark, folder):
    """Matches of four seasons."""
    return _scope.of(B.seasons_in_scope(L.matches(spark, folder), 19961997, 19992000))


_best = Shape(whole="place bet_id")


@query(
    "edges_by_value",
    f"""WITH e AS (SELECT o_orderkey AS bet_id, round(o_totalprice / 1000) AS ev_per_unit, o_custkey % 7 AS edge_probability, o_orderkey % 3 AS model_probability FROM orders),
    p AS (SELECT *, row_number() OVER (ORDER BY ev_per_unit DESC, edge_probability DESC, model_probability DESC, bet_id) AS place FROM e) SELECT {_best.sql} FROM p""",
)
def edges_by_value(spark, folder):
    """Place of every order in the listing of edges, best expected value first."""
    edges = L.read(spark, folder, "orders").select(
        F.col("o_orderkey").alias("bet_id"), F.round(F.col("o_totalprice") / 1000).alias("ev_per_unit"),
        (F.col("o_custkey") % 7).alias("edge_probability"), (F.col("o_orderkey") % 3).alias("model_probability"),
    )
    # The listing is sorted across its partitions: its place is the rank by partition and place inside.
    listed = P.by_value(edges).withColumn("at", F.monotonically_increasing_id())
    return _best.of(rank_rows(stable(listed), [], ["at"], "place"))


_features = Shape(text="feature state")


@query(
    "feature_guard",
    f"WITH f AS (SELECT unnest({fixed.BASELINE_FEATURES + ['points', 'id_match', 'no_such_column']}) AS feature), "
    f"s AS (SELECT feature, CASE WHEN feature IN ('points', 'id_match') THEN 'forbidden' WHEN feature = 'no_such_column' THEN 'missing' ELSE 'usable' END AS state FROM f) SELECT {_features.sql} FROM s",
)
def feature_guard(spark, folder):
    """What becomes of wanted features: usable, missing, or forbidden, over the columns of the feature table."""
    from foretide.plans import features as X

    table = X.all_features(L.fused(spark, folder), L.standings(spark, folder))
    usable, missing, banned = Q.resolve_features(table, fixed.BASELINE_FEATURES + ["points", "id_match", "no_such_column"], fixed.FORBIDDEN_FEATURES)
    Q.require_no_leak(usable, fixed.FORBIDDEN_FEATURES, fixed.TARGET, "date_match")
    rows = [(c, s) for s, names in (("usable", usable), ("missing", missing), ("forbidden", banned)) for c in names]
    return _features.of(spark.createDataFrame(rows, "feature string, state string"))
