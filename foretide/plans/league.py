"""The sports tables, derived from the order tables.

An order is a match (its customer gives the home team), a line item is a player's part in it
(its supplier is the player). Everything is computed by Spark from the whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foretide import fixed
from foretide.functions import scalars as S
from foretide.session import spread

TEAMS = sorted(fixed.TEAM_NAMES)
# Orders from this day on count as matches still to be played.
FUTURE_FROM = "2001-07-01"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _team(index) -> F.Column:
    return F.element_at(F.array(*[F.lit(t) for t in TEAMS]), (index + 1).cast("int"))


def matches(spark: SparkSession, folder: str) -> DataFrame:
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    day = F.to_date("o_orderdate")
    year = F.year(day) - F.when(F.month(day) < 7, 1).otherwise(0)
    home = F.col("o_custkey") % 32
    away = (home + 1 + F.col("o_orderkey") % 31) % 32
    played = day < F.lit(FUTURE_FROM).cast("date")
    return orders.select(
        F.col("o_orderkey").alias("id_match"),
        day.alias("date_match"),
        F.concat(year.cast("string"), (year + 1).cast("string")).alias("saison"),
        _team(home).alias("id_equipe_domicile"),
        _team(away).alias("id_equipe_exterieur"),
        F.when(played, F.col("o_orderkey") % 7).alias("buts_domicile"),
        F.when(played, (F.col("o_custkey") * 3 + F.col("o_orderkey")) % 6).alias("buts_exterieur"),
        F.when(played, "OFF").otherwise("FUT").alias("status"),
    )


def stats(spark: SparkSession, folder: str, games: DataFrame | None = None) -> DataFrame:
    """Player rows of played matches. Quantities are summed per (match, player) before the join."""
    games = matches(spark, folder) if games is None else games
    parts = read(spark, folder, "lineitem").select(F.col("l_orderkey").alias("id_match"), F.col("l_suppkey").alias("id_joueur"), "l_quantity")
    # Hashed by match for the sums and joins; the base's window over typed keys shuffles once more.
    lines = spread(parts, ["id_match"], parts.count()).groupBy("id_match", "id_joueur").agg(F.sum("l_quantity").cast("bigint").alias("q"))
    rows = lines.join(games.filter(F.col("status") == "OFF"), "id_match")
    q, home = F.col("q"), F.col("id_joueur") % 2 == 1
    goals = F.when(q % 5 == 0, 1 + q % 2).otherwise(0)
    assists = F.when(q % 3 == 0, 1).otherwise(0)
    clock = lambda m, s: F.concat_ws(":", F.lpad(m.cast("string"), 2, "0"), F.lpad(s.cast("string"), 2, "0"))
    return rows.select(
        "id_joueur",
        "id_match",
        "date_match",
        F.col("saison").alias("season_source"),
        F.when(home, F.col("id_equipe_domicile")).otherwise(F.col("id_equipe_exterieur")).alias("team_player_match"),
        F.when(home, F.col("id_equipe_exterieur")).otherwise(F.col("id_equipe_domicile")).alias("adversaire_match"),
        F.when(home, "H").otherwise("R").alias("home_road_flag"),
        home.cast("int").alias("is_home_player"),
        goals.alias("buts"),
        assists.alias("passes"),
        (goals + assists).alias("points"),
        (q % 8).alias("tirs"),
        clock(8 + q % 15, (q * 7 + F.col("id_match")) % 60).alias("temps_de_glace"),
        clock(q % 5, (q * 11) % 60).alias("temps_pp"),
        (q % 5 - 2).alias("plus_moins"),
        F.when(q % 4 == 0, 2).otherwise(0).alias("penalty_minutes"),
    )


def players(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as players, with a short name built from the part of the same number."""
    words = F.split("p_name", " ")
    number = F.lpad(F.col("s_suppkey").cast("string"), 6, "0")
    names = read(spark, folder, "part").select(F.col("p_partkey").alias("s_suppkey"), words.alias("w"))
    code = F.element_at(F.array(*[F.lit(p) for p in ("L", "R", "C", "D", "D", "G")]), (F.col("s_suppkey") % 6 + 1).cast("int"))
    return (
        read(spark, folder, "supplier")
        .join(names, "s_suppkey")
        .select(
            F.col("s_suppkey").alias("id_joueur"),
            F.concat(F.upper(F.substring(F.get("w", F.lit(0)), 1, 1)), F.lit(". "), F.initcap(F.get("w", F.lit(1))),
                     F.lit("sson"), number).alias("nom"),
            F.concat(F.initcap(F.get("w", F.lit(0))), F.lit(" "), F.initcap(F.get("w", F.lit(1))),
                     F.lit("sson"), number).alias("full_name"),
            code.alias("position"),
            _team(F.col("s_nationkey") % 32).alias("id_equipe"),
        )
    )


def standings(spark: SparkSession, folder: str, games: DataFrame | None = None) -> DataFrame:
    """Month-end standings per team: points over the season so far, ranked per conference and division."""
    games = matches(spark, folder) if games is None else games
    side = lambda team, gf, ga: F.struct(F.col(team).alias("team"), F.col(gf).alias("gf"), F.col(ga).alias("ga"))
    rows = games.filter(F.col("status") == "OFF").select(
        F.last_day("date_match").alias("date_snapshot"),
        "saison",
        F.explode(F.array(side("id_equipe_domicile", "buts_domicile", "buts_exterieur"),
                          side("id_equipe_exterieur", "buts_exterieur", "buts_domicile"))).alias("s"),
    )
    month = rows.groupBy("date_snapshot", "saison", F.col("s.team").alias("team_abbrev")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("s.gf") > F.col("s.ga"), 2).otherwise(0)).alias("p"),
        F.sum(F.col("s.gf") - F.col("s.ga")).alias("d"),
    )
    # One row per team and month: at most 12 per window key.
    so_far = Window.partitionBy("team_abbrev", "saison").orderBy("date_snapshot")
    table = month.select(
        "date_snapshot", "saison", "team_abbrev",
        F.sum("n").over(so_far).alias("games_played"),
        F.sum("p").over(so_far).alias("points"),
        F.sum("d").over(so_far).alias("goal_differential"),
        F.col("p").alias("l10_points"),
        F.when(F.ascii("team_abbrev") % 2 == 0, "E").otherwise("W").alias("conference_abbrev"),
    )
    table = table.withColumn(
        "division_abbrev", F.concat("conference_abbrev", F.when(F.ascii(F.substring("team_abbrev", 2, 1)) % 2 == 0, "1").otherwise("2"))
    )
    ranked = lambda *keys: Window.partitionBy("date_snapshot", *keys).orderBy(F.desc("points"), "team_abbrev")
    return table.withColumns(
        {
            "games_remaining": S.clip(fixed.GAMES_PER_SEASON - F.col("games_played"), 0, fixed.GAMES_PER_SEASON),
            "point_pctg": F.col("points") / (2 * F.col("games_played")),
            "conference_sequence": F.row_number().over(ranked("conference_abbrev")),
            "division_sequence": F.row_number().over(ranked("division_abbrev")),
            "wildcard_sequence": F.row_number().over(ranked("conference_abbrev")) - 4,
        }
    )


def fused(spark: SparkSession, folder: str) -> DataFrame:
    from foretide.plans.features import fused_base

    games = matches(spark, folder)
    return fused_base(stats(spark, folder, games), games)
