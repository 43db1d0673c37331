"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretide.session import stable


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); component is the least node reachable.

    Each step is a partial minimum per node and one join; a hub's many edges may be split over tasks. Nothing but two
    numbers per step (rows and a checksum) reaches the driver.
    """
    pairs = edges.select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v"))
    pairs = stable(pairs.where("u > v").distinct())
    seen = None
    while True:
        both = pairs.union(pairs.select(F.col("v"), F.col("u")).toDF("u", "v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: every node's lesser neighbours, and itself, move to the least of them.
        large = large.where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m")))
        pairs = stable(small.where("u > v").distinct())
        check = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if check == seen:
            break
        seen = check
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stable(pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots))
