"""Incremental refresh of the daily snapshot table.

Not a stream: every run is a batch that can be repeated without changing the result. Days that are
complete are left alone; missing and incomplete days are taken again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretide import fixed
from foretide.functions import scalars as S
from foretide.operators import keyed as K
from foretide.operators.quality import complete_groups


def target_days(matches: DataFrame, start: str | None = None, end: str | None = None, today: str | None = None,
                extra: DataFrame | None = None) -> DataFrame:
    """Distinct match days, today and extra days inside the range; the range never passes today."""
    day = S.day("date_match").alias("date_snapshot")
    days = matches.select(day)
    if extra is not None:
        days = days.unionByName(extra.select(S.day("date_snapshot").alias("date_snapshot")))
    now = F.lit(today).cast("date") if today else F.current_date()
    one = matches.sparkSession.range(1).select(now.alias("date_snapshot"))
    last = F.least(F.lit(end).cast("date"), now) if end else now
    keep = F.col("date_snapshot") <= last
    if start:
        keep = keep & (F.col("date_snapshot") >= F.lit(start).cast("date"))
    return days.unionByName(one).filter(keep).distinct()


def missing_days(targets: DataFrame, stored: DataFrame, expected: int = fixed.TEAMS_PER_DAY) -> DataFrame:
    """Target days that are not stored completely."""
    done = complete_groups(stored, "date_snapshot", "team_abbrev", expected).filter("complete = 1")
    return targets.join(done.select(S.day("date_snapshot").alias("date_snapshot")), "date_snapshot", "left_anti")


def merge_snapshots(stored: DataFrame, fresh: DataFrame, expected: int = fixed.TEAMS_PER_DAY) -> DataFrame:
    """Complete stored days plus fresh rows; a fresh row replaces a stored one of the same day and team."""
    done = complete_groups(stored, "date_snapshot", "team_abbrev", expected).filter("complete = 1").select("date_snapshot")
    kept = stored.join(done, "date_snapshot", "left_semi")
    clean = lambda df: df.withColumns({"date_snapshot": S.day("date_snapshot"), "team_abbrev": S.upper_code("team_abbrev")}).filter(
        F.col("date_snapshot").isNotNull()
    )
    return K.upsert(clean(kept), clean(fresh), ["date_snapshot", "team_abbrev"], ["points"])


def write_days(df: DataFrame, path: str) -> None:
    """Replace only the days present in df."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date_snapshot").parquet(path)
