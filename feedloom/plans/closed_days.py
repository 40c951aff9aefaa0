"""The hourly profile from sums that are kept by day.

A day's sums and row numbers per camera, direction and hour are worked out once the day is closed
and lie in a table of versions (:mod:`feedloom.sinks.versions`) whose log names the version of the
day that they stand for. The profile adds them up and scans only the days whose sums are missing or
out of date, so that a late batch or a corrected row counts at once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import schemas as S
from feedloom.functions import timetext
from feedloom.sinks import versions

KEYS = ("cam_id", "direction", "time_hr")


def day_sums(wide: DataFrame, measures=S.MEASURES) -> DataFrame:
    """Rows and sums of each measure, an absent value being zero, per day, camera, direction, hour."""
    zero = {m: F.coalesce(F.col(m).cast("double"), F.lit(0.0)) for m in measures}
    return wide.groupBy(timetext.day(S.TS).alias("dt"), "cam_id", "direction",
                        timetext.hour_part(S.TS).alias("time_hr")).agg(
        F.count("*").alias("n_rows"), *[F.sum(v).alias(m) for m, v in zero.items()])


def open_days(spark: SparkSession, table: str, sums: str) -> list:
    """Days of ``table`` whose last version ``sums`` does not stand for."""
    last = versions.current(spark, table)
    done = versions.taken(spark, sums, list(last))
    return [d for d, v in last.items() if _name(v) not in done.get(d, ())]


def _name(version: int) -> str:
    return f"version={version}"


def keep_sums(spark: SparkSession, table: str, sums: str, before, measures=S.MEASURES) -> list:
    """Bring the sums of the days before ``before`` up to date; returns the days it read.

    Rows without a readable day are never closed. ``measures`` stay the same over the life of
    ``sums``.
    """
    last = versions.current(spark, table)
    days = [d for d in open_days(spark, table, sums) if d is not None and str(d) < str(before)]
    if days:
        versions.commit(day_sums(versions.read(spark, table, days), measures), sums, days=days,
                        took={d: [_name(last[d])] for d in days}, ts="dt")
    return days


def profile(spark: SparkSession, table: str, sums: str, measures=S.MEASURES) -> DataFrame | None:
    """``hourly_profile`` of the whole table; None before its first version."""
    scan = open_days(spark, table, sums)
    kept = [d for d in versions.current(spark, table) if d not in scan]
    parts = [day_sums(versions.read(spark, table, scan), measures)] if scan else []
    if kept:
        parts.append(versions.read(spark, sums, kept))
    if not parts:
        return None
    n = F.sum("n_rows")
    return reduce(DataFrame.unionByName, parts).groupBy(*KEYS).agg(
        *[(F.sum(m) / n).alias(m) for m in measures]).fillna(0)
