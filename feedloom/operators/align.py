"""Snapshots that all feeds share, slices of them, and the grid of expected rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions import timetext
from feedloom.schemas import TS

MODES = ("today", "yesterday", "before_today", "latest", "all")


def common_keys_intersect(feeds: list[DataFrame], key: str = TS) -> DataFrame:
    """INTERSECT form; each leg is reduced to its keys before it is shuffled."""
    return reduce(lambda a, b: a.intersect(b), [f.select(key).distinct() for f in feeds])


def common_keys(feeds: list[DataFrame], key: str = TS) -> DataFrame:
    """Same keys with one shuffle: each feed sets its bit, keys with all bits stay."""
    tagged = [f.select(key, F.lit(1 << i).alias("__bit")) for i, f in enumerate(feeds)]
    seen = reduce(DataFrame.unionAll, tagged).groupBy(key).agg(F.bit_or("__bit").alias("__all"))
    return (seen.filter((F.col("__all") == (1 << len(feeds)) - 1) & F.col(key).isNotNull())
            .select(key))


def slice_day(df: DataFrame, mode: str = "today", as_of=None, ts: str = TS) -> DataFrame:
    """Rows of a day mode. Safe on every feed before aligning; ``latest`` is not a day."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {MODES}")
    day = F.col("dt") if "dt" in df.columns else timetext.day(ts)
    today = timetext.as_date(as_of)
    if mode == "today":
        return df.filter(day.eqNullSafe(today))
    if mode == "yesterday":
        return df.filter(day.eqNullSafe(F.date_sub(today, 1)))
    if mode == "before_today":
        return df.filter(day < today)
    return df


def slice_latest(df: DataFrame, ts: str = TS) -> DataFrame:
    """Rows of the greatest timestamp; the maximum is a scalar subquery, not a collect."""
    latest = df.agg(F.max(ts).alias("m")).scalar()
    return df.filter(F.col(ts) == latest)


def slice_snapshots(df: DataFrame, mode: str = "today", as_of=None, ts: str = TS) -> DataFrame:
    return slice_latest(df, ts) if mode == "latest" else slice_day(df, mode, as_of, ts)


def missing_members(held: DataFrame, members: DataFrame, snapshots: DataFrame,
                    key: str = TS) -> DataFrame:
    """Members that a snapshot lacks; only missing rows come into being.

    ``held`` holds (key, members' columns), ``members`` is a dimension such as the cameras and
    their directions. The members a snapshot holds are one set per snapshot.
    """
    names = members.columns
    one = F.struct(*names)
    every = members.distinct().agg(F.collect_list(one)).scalar()
    have = held.groupBy(key).agg(F.collect_set(one).alias("__have"))
    asked = snapshots.select(key).distinct().join(have, key, "left")
    lacks = F.array_except(every, F.coalesce("__have", F.array_except(every, every)))
    return asked.select(key, F.inline(lacks))


def expected_grid(snapshots: DataFrame, members: DataFrame, *,
                  buckets: int | None = None) -> DataFrame:
    """Every snapshot with every member, the rows a complete table would hold.

    Members are spread over ``buckets``, as many as there are shuffle partitions, and meet each
    snapshot through an equality join on the bucket. All pairs are the feature here; the wide
    table and the report of missing rows do not build them.
    """
    buckets = buckets or int(snapshots.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = members.withColumn("__b", F.pmod(F.xxhash64(*members.columns), F.lit(buckets)))
    fanned = snapshots.withColumn(
        "__b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))))
    return fanned.join(spread, "__b").drop("__b")
