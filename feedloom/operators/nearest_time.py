"""Nearest snapshot by minute within the hour of a request."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions import timetext
from feedloom.schemas import TS


def minute_index(snapshots: DataFrame, ts: str = TS) -> DataFrame:
    """Per (date, hour) the first snapshot of each minute, at most 60 entries.

    Minutes are reduced on the map side, so an hour that holds much of the data is cheap.
    """
    per_minute = snapshots.filter(F.col(ts).isNotNull()).groupBy(
        timetext.date_part(ts).alias("date"), timetext.hour_part(ts).alias("hour"),
        timetext.minute_part(ts).cast("int").alias("minute"),
    ).agg(F.min(ts).alias("ts"))
    return per_minute.groupBy("date", "hour").agg(
        F.collect_list(F.struct("minute", "ts")).alias("minutes"))


def clamp_hour(hour) -> "F.Column":
    """The first and last hour of a day are answered from their inner neighbour."""
    hour = F.col(hour) if isinstance(hour, str) else hour
    return F.when(hour == "00", "01").when(hour == "23", "22").otherwise(hour)


def minute_lookup(snapshots: DataFrame, ts: str = TS, out: str = "nearest_ts") -> DataFrame:
    """Per (date, hour, minute 0 to 59) the nearest snapshot of that hour."""
    asked = minute_index(snapshots, ts).withColumn(
        "__m", F.explode(F.sequence(F.lit(0), F.lit(59))))
    best = F.array_min(F.transform("minutes", lambda x: F.struct(
        F.abs(x["minute"] - F.col("__m")).alias("diff"), x["ts"].alias("ts"))))
    return asked.select("date", "hour", "__m", best["ts"].alias(out))


def nearest_snapshot(requests: DataFrame, snapshots: DataFrame, *, ts: str = TS,
                     clamp: bool = True, out: str = "nearest_ts") -> DataFrame:
    """Adds the snapshot with the least minute difference to each request.

    ``requests`` holds ``date`` (yyyy-MM-dd) and ``time`` (HHmm or HHmmss). The earliest
    snapshot wins a tie; a request without a snapshot in its hour gets NULL. Where date or time
    is blank, both are those of the first snapshot held. Answers are worked out once per minute
    of an hour, so a request costs one equality join.
    """
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    first = snapshots.agg(F.min(ts)).scalar()
    unsaid = blank("date") | blank("time")
    requests = requests.withColumns({
        "date": F.when(unsaid, timetext.date_part(first)).otherwise(F.col("date")),
        "time": F.when(unsaid, timetext.hhmm_part(first)).otherwise(F.col("time"))})
    hour = F.substring("time", 1, 2)
    minute = F.least(F.substring("time", 3, 2).try_cast("int"), F.lit(59))
    asked = requests.withColumns({
        "hour": clamp_hour(hour) if clamp else hour, "__m": minute})
    return asked.join(minute_lookup(snapshots, ts, out), ["date", "hour", "__m"],
                      "left").drop("__m")
