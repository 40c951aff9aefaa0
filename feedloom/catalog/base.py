"""Registry and the frames several queries derive from the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import timetext
from feedloom.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without SQL only its rows are checked."""
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as readings: canonical time, six-hourly snapshot, value in cents, key of props."""
    canon = timetext.canonical("ts")
    slot = (F.floor(timetext.hour_part(canon).cast("int") / 6) * 6).cast("string")
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "props",
        canon.alias("canon"),
        F.concat(F.substring(canon, 1, 11), F.lpad(slot, 2, "0"), F.lit("0000"))
        .alias("call_timestamp"),
        F.round(F.col("value") * 100).cast("long").alias("cents"),
        F.regexp_extract("props", r"(\d+)", 1).cast("long").alias("k"),
    )


READINGS = r"""ev AS (
  SELECT event_id, user_id, event_type, props,
         strftime(ts, '%Y-%m-%dT%H%M%S') AS canon,
         strftime(ts, '%Y-%m-%dT') || lpad(CAST((hour(ts) // 6) * 6 AS VARCHAR), 2, '0')
           || '0000' AS call_timestamp,
         CAST(round(value * 100) AS BIGINT) AS cents,
         CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) AS k
  FROM events)"""


def label_of(k):
    """Label of a key; every tenth is unknown."""
    return (F.when(k % 10 == 0, F.lit(None).cast("string")).when(k % 4 == 0, "None")
            .when(k % 4 == 1, "Mild").when(k % 4 == 2, "Medium").otherwise("Heavy"))


LABEL_SQL = """CASE WHEN k % 10 = 0 THEN NULL WHEN k % 4 = 0 THEN 'None'
  WHEN k % 4 = 1 THEN 'Mild' WHEN k % 4 = 2 THEN 'Medium' ELSE 'Heavy' END"""

TYPES = ("view", "click", "signup", "error", "purchase")


def light_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as rows of the wide table: key, label, two measures."""
    ev = readings(spark, sf_dir)
    return ev.select(
        F.col("canon").alias("call_timestamp"), F.col("user_id").alias("cam_id"),
        (F.col("event_id") % 3 + 1).alias("direction"), F.col("event_id"),
        label_of(F.col("k")).alias("trafficcongestion"),
        F.when(F.col("k") % 7 != 0, F.col("cents")).alias("rainfall_realtime"),
        F.col("k").alias("wind_speed_realtime"))


LIGHT_WIDE = READINGS + f""", lw AS (
  SELECT canon AS call_timestamp, user_id AS cam_id, event_id % 3 + 1 AS direction, event_id,
         {LABEL_SQL} AS trafficcongestion,
         CASE WHEN k % 7 <> 0 THEN cents END AS rainfall_realtime,
         k AS wind_speed_realtime
  FROM ev)"""
