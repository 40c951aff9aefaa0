"""Tables whose days are replaced whole: a folder per day and version, and a log beside the table.

A commit writes the days it touches as their next version, then a row per day to the log at
``<table>.log``; until that is there, readers see the versions before. Readers take the last
version of each day from the log and open its folder only. A commit that died before its log row
is written over by the next one, which takes the same number. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.dedupe import keep_last
from feedloom.schemas import TS, WAREHOUSE_KEY
from feedloom.session import cut_lineage, read_if_present, remove
from feedloom.sinks.append import on_days, touched_days
from feedloom.sources.csvfeeds import with_day

LOG = "commit long, dt date, took array<string>"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def log(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows ``commit, dt, took``; None before the first commit. Days number as the calendar has
    them and a row names only what its commit took, so the log stays small."""
    return read_if_present(spark, f"{path}.log")


def current(spark: SparkSession, path: str) -> dict:
    """Version of each day, one entry per calendar day."""
    rows = log(spark, path)
    if rows is None:
        return {}
    return dict(rows.groupBy("dt").agg(F.max("commit")).collect())


def taken(spark: SparkSession, path: str, days: list) -> dict:
    """What the commits of each of the days took, as the log has it."""
    rows = log(spark, path)
    if rows is None or not days:
        return {}
    own = on_days(rows, days).select("dt", F.explode("took").alias("name"))
    return {r.dt: set(r.names) for r in own.groupBy("dt").agg(
        F.collect_set("name").alias("names")).collect()}


def folder(path: str, day, version: int) -> str:
    return f"{path}/dt={NO_DAY if day is None else day}/version={version}"


def read(spark: SparkSession, path: str, days: list | None = None) -> DataFrame | None:
    """The table as of the last commit, with its column ``dt``; of some days only, if named.

    None where no such day was committed.
    """
    last = current(spark, path)
    own = [folder(path, d, v) for d, v in last.items() if days is None or d in days]
    if not own:
        return None
    rows = spark.read.option("basePath", path).parquet(*sorted(own))
    return rows.drop("version").withColumn("dt", F.col("dt").cast("date"))


def commit(df: DataFrame, path: str, *, days: list, took: dict | None = None,
           ts: str = TS) -> int:
    """Make ``df`` the next version of each of ``days``; it holds whole days and no others."""
    spark = df.sparkSession
    number = max(current(spark, path).values(), default=0) + 1
    (with_day(df, ts).withColumn("version", F.lit(number).cast("long"))
     .hint("rebalance", F.col("dt"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dt", "version").parquet(path))
    rows = [(number, d, sorted((took or {}).get(d, ()))) for d in days]
    spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(f"{path}.log")
    return number


def merge_days(batch: DataFrame, path: str, keys=WAREHOUSE_KEY, *, ts: str = TS,
               order=()) -> list:
    """Rows of ``batch`` replace those of the same key, the others of their days stay.

    Reads and writes only days in which a row is new or differs, and returns them; a batch that
    comes again changes nothing. Of several rows with a key the batch's greatest by ``order``
    (by its values if none is given) counts; null keys are keys like any other.
    """
    keys, spark = list(keys), batch.sparkSession
    batch = cut_lineage(keep_last(batch, keys, list(order) or [
        c for c in batch.columns if c not in keys]))
    days = touched_days(batch, ts)
    have = read(spark, path, days)
    if have is not None:
        days = touched_days(batch.subtract(have.select(*batch.columns)), ts)
        batch = on_days(with_day(batch, ts), days)
        rows = batch.withColumn("__new", F.lit(1)).unionByName(
            on_days(have, days).withColumn("__new", F.lit(0)))
        batch = keep_last(rows, keys, ["__new"]).drop("__new", "dt")
    if days:
        commit(batch, path, days=days, ts=ts)
    return days


def vacuum(spark: SparkSession, path: str, *, keep: int = 1) -> list[str]:
    """Remove all but the last ``keep`` versions of each day; readers of older ones must be done.

    Versions are those the log names, so what an unfinished commit left stays until the commit
    that takes its number.
    """
    rows = log(spark, path)
    if rows is None:
        return []
    each = rows.groupBy("dt").agg(F.sort_array(F.collect_set("commit"), False).alias("all"))
    old = [folder(path, r.dt, v) for r in each.collect() for v in r["all"][keep:]]
    return [f for f in old if remove(spark, f)]
