"""Small-file compaction of the landed feeds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import schemas as S
from feedloom.operators.dedupe import LANDING, keep_last, landing_order
from feedloom.sinks import versions
from feedloom.sinks.files import write_table
from feedloom.sources.csvfeeds import read_csv_by_name, with_day


@dataclass(frozen=True)
class Feed:
    name: str
    schema: object
    keys: tuple[str, ...]


# Feed file prefixes and the keys of one reading in each feed.
FEEDS = {f.name: f for f in (
    Feed("forecast-2HR", S.FORECAST_2HR, ("2hr_forecast_area", "2hr_start")),
    Feed("forecast-24HR", S.FORECAST_24HR, ("24hr_start",)),
    Feed("forecast-4DAY", S.FORECAST_4DAY, ("4day_date",)),
    Feed("rainfall-realtime", S.RAINFALL, ("timestamp", "station_id")),
    Feed("non-rainfall-realtime", S.NON_RAINFALL, ("timestamp", "station_id")),
    Feed("all-congestion-levels", S.CONGESTION, ()),
)}


def feed_glob(name: str) -> str:
    """The merged file and all snapshot files of a feed, and of no other feed."""
    return f"{name}{{,_*}}.csv"


def merge_snapshots(df: DataFrame, keys=(), *, per_snapshot: bool = True,
                    order=()) -> DataFrame:
    """Union of snapshots; with keys, the last landed reading of each.

    ``per_snapshot`` keeps one reading per snapshot and key. Without it a reading that
    several snapshots saw is kept in the latest of them only. The columns that tell when a row
    landed decide between readings of a snapshot, and are dropped.
    """
    if not keys:
        return df.drop(*LANDING)
    keys = [*([S.TS] if per_snapshot else []), *keys]
    rest = [c for c in landing_order(df, keys) if c != S.TS]
    return keep_last(df, keys, list(order) or [S.TS, *rest]).drop(*LANDING)


def compact(spark: SparkSession, landing: str, out: str, feed: str, *,
            dedupe: bool = False, per_snapshot: bool = True, glob: str | None = None,
            catalog: str | None = None) -> None:
    """Write every landed snapshot of ``feed`` to a new table version at ``out``.

    The landing files stay until the caller has switched to the new version. ``glob`` names them
    where they do not bear the feed's name, ``catalog`` the folder of headers already found.
    """
    spec = FEEDS[feed]
    rows = read_csv_by_name(spark, landing, spec.schema, glob=glob or feed_glob(feed),
                            landing=True, catalog=catalog)
    merged = merge_snapshots(rows, spec.keys if dedupe else (), per_snapshot=per_snapshot)
    write_table(merged, out, mode="errorifexists")


def roll_closed_days(spark: SparkSession, landed: str, rolled: str, feed: str, before, *,
                     dedupe: bool = True, per_snapshot: bool = True) -> list:
    """Move on what landed of a streamed table for the days before ``before``.

    Days with landed folders that no roll took are merged, those folders with what ``rolled``
    holds of the day, and become the day's next version; nothing else is read or written. A late
    batch or a corrected re-landing so reaches a day that was rolled before. The rows keep their
    batch, which decides between readings; the log of ``rolled`` names the folders taken. Returns
    the days. The owner may drop landed folders that were taken, and call ``vacuum``.
    """
    fresh = _fresh(spark, landed, rolled, F.col("dt") < F.lit(str(before)).cast("date"))
    days = sorted(fresh)
    if days:
        part = _on_folders(spark, landed, fresh).drop("dt")
        have = versions.read(spark, rolled, days)
        if have is not None:
            part = part.unionByName(have.select(*part.columns))
        keys = FEEDS[feed].keys if dedupe else ()
        if keys:
            keys = [*([S.TS] if per_snapshot else []), *keys]
            rest = [c for c in landing_order(part, keys) if c != S.TS]
            part = keep_last(part, keys, [S.TS, *rest])
        versions.commit(part, rolled, days=days, took=fresh)
    return days


def read_rolled(spark: SparkSession, landed: str, rolled: str) -> DataFrame:
    """The feed: the last version of each rolled day, and what no roll took as it landed."""
    fresh = _fresh(spark, landed, rolled)
    have = versions.read(spark, rolled)
    if have is None:
        return spark.read.parquet(landed).drop(*LANDING)
    have = have.drop(*LANDING)
    return have.unionByName(_on_folders(spark, landed, fresh).drop(*LANDING)) if fresh else have


def _fresh(spark: SparkSession, landed: str, rolled: str, where=None) -> dict:
    """Folders by day that no roll took. Spark lists the files, none is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(landed)
    files = files.select("dt", "batch", "stream")
    out = {}
    for d, batch, stream in (files if where is None else files.filter(where)).distinct().collect():
        out.setdefault(d, set()).add(f"batch={batch}/stream={stream}")
    done = versions.taken(spark, rolled, list(out))
    out = {d: names - done.get(d, set()) for d, names in out.items()}
    return {d: names for d, names in out.items() if names}


def _on_folders(spark: SparkSession, landed: str, folders: dict) -> DataFrame:
    """Rows of the folders; others are not listed or read."""
    paths = [f"{landed}/dt={versions.NO_DAY if d is None else d}/{name}"
             for d, names in folders.items() for name in names]
    rows = spark.read.option("basePath", landed).parquet(*sorted(paths))
    return rows.withColumn("dt", F.col("dt").cast("date"))


def compact_landed(spark: SparkSession, table: str, out: str, feed: str, *,
                   dedupe: bool = False, per_snapshot: bool = True) -> None:
    """Rewrite a streamed table, whose batches left many small files."""
    rows = spark.read.parquet(table).drop("dt")
    keys = FEEDS[feed].keys if dedupe else ()
    write_table(merge_snapshots(rows, keys, per_snapshot=per_snapshot), out,
                mode="errorifexists")
