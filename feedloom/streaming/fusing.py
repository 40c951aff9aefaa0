"""Incremental wide table: fuse the snapshots that new files touched."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from feedloom.functions import timetext
from feedloom.plans.wide_table import Feeds, build_wide_table, complete_snapshots
from feedloom.schemas import TS
from feedloom.session import cut_lineage
from feedloom.sinks.append import on_days, touched_days
from feedloom.sinks.versions import merge_days
from feedloom.streaming.landing import start


def touched_feeds(feeds: Feeds, touched: DataFrame, days: list | None = None) -> Feeds:
    """Rows of the touched snapshots; of tables by day only the touched folders are read."""
    stamps = touched.select(TS).distinct()
    days = touched_days(stamps) if days is None else days

    def narrow(df: DataFrame) -> DataFrame:
        part = on_days(df, days) if "dt" in df.columns else df
        return part.join(stamps, TS, "left_semi")

    return feeds.map_facts(narrow)


def fuse_touched(feeds: Feeds, touched: DataFrame, days: list | None = None, *,
                 complete: bool = False) -> DataFrame:
    """Wide rows of those touched snapshots that every feed holds by now.

    ``complete`` says that all of them are, so that feeds need not be asked.
    """
    part = touched_feeds(feeds, touched, days)
    return build_wide_table(part, snapshots=touched if complete else complete_snapshots(part))


def completed(arrivals: DataFrame, delay: str | None = None) -> DataFrame:
    """Snapshots of a stream ``TS, bit`` that all feeds have sent, as often as one sends more.

    The state is the feeds seen per snapshot, one small row each. Without ``delay`` it is kept
    for good, so a feed may be as late as it likes; with one, a snapshot that is older than the
    newest by more than that is forgotten, and what still lands for it is not seen.
    """
    own = arrivals.filter(F.col(TS).isNotNull())
    keys = [TS]
    if delay:
        own = own.withColumn("__at", timetext.to_ntz(TS).cast("timestamp")).withWatermark(
            "__at", delay)
        keys.append("__at")
    seen = own.groupBy(*keys).agg(F.bit_or("bit").alias("seen"))
    return seen.filter(F.col("seen") == (1 << len(Feeds.FACTS)) - 1).select(TS)


def fuse_stream(spark: SparkSession, tables: dict[str, str], routes: DataFrame,
                camera_map: DataFrame, target: str, checkpoint: str, *,
                every: str | None = None, delay: str | None = None) -> StreamingQuery:
    """Keep the wide table ``target`` (see :mod:`feedloom.sinks.versions`) up with its feeds.

    ``tables`` maps each fact feed to its landed table. A snapshot is withheld until all feeds
    have sent it: the stream's state tells, and feeds are read for complete snapshots only. What
    lands for a complete snapshot, a correction as well, fuses it again; its rows replace those
    in the table. A repeated batch changes nothing.
    """
    def stamps(name: str) -> DataFrame:
        schema = spark.read.parquet(tables[name]).schema
        bit = F.lit(1 << Feeds.FACTS.index(name)).alias("bit")
        return spark.readStream.schema(schema).parquet(tables[name]).select(TS, bit)

    arrivals = reduce(DataFrame.unionAll, [stamps(n) for n in Feeds.FACTS])

    def each(batch: DataFrame, _batch_id: int) -> None:
        session = batch.sparkSession
        touched = cut_lineage(batch)
        days = touched_days(touched)
        if days:
            feeds = Feeds(**{n: session.read.parquet(tables[n]) for n in Feeds.FACTS},
                          routes=routes, camera_map=camera_map)
            merge_days(fuse_touched(feeds, touched, days, complete=True), target)

    return start(completed(arrivals, delay), each, checkpoint, every=every, mode="update")
