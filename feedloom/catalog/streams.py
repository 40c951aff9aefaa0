"""Streams over the events file, run to the end of what is available."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom import schemas as S
from feedloom.catalog import wide as W
from feedloom.catalog.base import READINGS, query, readings, table
from feedloom.functions import timetext
from feedloom.plans.wide_table import Feeds
from feedloom.session import scratch_dir
from feedloom.sinks import files, versions
from feedloom.streaming import fusing, landing


def _stream(spark, sf):
    schema = table(spark, sf, "events").schema
    # A stream lists folders; a pattern names the table itself, one file or a folder of them.
    return spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")


def _canon(df):
    return df.select("event_id", "user_id", "event_type", timetext.canonical("ts").alias(S.TS))


@query("stream_landing", """SELECT event_id, user_id, event_type,
  strftime(ts, '%Y-%m-%dT%H%M%S') AS call_timestamp, strftime(ts, '%Y-%m-%d') AS day FROM events""")
def stream_landing(spark, sf):
    out = scratch_dir(spark, "stream")
    landing.land_rows(_canon(_stream(spark, sf)), f"{out}/table",
                      f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/table").withColumn(
        "day", F.col("dt").cast("string")).drop("dt", "batch", "stream")


@query("stream_dedupe", """SELECT DISTINCT user_id, event_type FROM events""")
def stream_dedupe(spark, sf):
    """Watermarked dedupe; the delay spans the data, so keys are unique over all of it."""
    out = scratch_dir(spark, "stream")
    once = landing.dedupe_stream(_stream(spark, sf), ["user_id", "event_type"], "ts", "60 days")
    landing.start(once, lambda df, i: df.select("user_id", "event_type").write.mode(
        "overwrite").parquet(f"{out}/table/batch={i}"), f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/table").select("user_id", "event_type")


@query("stream_csv_landing", f"""WITH {READINGS} SELECT canon AS call_timestamp, 'R' || user_id % 10 AS station_id,
  CAST(cents AS DOUBLE) AS rainfall_realtime FROM ev WHERE event_type = 'view'""")
def stream_csv_landing(spark, sf):
    """CSV snapshots whose headers differ, picked up by one stream."""
    base = scratch_dir(spark, "stream")
    rain = W.rainfall_feed(readings(spark, sf)).withColumn(S.TS, F.col("timestamp"))
    even = F.col("station_id").isin(*[f"R{i}" for i in range(0, 10, 2)])
    files.write_csv(rain.filter(even), f"{base}/in/a")
    files.write_csv(rain.filter(~even).select(S.TS, "rainfall_realtime", "station_id"),
                    f"{base}/in/b")
    landing.land_csv(spark, f"{base}/in", S.RAINFALL, f"{base}/table",
                     f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/table").select(S.TS, "station_id", "rainfall_realtime")


@query("stream_fuse", f"WITH {W.WIDE_CTES} SELECT * FROM wide")
def stream_fuse(spark, sf):
    """Feeds land in two rounds. In the first one feed is late for a day and two have wrong
    values, which land again corrected after they were fused; the table ends up right."""
    base = scratch_dir(spark, "fuse")
    feeds = W.feeds(spark, sf)
    early = F.substring(S.TS, 1, 10) < "2024-01-16"
    wrong = {"rainfall": ("rainfall_realtime", F.lit(-1.0)),
             "congestion": ("trafficCongestion", F.lit("Mild"))}
    late = F.substring(S.TS, 1, 10) == "2024-01-10"
    again = F.substring(S.TS, 1, 10) == "2024-01-12"
    tables = {n: f"{base}/{n}" for n in Feeds.FACTS}
    target = f"{base}/target"

    def fuse():
        fusing.fuse_stream(spark, tables, feeds.routes, feeds.camera_map, target,
                           f"{base}/checkpoint").awaitTermination()

    for n in Feeds.FACTS:
        part = getattr(feeds, n).filter(early & ~(F.lit(n == "rainfall") & late))
        if n in wrong:
            name, value = wrong[n]
            part = part.withColumn(name, F.when(again, value).otherwise(F.col(name)))
        landing.write_batch(part, tables[n], "own", 0)
    fuse()
    for n in Feeds.FACTS:
        more = ~early | (F.lit(n == "rainfall") & late) | (F.lit(n in wrong) & again)
        landing.write_batch(getattr(feeds, n).filter(more), tables[n], "own", 1)
    fuse()
    return versions.read(spark, target).select(*S.WAREHOUSE.fieldNames())
