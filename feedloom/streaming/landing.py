"""Landing streams: new snapshot files to a Parquet table by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from feedloom.schemas import TS
from feedloom.sinks.append import read_if_present
from feedloom.sources.csvfeeds import read_csv_by_name, with_day

FILE = "path string, modificationTime timestamp, length long, content binary"


def source_options(spark: SparkSession, *, max_files: int | None = None,
                   archive: str | None = None):
    """File stream reader; ``archive`` moves files there once they are committed."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader


def write_batch(df: DataFrame, out: str, stream: str, batch_id: int, *, ts: str = TS) -> None:
    """Rows of one micro-batch of a stream, in folders of their day, number and stream.

    A repeated batch replaces its own files, so each row lands once even if the job died between
    write and commit. Batches of other streams, and of the same source under a new checkpoint,
    have folders of their own. Numbers go on from stream to stream: what lands in a stream that
    was seen later counts as landed later.
    """
    number = stream_number(df.sparkSession, out, stream) << 32 | batch_id
    (with_day(df, ts).withColumn("batch", F.lit(number).cast("long"))
     .withColumn("stream", F.lit(stream))
     .hint("rebalance", F.col("dt"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dt", "batch", "stream").parquet(out))


def stream_number(spark: SparkSession, out: str, stream: str) -> int:
    """Place of a stream among those that wrote to a table; a new one is written down."""
    seen = read_if_present(spark, f"{out}.streams")
    rows = [] if seen is None else seen.groupBy("stream").agg(F.min("number")).collect()
    numbers = dict(map(tuple, rows))
    if stream not in numbers:
        numbers[stream] = max(numbers.values(), default=-1) + 1
        spark.createDataFrame([(stream, numbers[stream])], "stream string, number long").coalesce(
            1).write.mode("append").parquet(f"{out}.streams")
    return numbers[stream]


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Identity of the query that a checkpoint belongs to; a restarted query keeps it."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def lander(spark: SparkSession, out: str, checkpoint: str, shape=lambda df: df, ts: str = TS):
    """Writer of a stream's batches to ``out``, each through ``shape``."""
    return lambda df, i: write_batch(shape(df), out, stream_id(spark, checkpoint), i, ts=ts)


def start(stream: DataFrame, each, checkpoint: str, *, every: str | None = None,
          name: str | None = None, mode: str = "append") -> StreamingQuery:
    """Run ``each(batch, id)``; at an interval, or once over everything available."""
    writer = stream.writeStream.outputMode(mode).foreachBatch(each).option(
        "checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def land_csv(spark: SparkSession, landing: str, schema: T.StructType, out: str,
             checkpoint: str, *, glob: str = "*.csv", every: str | None = None,
             max_files: int | None = None, archive: str | None = None) -> StreamingQuery:
    """CSV snapshots, bound by name to the headers of each batch's files, however wide.

    The stream names new files without reading them; the batch reader then takes those files, a
    group per header. A file without rows below a header lands nothing.
    """
    reader = source_options(spark, max_files=max_files, archive=archive)
    files = reader.format("binaryFile").schema(FILE).option("pathGlobFilter", glob).option(
        "recursiveFileLookup", True).load(landing).select("path")

    def each(batch: DataFrame, i: int) -> None:
        paths = [r.path for r in batch.collect()]
        if paths:
            land(read_csv_by_name(batch.sparkSession, paths, schema), i)

    land = lander(spark, out, checkpoint)
    return start(files, each, checkpoint, every=every)


def land_json(spark: SparkSession, landing: str, schema: T.StructType, tabulate, out: str,
              checkpoint: str, *, glob: str = "*.json", every: str | None = None,
              max_files: int | None = None) -> StreamingQuery:
    """JSON payload files through a tabulation of :mod:`feedloom.plans.tabulate`."""
    from feedloom.sources.payloads import file_stamp

    reader = source_options(spark, max_files=max_files).schema(schema)
    raw = reader.option("multiLine", True).option("pathGlobFilter", glob).json(landing)
    payloads = raw.select(file_stamp(F.col("_metadata.file_name")).alias(TS),
                          F.struct(*[F.col(f.name) for f in schema.fields]).alias("payload"))
    return start(payloads, lander(spark, out, checkpoint, tabulate), checkpoint, every=every)


def land_rows(stream: DataFrame, out: str, checkpoint: str, *, ts: str = TS,
              every: str | None = None) -> StreamingQuery:
    """Any stream that already has feed columns."""
    land = lander(stream.sparkSession, out, checkpoint, ts=ts)
    return start(stream, land, checkpoint, every=every)


def dedupe_stream(stream: DataFrame, keys: list[str], event_time: str,
                  delay: str = "1 hour") -> DataFrame:
    """First row per key; state older than ``delay`` is dropped. TIMESTAMP_NTZ is cast,
    since watermarks need an instant."""
    timed = stream.withColumn("__t", F.col(event_time).cast("timestamp"))
    return (timed.withWatermark("__t", delay).dropDuplicatesWithinWatermark(keys)
            .drop("__t"))
