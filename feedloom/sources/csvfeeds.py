"""CSV feeds, bound to their schema by column name."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions import timetext
from feedloom.functions.nulls import cast_clean
from feedloom.operators.dedupe import FILE_LANDING, with_landing
from feedloom.schemas import TS
from feedloom.session import read_if_present

# Headers a row index is written under.
INDEX_COLUMNS = ("_c0", "Unnamed: 0")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, *,
             glob: str | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    """Files that share one header. Read as text, then cast by name: a user schema on
    the reader itself would bind by position. A file whose header differs fails the job."""
    def reader():
        own = spark.read.option("header", True)
        return own.option("pathGlobFilter", glob).option(
            "recursiveFileLookup", True) if glob else own

    texts = _texts(reader().csv(path).columns)
    raw = reader().option("enforceSchema", False).schema(texts).csv(path)
    return _typed(raw.drop(*INDEX_COLUMNS, *drop), schema, drop)


def _texts(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _typed(raw: DataFrame, schema: T.StructType, drop=(), keep=()) -> DataFrame:
    """Columns of the schema by name, an absent one as NULL."""
    have = set(raw.columns)
    return raw.select(*[
        (cast_clean(F.col(f"`{f.name}`"), f.dataType) if f.name in have
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields if f.name not in drop
    ], *keep)


def read_csv_by_name(spark: SparkSession, path: str | list[str], schema: T.StructType, *,
                     marker: str = TS, glob: str | None = None,
                     landing: bool = False, catalog: str | None = None) -> DataFrame:
    """Files whose headers differ in order or number of columns.

    Each file's header is the line that has ``marker`` among its cells. Files are
    then read by Spark's own reader, a group per distinct header, and unioned by name: rows do
    not meet headers in a join. The driver holds a path and a header per file, as it does to
    list them. A file with lines but no such header fails. ``landing`` adds the columns that
    tell when a row landed. ``catalog`` is a folder outside ``path`` that keeps the headers found,
    see :func:`headers`; without it every call looks for them in all files.
    """
    groups: dict[str, list[str]] = {}
    for file, head in headers(spark, path, marker, glob=glob, catalog=catalog):
        groups.setdefault(head, []).append(file)

    def read(head: str, files: list[str]) -> DataFrame:
        names = next(csv.reader([head]))
        seen = [n if n and n not in names[:i] else f"_c{i}" for i, n in enumerate(names)]
        raw = spark.read.option("header", True).schema(_texts(seen)).csv(sorted(files))
        return _typed(with_landing(raw) if landing else raw, schema,
                      keep=FILE_LANDING if landing else ())

    parts = [read(*g) for g in sorted(groups.items())]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame(
        [], schema)


def headers(spark: SparkSession, path: str | list[str], marker: str = TS, *,
            glob: str | None = None, catalog: str | None = None) -> list[tuple[str, str]]:
    """File and header line of each file that has lines.

    With a ``catalog`` files are listed, and only those that it does not know by path, length,
    modification time and marker are opened; what is found there is appended once all of them
    have a header. Two calls at once may both append a file's row, which says the same.
    """
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    if catalog is None:
        return _heads(reader.text(path), marker)
    meta = F.col("_metadata")
    files = reader.format("binaryFile").load(path).select(
        meta["file_path"].alias("file"), meta["file_size"].alias("length"),
        meta["file_modification_time"].alias("modified"), F.lit(marker).alias("marker"))
    listed = [tuple(r) for r in files.collect()]
    known = read_if_present(spark, catalog)
    own = {} if known is None else {tuple(r)[:4]: r["head"] for r in known.join(
        files, files.columns).select(*files.columns, "head").collect()}
    new = [f for f in listed if f not in own]
    if new:
        found = dict(_heads(spark.read.text(sorted(f[0] for f in new)), marker))
        rows = [(*f, found.get(f[0])) for f in new]
        spark.createDataFrame(rows, "file string, length long, modified timestamp, marker string, "
                              "head string").coalesce(1).write.mode("append").parquet(catalog)
        own.update((r[:4], r[4]) for r in rows)
    return [(f[0], own[f]) for f in listed if own[f] is not None]


def _heads(lines: DataFrame, marker: str) -> list[tuple[str, str]]:
    cells = F.split(F.replace(F.col("value"), F.lit('"'), F.lit("")), ",")
    heads = lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(F.when(F.array_contains(cells, marker), F.col("value"))).alias("head")).collect()
    bare = sorted(r["file"] for r in heads if r["head"] is None)
    if bare:
        raise ValueError(f"no header with {marker!r} in {bare[0]}" + (
            f" and {len(bare) - 1} more files" if bare[1:] else ""))
    return [(r["file"], r["head"]) for r in heads]


def read_snapshot(df: DataFrame, call_timestamp=None, ts: str = TS) -> DataFrame:
    """One snapshot of a feed; with a ``dt`` partition column only its folder is read."""
    if call_timestamp is None:
        return df
    stamp = str(call_timestamp)
    if "dt" in df.columns:
        df = df.filter(F.col("dt") == F.lit(stamp[:10]).cast("date"))
    return df.filter(F.col(ts) == stamp)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table partitioned by ``dt``."""
    return spark.read.parquet(path)


def with_day(df: DataFrame, ts: str = TS) -> DataFrame:
    """Adds the partition column ``dt``."""
    return df.withColumn("dt", timetext.day(ts))
