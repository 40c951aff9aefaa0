"""JSON payload landing: one document per file, or one per row of a text column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.schemas import TS

# Snapshot time at the end of a file name, before the extension.
STAMP = r"(\d{4}-\d{2}-\d{2}T\d{6})\.[A-Za-z]+$"


def file_stamp(path) -> Column:
    """Snapshot time in a file name; NULL where there is none."""
    path = F.col(path) if isinstance(path, str) else path
    return F.nullif(F.regexp_extract(path, STAMP, 1), F.lit(""))


def read_payloads(spark: SparkSession, path: str, schema: T.StructType, *,
                  glob: str = "*.json") -> DataFrame:
    """Payload files as ``(call_timestamp, file, payload)``."""
    raw = (spark.read.schema(schema).option("multiLine", True)
           .option("pathGlobFilter", glob).option("recursiveFileLookup", True).json(path))
    return raw.select(
        file_stamp(F.col("_metadata.file_name")).alias(TS),
        F.col("_metadata.file_name").alias("file"),
        F.struct(*[F.col(f.name) for f in schema.fields]).alias("payload"),
    )


def parse_payloads(df: DataFrame, text: str, schema: T.StructType) -> DataFrame:
    """Replaces a JSON text column by the column ``payload``; bad JSON gives NULL."""
    return df.withColumn("payload", F.from_json(text, schema)).drop(text)


def flatten(df: DataFrame, column: str, prefix: str = "", sep: str = "_") -> DataFrame:
    """Nested struct ``column`` to flat columns joined by ``sep``, beside the others."""
    def walk(t: T.StructType, ref: str, name: str):
        for f in t.fields:
            here, flat = f"{ref}.`{f.name}`", f"{name}{f.name}"
            if isinstance(f.dataType, T.StructType):
                yield from walk(f.dataType, here, flat + sep)
            else:
                yield F.col(here).alias(flat)

    keep = [F.col(f"`{c}`") for c in df.columns if c != column]
    return df.select(*keep, *walk(df.schema[column].dataType, f"`{column}`", prefix))
