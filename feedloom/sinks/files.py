"""File writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.schemas import TS, WAREHOUSE
from feedloom.sources.csvfeeds import with_day


def conform(df: DataFrame, schema=WAREHOUSE) -> DataFrame:
    """Columns of the contract in its order and types; a missing one raises."""
    missing = [n for n in schema.fieldNames() if n not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the wide table: {missing}")
    return df.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`"
                           for f in schema.fields])


def key_violations(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_single_csv(df: DataFrame, path: str, *, mode: str = "append") -> None:
    """One file with header, written by one task: an export of a small result. Larger ones
    belong in :func:`write_csv`."""
    df.coalesce(1).write.mode(mode).option("header", True).csv(path)


def write_bulk_copy(df: DataFrame, path: str, *, schema=WAREHOUSE,
                    mode: str = "overwrite") -> None:
    """Headerless CSV in contract order, NULL as empty, for a bulk COPY."""
    (conform(df, schema).write.mode(mode).option("header", False)
     .option("nullValue", "").option("emptyValue", "").csv(path))


def write_json_log(df: DataFrame, path: str, *, mode: str = "append") -> None:
    """Payload log, one document per line."""
    df.write.mode(mode).json(path)


def write_table(df: DataFrame, path: str, *, ts: str = TS, mode: str = "append") -> None:
    """Parquet by day. Rebalancing sizes the files and splits a day that holds too much."""
    (with_day(df, ts).hint("rebalance", F.col("dt"))
     .write.mode(mode).partitionBy("dt").parquet(path))
