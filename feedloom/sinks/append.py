"""Append that keeps the key unique, so that a rerun adds nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators.dedupe import keep_last
from feedloom.schemas import TS, WAREHOUSE_KEY
from feedloom.session import cut_lineage, read_if_present
from feedloom.sinks.files import write_table
from feedloom.sources.csvfeeds import with_day


def new_rows(batch: DataFrame, target: DataFrame, keys=WAREHOUSE_KEY, *,
             order=()) -> DataFrame:
    """Rows of ``batch`` whose key ``target`` lacks, one per key."""
    keys = list(keys)
    rest = order or [c for c in batch.columns if c not in keys]
    once = keep_last(batch, keys, rest)
    return once.join(target.select(*keys).distinct(), keys, "left_anti")


def append_new(batch: DataFrame, path: str, keys=WAREHOUSE_KEY, *, ts: str = TS,
               days: list | None = None) -> None:
    """Append to the Parquet table at ``path``; reads only the days the batch touches.

    ``days`` lists them where the caller knows them; else the batch is written to the shared
    folder first and asked for its days. A list holds one value per calendar day at most.
    """
    target = read_if_present(batch.sparkSession, path)
    if target is None:
        rest = [c for c in batch.columns if c not in keys]
        write_table(keep_last(batch, list(keys), rest), path, ts=ts)
        return
    if days is None:
        batch = cut_lineage(batch)
        days = touched_days(batch, ts)
    touched = on_days(target, days)
    write_table(new_rows(batch, touched, keys), path, ts=ts)


def touched_days(df: DataFrame, ts: str = TS) -> list:
    """Calendar days of the rows' timestamps; None among them stands for bad ones."""
    return [r[0] for r in with_day(df, ts).select("dt").distinct().collect()]


def on_days(table: DataFrame, days: list) -> DataFrame:
    """Rows of a table by day on literal days, so that other folders are not listed or read."""
    known = [d for d in days if d is not None]
    here = F.col("dt").isin(known) if known else F.lit(False)
    return table.filter(here | F.col("dt").isNull() if None in days else here)


def union_new(target: DataFrame, batch: DataFrame, keys, *, order=()) -> DataFrame:
    """Target after the append, as one plan."""
    return target.unionByName(new_rows(batch, target, keys, order=order))
