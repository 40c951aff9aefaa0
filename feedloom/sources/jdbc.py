"""Warehouse table over JDBC, read in parallel by day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from feedloom.schemas import TS


def day_predicates(first: dt.date, last: dt.date, ts: str = TS, days: int = 1) -> list[str]:
    """Disjoint WHERE clauses that together cover every row, ``days`` per partition.

    The first and last clause are open so that rows outside the range stay in the result.
    """
    if last < first:
        raise ValueError("last day before first day")
    cuts, cut = [], first + dt.timedelta(days=days)
    while cut <= last:
        cuts.append(cut.isoformat())
        cut += dt.timedelta(days=days)
    if not cuts:
        return [f"{ts} IS NULL OR 1 = 1"]
    inner = [f"{ts} >= '{a}' AND {ts} < '{b}'" for a, b in zip(cuts, cuts[1:])]
    return [f"{ts} < '{cuts[0]}' OR {ts} IS NULL", *inner, f"{ts} >= '{cuts[-1]}'"]


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict, *,
              predicates: list[str] | None = None, column: str | None = None,
              lower: int | None = None, upper: int | None = None,
              num_partitions: int = 1) -> DataFrame:
    """Parallel by predicates, or by a numeric column; filters are pushed to the server."""
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    if column:
        return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper,
                               numPartitions=num_partitions, properties=properties)
    return spark.read.jdbc(url, table, properties=properties)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict, *,
               mode: str = "append", connections: int = 16) -> None:
    """One connection per partition, at most ``connections`` at a time."""
    df.write.option("numPartitions", connections).jdbc(url, table, mode=mode,
                                                       properties=properties)
