"""Last row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Columns that tell when a row landed, the strongest first.
FILE_LANDING = ("landed_at", "landed_file")
LANDING = ("batch", "stream", *FILE_LANDING)


def landing_order(df: DataFrame, keys) -> list[str]:
    """Columns to order by for the last landed row of a key; values break ties only."""
    rest = [c for c in df.columns if c not in (*keys, *LANDING)]
    return [c for c in LANDING if c in df.columns] + rest


def with_landing(df: DataFrame) -> DataFrame:
    """Adds time and path of the file each row was read from; ``df`` is a file scan."""
    return df.withColumns({"landed_at": F.col("_metadata.file_modification_time"),
                           "landed_file": F.col("_metadata.file_path")})


def names(columns) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` of each key.

    An aggregate, not a window: every task first reduces its own rows to one per key, so a
    key with very many rows never meets in one task. ``order`` should be total.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    row = F.expr(f"max_by(struct({names(rest)}), struct({names(order)})) AS __row")
    # Keys come from the grouping, so a join on them needs no further exchange.
    last = df.groupBy(*[f"`{k}`" for k in keys]).agg(row)
    return last.select(*[f"`{c}`" if c in keys else f"__row.`{c}`" for c in df.columns])
