"""Joins of readings with their metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def outer_merge(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on ``keys`` as a left join plus the unmatched right rows.

    A hot key on the left can be split at run time in a left join, but not in a full one.
    """
    matched = left.join(right, keys, "left")
    unmatched = right.join(left.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def accumulate(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Inner joins on ``keys``; of columns that several frames hold the first one stays."""
    def step(a: DataFrame, b: DataFrame) -> DataFrame:
        return a.join(b.select(*keys, *[f"`{c}`" for c in b.columns if c not in a.columns]),
                      keys)
    return reduce(step, frames)


def spread_join(big: DataFrame, side: DataFrame, on: list[str], how: str = "inner", *,
                salts: int = 16, by: list[str] | None = None) -> DataFrame:
    """Join with ``side`` copied to ``salts`` places and ``big`` dealt over them.

    For a known hot key where runtime splitting is off: no task holds more than about
    ``1 / salts`` of it. Rows are dealt by the columns ``by``, which the scan then reads, or
    at random from a seed, which spreads equal rows too. ``how`` is inner, left, left_semi or
    left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot spread a {how} join")
    deal = (F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in by]), F.lit(salts)) if by
            else F.floor(F.rand(7) * salts).cast("long"))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
    return (big.withColumn("__salt", deal)
            .join(side.withColumn("__salt", copies), [*on, "__salt"], how).drop("__salt"))
