"""Wide to long and long to wide."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def melt(df: DataFrame, ids: list[str], values: list[str], *, name: str = "variable",
         value: str = "value") -> DataFrame:
    """One row per id row and value column; NULL values stay."""
    return df.unpivot([f"`{c}`" for c in ids], [f"`{c}`" for c in values], name, value)


def paired_unpivot(df: DataFrame, ids: list[str], stems: list[str], indexes, *,
                   index_name: str = "direction") -> DataFrame:
    """Columns ``stem_1 .. stem_n`` to rows ``(index, stem...)``; incomplete rows drop."""
    slots = [f"named_struct('{index_name}', {i}L, "
             + ", ".join(f"'{s}', `{s}_{i}`" for s in stems) + ")" for i in indexes]
    long = df.selectExpr(*[f"`{c}`" for c in ids], f"inline(array({', '.join(slots)}))")
    return long.dropna("any", subset=stems)


def ranked_pivot(df: DataFrame, keys: list[str], order: list, values: list[str], n: int, *,
                 within: list | None = None) -> DataFrame:
    """First ``n`` rows of each key by ``order`` side by side as ``value_1 .. value_n``.

    ``within`` puts groups inside a key in order; only the rows of the first one count.
    The rank filter reaches the map side, where every task keeps ``n`` rows per key.
    """
    within = within or []
    w = W.partitionBy(*keys).orderBy(*within, *order)
    top = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n)
    if within:
        g = W.partitionBy(*keys).orderBy(*within)
        top = top.withColumn("__grp", F.dense_rank().over(g)).filter(F.col("__grp") == 1)
    return top.groupBy(*keys).agg(*[
        F.expr(f"max(CASE WHEN __rn = {i} THEN `{v}` END) AS `{v}_{i}`")
        for i in range(1, n + 1) for v in values
    ])


def group_reshape(df: DataFrame, ids: list[str], groups: list[str], columns: dict, *,
                  name: str) -> DataFrame:
    """One row per group: ``columns`` maps an output name to ``group -> input column``."""
    slots = [f"named_struct('{name}', '{g}', "
             + ", ".join(f"'{out}', `{source(g)}`" for out, source in columns.items()) + ")"
             for g in groups]
    return df.selectExpr(*[f"`{c}`" for c in ids], f"inline(array({', '.join(slots)}))")


def name_tail(c, sep: str = "_"):
    """Last part of a separated name."""
    c = F.col(c) if isinstance(c, str) else c
    return F.element_at(F.split(c, sep), -1)


def rename(df: DataFrame, how) -> DataFrame:
    """Every column through a function of its name."""
    return df.toDF(*[how(c) for c in df.columns])


def prefix(df: DataFrame, text: str, *, keep: tuple[str, ...] = ()) -> DataFrame:
    return rename(df, lambda c: c if c in keep else text + c)


def place(df: DataFrame, column: str, position: int) -> DataFrame:
    """Moves a column to a zero-based position."""
    order = [c for c in df.columns if c != column]
    order.insert(position, column)
    return df.select(*[f"`{c}`" for c in order])


def stack_all(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by name; a column a frame lacks is NULL there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
