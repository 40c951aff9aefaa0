"""Profiles, margins and summaries; all are partial aggregates before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOTAL = "Total"


def mean_profile(df: DataFrame, keys: list, measures: list[str]) -> DataFrame:
    """Mean of each measure per key, an absent value counting as zero."""
    return df.groupBy(*keys).agg(*[
        F.expr(f"avg(coalesce(CAST(`{m}` AS DOUBLE), 0D)) AS `{m}`") for m in measures
    ]).fillna(0)


def crosstab_long(df: DataFrame, row: str, column: str) -> DataFrame:
    """Counts per pair with totals per row, per column and overall."""
    pairs = df.dropna("any", subset=[row, column])
    cube = pairs.cube(row, column).agg(
        F.count(F.lit(1)).alias("n"), F.grouping(row).alias("__r"),
        F.grouping(column).alias("__c"))
    return cube.select(
        F.when(F.col("__r") == 1, TOTAL).otherwise(F.col(row).cast("string")).alias(row),
        F.when(F.col("__c") == 1, TOTAL).otherwise(F.col(column).cast("string")).alias(column),
        "n")


def crosstab_wide(df: DataFrame, row: str, column: str, classes: list) -> DataFrame:
    """Confusion matrix: one row per ``row`` value, one column per class, totals last.

    A value outside ``classes`` has no column; it fails the job, as the totals would not add up.
    """
    pairs = df.dropna("any", subset=[row, column])
    listed = F.assert_true(F.col(column).isin(list(classes)), F.concat(
        F.lit(f"{column} holds a value outside the classes: "), F.col(column).cast("string")))
    pairs = pairs.filter(listed.isNull())
    counts = [F.count_if(F.col(column) == F.lit(c)).alias(str(c)) for c in classes]
    out = pairs.rollup(row).agg(*counts, F.count(F.lit(1)).alias(TOTAL),
                                F.grouping(row).alias("__r"))
    shown = F.when(F.col("__r") == 1, TOTAL).otherwise(F.col(row).cast("string")).alias(row)
    return out.select(shown, *[f"`{c}`" for c in classes], TOTAL)


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Share of equal pairs in one pass; a NULL on either side counts as wrong."""
    hit = F.coalesce(F.col(label) == F.col(prediction), F.lit(False))
    return df.agg(F.count_if(hit).alias("n_correct"), F.count(F.lit(1)).alias("n_rows"),
                  F.avg(F.when(hit, 1.0).otherwise(0.0)).alias("accuracy"))


def correct_rows(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.filter(F.col(label) == F.col(prediction))


def summarise(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Smallest, mean and largest value per group, as for run times per core count."""
    v = F.col(value)
    return df.groupBy(*group).agg(F.count(v).alias("n"), F.min(v).alias("min_value"),
                                  F.avg(v).alias("avg_value"), F.max(v).alias("max_value"))


def domain(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("first"), F.max(column).alias("last"))
