"""What each filter of a chain removes, in every order, from the potential of a removal game.

A filter is a failure condition. The game of a set of documents gives a coalition of filters the
number of documents that fail at least one of them. Filters only remove, so what any order
removes at any step is a difference of two coalitions, and the whole audit follows from
the documents' counts by the filters they fail: at most ``2 ** filters`` numbers per part.

The potential of Hart and Mas-Colell gives shares that do not depend on an order: P of nothing is
0, and P(S) = (v(S) + sum over i in S of P(S without i)) / |S|. The Shapley value of a filter is
P(all) - P(all without it). All numbers here are whole: potentials are kept times
lcm(1..filters).
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.text import let, words
from feedloom.session import cut_lineage

FILTERS = "ABCDE"
GAMES = ("n", "good", "toxic")


def conditions(text: Column) -> list[Column]:
    """A: under 200 words; B: under half of the words distinct; C: over 2 % capitals; D: symbols.

    Words are runs between ASCII white space, capitals are A to Z, null counts as empty.
    """
    whole = F.coalesce(text, F.lit(""))
    size = let(words(whole), lambda w: F.struct(
        F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("own")))
    capitals = F.length(F.regexp_replace(whole, "[^A-Z]+", ""))
    return [size["n"] < 200, 100 * size["own"] < 50 * size["n"],
            100 * capitals > 2 * F.length(whole), whole.rlike(r"[#$%&*|]")]


def _bits(conditions: list[Column]) -> Column:
    bits = [F.when(c, F.lit(1 << i)).otherwise(0) for i, c in enumerate(conditions)]
    out = bits[0]
    for b in bits[1:]:
        out = out + b
    return out


def failures(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
             part: str = "source") -> DataFrame:
    """``part, mask, good, toxic, n``: documents by the filters they fail (bit i for letter i).

    The fifth filter fails a row whose text some row with a smaller id holds, whatever becomes of
    that row. Texts are compared by 128-bit digests and lengths. Null texts are empty, null parts
    are the empty string. A row without an id has no smaller one and is none, and has no label;
    rows that repeat an id are rows of their own, copies or not. A document is good (toxic) if
    any of its labels has quality 1 (toxic 1). Other columns are not read.

    The text is read once; a row of numbers per document then meets the labels. Copies are
    counted before they meet, so that a text held by very many documents is a few rows.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    facts = docs.select(
        F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"),
        _bits(conditions(F.col(text))).alias("mask"),
        F.struct(F.length(whole).alias("n"), F.unhex(F.md5(whole)).alias("md5")).alias("text"))
    # Rows without an id are spread; no label has a number other than 0.
    deal = F.when(F.col("id").isNull(), F.pmod(F.hash("text", "part"), F.lit(997))).otherwise(0)
    said = labels.groupBy(F.col("doc_id").cast("long").alias("id"), F.lit(0).alias("deal")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    rows = facts.withColumn("deal", deal).join(said, ["id", "deal"], "left").select(
        "id", "part", "mask", "text", *[F.coalesce(c, F.lit(False)).alias(c)
                                        for c in ("good", "toxic")])
    own = ["text", "part", "mask", "good", "toxic"]
    held = rows.groupBy(*own, "id").agg(F.count("*").alias("n"))
    none = F.col("id").isNull()
    told = cut_lineage(held.groupBy(*own).agg(
        F.sum("n").alias("n"), F.sum(F.when(none, F.col("n")).otherwise(0)).alias("none"),
        F.min("id").alias("first"), F.min_by("n", "id").alias("at")))
    least = told.groupBy("text").agg(F.min("first").alias("least"))
    met = told.join(least, "text")
    first = F.when(F.col("first") == F.col("least"), F.col("at")).otherwise(0) + F.col("none")
    kinds = F.array(F.struct(F.col("mask").alias("mask"), first.alias("n")),
                    F.struct((F.col("mask") + (1 << len(FILTERS) - 1)).alias("mask"), (F.col("n") - first).alias("n")))
    return met.select("part", "good", "toxic", F.inline(kinds)).groupBy(
        "part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def games(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Per part, what each coalition removes: arrays ``n, good, toxic`` by coalition, and totals."""
    own = {"n": F.col("n"), "good": F.when(F.col("good"), F.col("n")).otherwise(0),
           "toxic": F.when(F.col("toxic"), F.col("n")).otherwise(0)}
    sides = []
    for name, count in own.items():
        sides.append(F.array(*[
            F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, count).otherwise(0)).cast("long")
            for s in range(1 << len(filters))]).alias(name))
    return masks.groupBy("part").agg(*sides, F.sum("n").alias("total"))


def potentials(v: np.ndarray) -> np.ndarray:
    """Potential of every coalition times lcm(1..filters); ``v`` is parts by coalitions."""
    filters = v.shape[1].bit_length() - 1
    unit = math.lcm(*range(1, filters + 1))
    p = np.zeros_like(v)
    for s in range(1, v.shape[1]):
        own = [i for i in range(filters) if s >> i & 1]
        p[:, s] = (unit * v[:, s] + sum(p[:, s ^ (1 << i)] for i in own)) // len(own)
    return p


def _auditor(filters: str):
    orders = list(permutations(range(len(filters))))
    n, everyone = len(filters), (1 << len(filters)) - 1
    own = np.array([i for o in orders for i in o])
    before = np.array([sum(1 << i for i in o[:k]) for o in orders for k in range(n)])
    after = before | 1 << own
    names = pa.array(["".join(filters[i] for i in o) for o in orders for _ in range(n)])
    steps = pa.array(list(range(1, n + 1)) * len(orders), pa.int32())
    whole = math.factorial(n) // math.lcm(*range(1, n + 1))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 16):
                part, *sides, total = batch.slice(lo, 16).columns
                rows = len(part)
                v, good, toxic = (np.array(x.to_pylist(), np.int64) for x in sides)
                p = potentials(v)
                share = whole * (p[:, [everyone]] - p[:, everyone ^ 1 << np.arange(n)])
                removed = v[:, after] - v[:, before]
                alone = v[:, [everyone]] - v[:, everyone ^ 1 << own]
                table = {"kept": total.to_numpy()[:, None] - v[:, after], "removed": removed,
                         "redundant": v[:, 1 << own] - removed, "unique_fails": alone,
                         "good_lost": good[:, after] - good[:, before],
                         "toxic_lost": toxic[:, after] - toxic[:, before],
                         "shapley": share[:, own]}
                yield pa.RecordBatch.from_pydict({
                    "part": part.take(pa.array(np.repeat(np.arange(rows), len(own)))),
                    "filter_order": pa.concat_arrays([names] * rows),
                    "step": pa.concat_arrays([steps] * rows),
                    **{k: pa.array(x.ravel()) for k, x in table.items()}})
    return run


def audit(played: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from :func:`games`.

    ``kept`` after the step, ``removed`` by it, ``redundant``: fail its filter but were gone,
    ``unique_fails``: fail only it, ``good_lost`` and ``toxic_lost`` of the removed, ``shapley``:
    what its filter removes summed over all orders. No parts, no rows.
    """
    counts = ", ".join(f"{c} long" for c in ("kept", "removed", "redundant", "unique_fails",
                                             "good_lost", "toxic_lost", "shapley"))
    return played.select("part", *GAMES, "total").mapInArrow(
        _auditor(filters), f"part string, filter_order string, step int, {counts}")
