"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

A source's documents are dealt by a seeded hash to shards; inside a (source, shard) cell they
form one stream of words in seeded order, cut into blocks of nearly equal length. Sources win
blocks by the highest quotients of their targets, a source's blocks go to its shards the same
way, and each cell takes its integer quota of blocks from a seeded start. Only tables with a row
per source or cell meet in one task; documents are sorted by cell, and a hot source has as many
cells as there are shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.text import let, words
from feedloom.session import cut_lineage

WEIGHTS = (5, 2, 1)
BLOCK = 64
SHARDS = 64
# A shard holds about so many words at most; larger corpora get more shards.
SHARD_WORDS = 1 << 25
SEED = 11


def with_sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``size``, the words of the text (none for null)."""
    return docs.withColumn("size", F.size(words(F.col(text))).cast("long"))


def targets(sizes: DataFrame, source: str = "source", weights=WEIGHTS, share: float = 1.5,
            cap: float = 2.0) -> DataFrame:
    """One row per source: ``source, source_size, target``.

    Sources in code-point order, null last, take the weights in turn. The targets share
    ``share`` times all words by weight; none exceeds ``cap`` times its source, and the excess
    goes to the others by weight. With sources ordered by cap per weight, all of those below
    one level are full and the rest meet at that level.
    """
    per = sizes.groupBy(F.col(source).alias("source")).agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("weight", F.get(F.array(*map(F.lit, weights)), turn % len(weights))
                         .cast("double"))
    per = per.withColumn("most", cap * F.col("source_size"))
    every = Window.partitionBy()
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    per = per.withColumn("level", (share * F.sum("source_size").over(every) - F.coalesce(
        F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("most"),
                  F.struct(F.col("most") / F.col("weight"), F.col("level").alias("level")))
    per = per.withColumn("level", F.min(fits).over(every)["level"])
    return per.select("source", "source_size", F.coalesce(
        F.least("most", F.col("level") * F.col("weight")), "most").alias("target"))


def sainte_lague(parties: DataFrame, party: list[Column], group: list[str], seats: Column,
                 weight: str = "ideal") -> DataFrame:
    """``parties`` with ``quota``: the seats each wins by the highest quotients weight/(2k+1).

    ``seats`` is the number to give within a group. As rounded weights miss it by at most one
    seat per party, only quotients that near each rounding are ranked.
    """
    own = Window.partitionBy(*group)
    rough = parties.withColumn("_near", F.floor(F.col(weight) + 0.5).cast("long"))
    rough = rough.withColumn("_seats", F.coalesce(seats, F.lit(0)).cast("long"))
    rough = rough.withColumn("_off", F.abs(F.sum("_near").over(own) - F.col("_seats")) + 1)
    rough = rough.withColumn("_base", F.greatest(F.col("_near") - F.col("_off"), F.lit(0)))
    rough = rough.withColumn("_left", F.col("_seats") - F.sum("_base").over(own))
    lots = rough.withColumn("_k", F.explode(F.sequence(
        F.col("_base"), F.col("_near") + F.col("_off"))))
    by_quotient = own.orderBy(F.desc(F.col(weight) / (2 * F.col("_k") + 1)), *party, "_k")
    won = lots.withColumn("_won", (F.row_number().over(by_quotient) <= F.col("_left"))
                          & (F.col(weight) > 0))
    keys = [c for c in parties.columns]
    return won.groupBy(*keys).agg((F.first("_base") + F.sum(F.col("_won").cast("long")))
                                  .alias("quota"))


def _shard(doc_id: str, shards: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col(doc_id)), F.lit(shards))


def quotas(sizes: DataFrame, doc_id: str = "doc_id", source: str = "source", weights=WEIGHTS,
           share: float = 1.5, cap: float = 2.0, block: int = BLOCK, seed: int = SEED,
           min_shards: int = SHARDS) -> tuple[DataFrame, int]:
    """Cells with their quotas, and the number of shards.

    Columns: ``source, shard, source_size, target, length, blocks, quota``.
    """
    total = sizes.agg(F.sum("size")).first()[0] or 0
    shards = max(min_shards, -(-total // SHARD_WORDS))
    per = cut_lineage(targets(sizes, source, weights, share, cap))
    cells = sizes.groupBy(F.col(source).alias("s"), _shard(doc_id, shards, seed).alias("shard")) \
        .agg(F.sum("size").alias("length"))
    cells = cells.withColumn("blocks", F.when(F.col("length") > 0, F.greatest(
        F.lit(1), F.round(F.col("length") / block))).otherwise(0).cast("long"))
    cells = cells.join(per, F.col("s").eqNullSafe(F.col("source"))).drop("s")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    cells = cut_lineage(cells.withColumn("ideal", rate * F.col("blocks")))

    parties = cells.groupBy("source").agg(F.sum("ideal").alias("ideal"))
    all_seats = F.round(F.sum("ideal").over(Window.partitionBy()))
    won = sainte_lague(parties, [F.col("source").asc_nulls_last()], [], all_seats)
    won = won.select(F.col("source").alias("s"), F.col("quota").alias("seats"))
    cells = cells.join(won, F.col("s").eqNullSafe(F.col("source"))).drop("s")
    cells = sainte_lague(cells, [F.col("shard")], ["source"], F.col("seats"))
    most = (cap * F.col("blocks")).cast("long")
    return cut_lineage(cells.select(
        "source", "shard", "source_size", "target", "length", "blocks",
        F.least("quota", most).alias("quota"))), shards


def _times(j: Column, quota: Column, blocks: Column, first: Column) -> Column:
    """How often block ``j`` is taken: all blocks alike, and the rest spread evenly."""
    extra = quota % blocks
    return F.floor(quota / blocks).cast("long") + F.when(
        F.pmod(j * extra + first, blocks) < extra, 1).otherwise(0)


def mix(docs: DataFrame, cells: DataFrame, shards: int, doc_id: str = "doc_id",
        source: str = "source", tie: Column | None = None, seed: int = SEED) -> DataFrame:
    """``docs`` (with ``size``) and what the mix takes of each: ``source_size, target, taken,
    spans``; a span is (start, length, times) in words of the document.

    Null sources are a source of their own, null ids share a shard, and a document without words
    takes none. Repeated rows are separate documents. Columns of ``docs`` that bear a name of
    the result, and ``_shard``, ``_at`` and ``_c_...``, are replaced; an empty table gives an
    empty result.
    """
    own = docs.drop("source_size", "target", "taken", "spans",
                    *(f"_c_{c}" for c in cells.columns))
    plan = cells.select(*(F.col(c).alias(f"_c_{c}") for c in cells.columns))
    own = own.withColumn("_shard", _shard(doc_id, shards, seed))
    order = [F.xxhash64(F.lit(seed + 1), F.col(doc_id)), F.col(doc_id), F.col("size")]
    w = Window.partitionBy(source, "_shard").orderBy(*order, *([tie] if tie is not None else []))
    own = own.withColumn("_at", F.coalesce(F.sum("size").over(
        w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    own = own.join(plan, F.col(source).eqNullSafe(F.col("_c_source"))
                   & (F.col("_shard") == F.col("_c_shard")), "left")
    at, size, n, length = (F.col(c) for c in ("_at", "size", "_c_blocks", "_c_length"))
    # Block j holds the words from floor(j * length / n) on.
    block_of = lambda x: F.floor(((x + 1) * n + length - 1) / length).cast("long") - 1
    edge = lambda j: F.floor(j * length / n).cast("long")
    first = F.pmod(F.xxhash64(F.lit(seed), F.col("_c_source"), F.col("_c_shard")), n)

    def span(j: Column) -> Column:
        start = F.greatest(edge(j), at)
        return F.struct((start - at).alias("start"),
                        (F.least(edge(j + 1), at + size) - start).alias("length"),
                        _times(j, F.col("_c_quota"), n, first).alias("times"))

    spans = F.when(size > 0, F.filter(
        F.transform(F.sequence(block_of(at), block_of(at + size - 1)), span),
        lambda s: s.times > 0)).otherwise(F.array().cast(
            "array<struct<start:bigint,length:bigint,times:bigint>>"))
    out = own.withColumn("spans", spans)
    taken = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s.length * s.times)
    return out.withColumns({
        "source_size": F.col("_c_source_size"), "target": F.col("_c_target"), "taken": taken,
    }).drop("_shard", "_at", *plan.columns)


def take(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The mixed documents: a row per pass, whose text holds the words that pass takes.

    A document taken whole keeps its text; else the taken words keep the white space before
    them. There are as many passes as some span is taken. Rows without a taken word, null and empty
    texts among them, go. Columns ``_pass`` and ``_spans`` are replaced.
    """
    piece = r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"
    passes = F.array_max(F.transform("spans", lambda s: s.times.cast("int")))
    own = mixed.withColumn("_pass", F.explode(F.sequence(F.lit(1), passes)))
    own = own.withColumn("_spans", F.filter(
        "spans", lambda s: s.times >= F.col("_pass"))).filter(F.size("_spans") > 0)
    kept = F.aggregate("_spans", F.lit(0).cast("long"), lambda a, s: a + s.length)
    # The pieces are bound, so that not every span cuts the text anew.
    taken = let(F.regexp_extract_all(F.col(text), F.lit(piece), F.lit(1)), lambda p: F.array_join(
        F.flatten(F.transform("_spans", lambda s: F.slice(
            p, (s.start + 1).cast("int"), s.length.cast("int")))), ""))
    cut = F.regexp_replace(taken, r"^[\x20\x09-\x0D]+", "")
    return own.withColumn(text, F.when(kept < F.col("size"), cut).otherwise(F.col(text))) \
        .drop("_pass", "_spans")
