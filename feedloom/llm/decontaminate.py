"""Benchmark decontamination: MinHash containment search, then exact shingle containment.

A short item inside a long document has a tiny Jaccard similarity, so the search works on
containment. Items are partitioned by the number of their shingles. In the partition of up to
u shingles each item is sketched by its smallest hashes, as many as a document that holds the
wanted share of u shingles cannot all miss; a document is a candidate of an item if one of its
shingles hashes into the item's sketch and it has enough shingles to hold the share. By the
pigeonhole principle no match is missed, which banded signatures would need thousands of bands
for. Candidates are then verified on the shingles themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.text import gram_hashes, let, plain_words, spare
from feedloom.session import cut_lineage

WIDTH, SHARE = 5, 0.8


def _hashes(text: Column, width: int) -> Column:
    """Distinct shingle hashes of a text, in no order."""
    return let(plain_words(text), lambda w: F.array_distinct(gram_hashes(w, F.size(w), width)))


def _shingles(text: Column, width: int) -> Column:
    """Distinct shingles of a text as strings."""
    def runs(w: Column) -> Column:
        n = F.size(w)
        one = lambda i: F.array_join(F.slice(w, i, width), " ")
        return F.when(n >= width, F.array_distinct(F.transform(
            F.sequence(F.lit(1), n - (width - 1)), one))).otherwise(
            F.array().cast("array<string>"))
    return let(plain_words(text), runs)


def _need(n: Column, share: float) -> Column:
    """Shingles of ``n`` that make up the share."""
    return F.ceil(F.lit(share) * n - 1e-9).cast("int")


def sketches(items: DataFrame, item_id: str = "item_id", text: str = "text",
             share: float = SHARE, width: int = WIDTH) -> DataFrame:
    """Rows ``item_id, need, h``: the hashes of each item's sketch."""
    own = items.select(F.col(item_id).alias("item_id"), _hashes(F.col(text), width).alias("hs"))
    own = own.withColumn("n", F.size("hs")).filter(F.col("n") > 0)
    # Partition k holds the items of 2^k to 2^(k+1) - 1 shingles.
    most = F.pow(F.lit(2), F.floor(F.log2("n")) + 1).cast("int") - 1
    length = most - _need(most, share) + 1
    return own.select("item_id", _need(F.col("n"), share).alias("need"), F.explode(
        F.slice(F.sort_array("hs"), F.lit(1), length)).alias("h"))


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id",
                 item_id: str = "item_id", text: str = "text", share: float = SHARE,
                 width: int = WIDTH) -> DataFrame:
    """Pairs ``doc_id, item_id, n_shared, n_shingles``: documents that hold at least ``share``
    of an item's distinct shingles of ``width`` lower-cased words.

    Null and empty texts and items shorter than a shingle match nothing; repeated items match
    under each id, and rows that repeat a document id count by the best of them. Other columns
    are ignored. Rows without an id cannot be named and are left out.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    docs = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    items = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    items = cut_lineage(items.filter(F.col("item_id").isNotNull()))
    sketch = cut_lineage(sketches(items, share=share, width=width))
    hashed = docs.select("doc_id", _hashes(F.col("text"), width).alias("hs"))
    probes = hashed.select("doc_id", F.size("hs").alias("n"), F.explode("hs").alias("h"))
    near = probes.join(sketch, "h").filter(F.col("n") >= F.col("need"))
    # One row per document, so that its text is verified where it is read.
    candidates = cut_lineage(near.groupBy("doc_id").agg(
        F.collect_set("item_id").alias("items")))
    exact = items.select("item_id", _shingles(F.col("text"), width).alias("theirs"))
    pairs = docs.join(candidates, "doc_id").select(
        "doc_id", _shingles(F.col("text"), width).alias("own"),
        F.explode("items").alias("item_id")).join(exact, "item_id")
    found = pairs.select("doc_id", "item_id", F.size("theirs").alias("n_shingles"),
                         F.size(F.array_intersect("theirs", "own")).alias("n_shared"))
    found = found.filter(F.col("n_shared") >= _need(F.col("n_shingles"), share))
    return found.groupBy("doc_id", "item_id").agg(
        F.max("n_shared").alias("n_shared"), F.max("n_shingles").alias("n_shingles"))


def clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
          **how) -> DataFrame:
    """``docs`` without the contaminated ones; a row's own text decides, whatever its id."""
    key, name = spare(docs, "key"), spare(docs, "leak")
    # A struct is never null, and equals another where both ids are missing.
    keyed = docs.withColumn(key, F.struct(F.col(doc_id).alias("id"),
                                          F.xxhash64(text).alias("hash")))
    leaks = contaminated(keyed, items, key, text=text, **how).select(
        F.col("doc_id").alias(name)).distinct()
    return keyed.join(cut_lineage(leaks), F.col(key) == F.col(name), "left_anti").drop(key)
