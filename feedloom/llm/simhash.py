"""SimHash near-duplicates by multi-index hashing.

Fingerprints are made once per document; from then on the work is on distinct fingerprints. A
fingerprint of 64 bits has two segments of 32. Two that differ in at most three bits differ in at
most one bit of one segment, so the Hamming ball of radius one about each segment meets the
other's segment in the table. Of two that differ in a bit the one that lacks it enumerates the
flip, which halves the ball; complete distances are verified on the matches.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.components import components
from feedloom.llm.text import spare
from feedloom.session import cut_lineage

WIDTH, SEED, RADIUS = 3, 42, 3
HALF = 32


def fingerprint(text: str | None, width: int = WIDTH, seed: int = SEED) -> int:
    """SimHash of the shingles of a text; a bit is set if it is in over half of the hashes."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    if len(words) <= width:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[k:] for k in range(width))))
    ones = np.zeros(64, np.int64)
    n, chunk = 0, []
    for g in grams:
        chunk.append(xxh64_intdigest(g, seed))
        if len(chunk) == 1 << 16:
            ones += _ones(chunk)
            n, chunk = n + len(chunk), []
    if chunk:
        ones += _ones(chunk)
    bits = (2 * ones > n + len(chunk)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _ones(hashes: list[int]) -> np.ndarray:
    data = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(data, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def _prints(text_at: int, width: int, seed: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for k in range(0, batch.num_rows, 256):
                found += [fingerprint(t, width, seed)
                          for t in batch.column(text_at).slice(k, 256).to_pylist()]
            fp = pa.array(np.array(found, "<u8").view("<i8"))
            keep = [c for i, c in enumerate(batch.columns) if i != text_at]
            names = [n for i, n in enumerate(batch.schema.names) if i != text_at]
            yield pa.RecordBatch.from_arrays([*keep, fp], names=[*names, "fp"])
    return run


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """``doc_id, fp`` for every row; a null or empty text has fingerprint zero."""
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(_prints(1, width, seed), "doc_id long, fp long")


def _segment(fp: Column, which: int) -> Column:
    return (F.shiftrightunsigned(fp, HALF) if which else fp).bitwiseAND((1 << HALF) - 1)


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs ``a, b`` of distinct fingerprints ``fp`` that differ in at most ``radius`` (three or
    fewer) bits; a pair may occur twice."""
    if not 0 <= radius <= 3:
        raise ValueError("two segments serve a radius of at most three")
    masks = F.array(*(F.lit(1 << i).cast("long") for i in range(HALF)))
    table, probes = [], []
    for which in (0, 1):
        own, w = _segment(F.col("fp"), which), F.lit(which).cast("byte").alias("w")
        ball = F.concat(F.array(own), F.transform(
            F.filter(masks, lambda m: own.bitwiseAND(m) == 0), lambda m: own + m))
        table.append(prints.select(F.col("fp").alias("b"), w, own.alias("seg")))
        probes.append(prints.select(F.col("fp").alias("a"), w, F.explode(ball).alias("seg")))
    # Spark sizes exploded rows as those they come from, so a table just small enough would have the
    # probes, some 35 a fingerprint, broadcast through the driver.
    met = probes[0].unionAll(probes[1]).hint("merge").join(table[0].unionAll(table[1]), ["w", "seg"])
    differ = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return met.filter((differ <= radius) & (differ > 0)).select("a", "b")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
            seed: int = SEED, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fp, component_id`` for every row: the smallest id reachable over links.

    Fingerprints, not documents, are linked, so a group of equal ones is one node however large.
    Null and empty texts share fingerprint zero. Rows that repeat an id are rows of their own; a
    null id never names a component unless its component holds no other. Other columns are
    ignored; an empty table gives no rows.
    """
    prints = cut_lineage(fingerprints(docs, doc_id, text, width, seed))
    nodes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(nodes.select("fp"), radius))
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = cut_lineage(named.join(least, "root").select("fp", "component_id"))
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, that of the smallest id, with its columns.

    Rows that repeat the id stay together; rows without an id stay.
    """
    later = classes(docs, doc_id, text).filter("doc_id > component_id")
    name = spare(docs, "later")
    later = cut_lineage(later.select(F.col("doc_id").alias(name)).distinct())
    return docs.join(later, F.col(doc_id) == F.col(name), "left_anti")
