"""Shards of nearly equal bytes by histogram sort.

Documents are ordered by (hash of the text, id), so equal texts lie together. Candidate
boundaries are probed: one pass counts the exact bytes below every probe across all partitions,
and the probes are refined between their neighbours until each splitter meets the tolerance. Then
the documents are exchanged once. A shard is dealt over as many parts as its bytes ask for, by a
hash of the row, so neither a large shard nor a large group of copies meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import cut_lineage

SHARDS = 16
TOLERANCE = 0.002
# Bytes of one part of a shard, the unit that one task sorts.
PART_BYTES = 64 << 20
MIN_PARTS = 4
RESULT = ("size", "text_crc32", "slot", "shard")
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, key``: the order's first key and what a row weighs."""
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"), F.xxhash64(F.col(text)).alias("key"))


def _below(rows: DataFrame, probes: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Exact bytes and rows below each probe (key, id), counted in one pass.

    Rows are first added up by the gap between two probes that they fall into, in each
    partition, so what moves is a row per gap and task.
    """
    gap = shard_of(F.col("key"), F.col("doc_id"), probes)
    counted = rows.groupBy(gap.alias("gap")).agg(F.sum("size"), F.count("*")).collect()
    sums = {g: (size, n) for g, size, n in counted}
    out, size, n = [], 0, 0
    for g in range(len(probes)):
        more = sums.get(g, (0, 0))
        size, n = size + more[0], n + more[1]
        out.append((size, n))
    return out


def splitters(rows: DataFrame, shards: int = SHARDS,
              tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """Boundaries (key, id) between shards; shard s holds the rows from boundary s - 1 on.

    A boundary between two texts is taken once it is within ``tolerance`` of a shard's bytes.
    Where a single text's copies are wider than that, the boundary is refined among their ids.
    Rows that repeat both text and id cannot be told apart and stay together.
    """
    total, n, least, most = rows.agg(
        F.sum("size"), F.count("*"), F.min("doc_id"), F.max("doc_id")).first()
    if not n:
        return [(HIGH, HIGH)] * (shards - 1)
    ids = (least or 0, most or 0)
    wants = [total * s // shards for s in range(1, shards)]
    slack = tolerance * total / shards
    # Per wanted sum the closest counted boundaries: (key, id, bytes below, rows below).
    lo = {w: (LOW, LOW, 0, 0) for w in wants}
    hi = {w: (HIGH, HIGH, total, n) for w in wants}
    found: dict[int, tuple[int, int]] = {}
    while len(found) < len(lo):
        asked = set()
        for w in lo.keys() - found.keys():
            near = min(lo[w], hi[w], key=lambda x: abs(x[2] - w))
            between = [] if hi[w][3] - lo[w][3] <= 1 else _between(lo[w], hi[w], w, ids)
            if abs(near[2] - w) <= slack or not between:
                found[w] = near[:2]
            else:
                asked.update(between)
        probes = sorted(asked)
        for probe, (size, count) in zip(probes, _below(rows, probes) if probes else []):
            for w in lo.keys() - found.keys():
                if size <= w and probe > lo[w][:2]:
                    lo[w] = (*probe, size, count)
                elif size > w and probe < hi[w][:2]:
                    hi[w] = (*probe, size, count)
    return [found[w] for w in wants]


def _between(lo, hi, want: int, ids: tuple[int, int]) -> list[tuple[int, int]]:
    """Probes between two counted boundaries: the middle, and two about the expected place."""
    def inside(a: int, b: int) -> set[int]:
        guess = a + (b - a) * (want - lo[2]) // max(1, hi[2] - lo[2])
        reach = (b - a) // 50 + 1
        return {x for x in ((a + b) // 2, guess - reach, guess + reach) if a < x < b}

    if hi[0] - lo[0] > 1:
        return [(k, LOW) for k in inside(lo[0], hi[0])]
    # One text's copies lie across the boundary: go on among their ids.
    first = max(lo[1], ids[0] - 1)
    last = min(hi[1], ids[1] + 1) if hi[0] == lo[0] else ids[1] + 1
    return [(lo[0], i) for i in inside(first, last)]


def shard_of(key: Column, doc_id: Column, bounds: list[tuple[int, int]]) -> Column:
    """Boundaries at or below a row."""
    if not bounds:
        return F.lit(0)
    edges = F.array(*(F.struct(F.lit(k).cast("long"), F.lit(i).cast("long")) for k, i in bounds))
    row = F.struct(key, F.coalesce(doc_id, F.lit(LOW)))
    return F.size(F.filter(edges, lambda e: e <= row))


def _placed(own: DataFrame, narrow: DataFrame, bounds, part_bytes: int) -> DataFrame:
    """``own`` with ``shard`` and ``slot``, the place in the shard, gapless from 0.

    Parts of a shard follow one another; inside a part the order is that of key and id.
    """
    total = narrow.agg(F.sum("size")).first()[0] or 0
    parts = max(MIN_PARTS, -(-total // ((len(bounds) + 1) * part_bytes)))

    def place(df: DataFrame) -> DataFrame:
        return df.withColumns({
            "shard": shard_of(F.col("key"), F.col("doc_id"), bounds),
            "part": F.pmod(F.xxhash64("key", "doc_id"), F.lit(parts))})

    before = Window.partitionBy("shard").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = cut_lineage(place(narrow).groupBy("shard", "part").count().select(
        "shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first")))
    in_part = Window.partitionBy("shard", "part").orderBy("key", "doc_id")
    own = place(own).withColumn("at", F.row_number().over(in_part) - 1)
    return own.join(starts, ["shard", "part"]).withColumn(
        "slot", (F.col("first") + F.col("at")).cast("long")).drop("first", "at", "part", "key")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, doc_id: str = "doc_id",
                 text: str = "text", tolerance: float = TOLERANCE,
                 part_bytes: int = PART_BYTES) -> DataFrame:
    """Write ``docs`` to one folder per shard below ``path`` and return the rows as read back.

    The files hold the documents' columns with ``size``, ``text_crc32``, ``shard`` and ``slot``;
    only columns of these names are replaced. Null texts weigh one byte; null ids sort first.
    Repeated rows are kept, one slot each. An empty table gives no rows.
    """
    narrow = cut_lineage(keyed(docs, doc_id, text))
    bounds = splitters(narrow, shards, tolerance)
    # Under numbered names no column of the caller meets a working name.
    held = {c: "doc_id" if c == doc_id else f"_c{i}" for i, c in enumerate(docs.columns)
            if c.lower() not in RESULT}
    own = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in held.items()])
    whole = F.col(held[text])
    data = F.coalesce(whole, F.lit("")).cast("binary")
    own = own.withColumns({"size": (F.octet_length(data) + 1).cast("long"),
                           "text_crc32": F.crc32(data), "key": F.xxhash64(whole)})
    placed = _placed(own, narrow, bounds, part_bytes).select(
        *[F.col(n).alias(c) for c, n in held.items()], *RESULT)
    placed.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(placed.schema).parquet(path)
