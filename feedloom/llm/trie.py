"""Prefix trie of conversations, from whole sequences collapsed first.

Identical conversations become one weighted sequence with the list of those that end there;
sequences that are a proper prefix of another are no leaves (an anti-join finds the others); the
weighted prefixes of the distinct sequences are then aggregated to nodes. A node is named by its
depth and 128 bits: the exclusive or of its turns' digests, each taken together with its place,
so prefixes of a conversation of any length are running sums and no conversation has to meet in
one row. Long conversations are numbered and summed in runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import cut_lineage

# Turns of a conversation that are summed in one go, ids in a row of an end list.
RUN, ENDS = 1024, 4096
KEY = ("depth", "k1", "k2")


def _halves(data: Column) -> list[Column]:
    """The MD5 digest of text as two signed 64-bit numbers."""
    digest = F.md5(data)
    return [F.conv(F.substring(digest, at, 16), 16, -10).cast("long") for at in (1, 17)]


def number_turns(rows: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, pos, role, text``: turns numbered from 0 in each conversation.

    Order is by turn, null first; turns that tie go by the digest of role and text. Null roles
    and texts are empty; repeated rows are turns of their own. Rows without a conversation belong
    to none and are left out. Other columns are not read. Rows are sorted by range, so
    a conversation of any number of turns is dealt over tasks.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    own = rows.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
                      role.alias("role"), text.alias("text"),
                      F.monotonically_increasing_id().alias("row")).filter("conv_id IS NOT NULL")
    own = own.withColumn("tie", F.md5(F.concat_ws(":", F.length("role"), "role", "text")))
    order = ["conv_id", "turn", "tie", "row"]
    dealt = own.repartitionByRange(*order).sortWithinPartitions(*order)
    # The number of a row in its task, then in the conversation: runs of tasks are counted.
    dealt = cut_lineage(dealt.select("conv_id", "role", "text", F.spark_partition_id().alias("task"),
                                     F.monotonically_increasing_id().alias("at")))
    runs = dealt.groupBy("conv_id", "task").agg(F.min("at").alias("first"),
                                                F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return dealt.join(runs, ["conv_id", "task"]).select(
        "conv_id", (F.col("at") - F.col("first") + F.col("before")).alias("pos"), "role", "text")


def share_heads(turns: DataFrame, *, group: int = 5, longest: int = 9) -> DataFrame:
    """Conversations rebuilt so that neighbours share their first turns.

    Conversation c takes the first h turns of conversation c - c % ``group`` and goes on with its
    own after the first h; h is the CRC-32 of c's decimal digits modulo ``longest``. What is not
    there is left out. ``conv_id, pos`` number the turns anew; a conversation that is left
    without turns has one row with null ``pos``. % keeps the sign of c.
    """
    c = F.col("conv_id")
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("turns")).select(
        c, (c - c % group).alias("base"), F.pmod(F.crc32(c.cast("string").cast("binary")),
                                                 F.lit(longest)).alias("h"))
    heads = turns.filter(F.col("pos") < longest - 1).select(
        F.col("conv_id").alias("base"), "pos", "role", "text")
    lent = convs.join(heads, "base").filter("pos < h").select("conv_id", "pos", "role", "text")
    sizes = heads.groupBy("base").agg(F.max("pos").alias("last"))
    shift = convs.join(sizes, "base", "left").select(
        "conv_id", "h", F.least("h", F.coalesce(F.col("last") + 1, F.lit(0))).alias("lent"))
    own = turns.join(shift, "conv_id").filter("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("lent")).alias("pos"), "role", "text")
    every = lent.unionAll(own)
    bare = convs.join(every.select("conv_id").distinct(), "conv_id", "left_anti").select(
        "conv_id", F.lit(None).cast("long").alias("pos"), F.lit("").alias("role"),
        F.lit("").alias("text"))
    return every.unionAll(bare)


def _prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, k1, k2, p1, p2, size``: each prefix, its node, the node above."""
    place = F.concat_ws(":", "pos", F.length("role"), "role", "text")
    own = turns.filter("pos IS NOT NULL").select(
        "conv_id", "pos", *[h.alias(f"t{i}") for i, h in enumerate(_halves(place), 1)],
        F.octet_length("text").cast("long").alias("size"),
        F.floor(F.col("pos") / RUN).alias("run"))
    own = cut_lineage(own)
    inside = Window.partitionBy("conv_id", "run").orderBy("pos")
    sums = own.groupBy("conv_id", "run").agg(*[F.bit_xor(f"t{i}").alias(f"r{i}") for i in (1, 2)])
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(
        Window.unboundedPreceding, -1)
    sums = sums.select("conv_id", "run", *[F.coalesce(F.bit_xor(f"r{i}").over(before), F.lit(0))
                                           .alias(f"b{i}") for i in (1, 2)])
    run = own.select("*", *[F.bit_xor(f"t{i}").over(inside).alias(f"x{i}") for i in (1, 2)])
    keys = [F.col(f"x{i}").bitwiseXOR(F.col(f"b{i}")) for i in (1, 2)]
    return run.join(sums, ["conv_id", "run"]).select(
        "conv_id", (F.col("pos") + 1).alias("depth"),
        *[k.alias(f"k{i}") for i, k in enumerate(keys, 1)],
        *[k.bitwiseXOR(F.col(f"t{i}")).alias(f"p{i}") for i, k in enumerate(keys, 1)], "size")


def _root(*columns: Column) -> list[Column]:
    return [F.lit(0).cast("long").alias(c) for c in KEY] + list(columns)


def collapse(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Prefixes, sequences and members of ``conv_id, pos, role, text``.

    Sequences are ``depth, k1, k2, conv_id`` (the smallest), ``weight``; members name their
    sequence. A conversation without turns is a member of the empty sequence.
    """
    prefixes = cut_lineage(_prefixes(turns))
    ends = prefixes.groupBy("conv_id").agg(F.max("depth").alias("depth"))
    full = prefixes.join(ends, ["conv_id", "depth"], "left_semi").select("conv_id", *KEY)
    bare = turns.filter("pos IS NULL").select("conv_id", *_root())
    members = cut_lineage(full.unionAll(bare))
    sequences = cut_lineage(members.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("weight")))
    return prefixes, sequences, members


def build(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of the trie of ``conv_id, pos, role, text``, and the end lists of the nodes.

    Nodes: the key ``depth, k1, k2``, ``conv_id`` (smallest member), ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved`` (bytes of the last texts that members
    after the first repeat, over the subtree). The root is there if any conversation is; its
    parent is null. ``pos`` runs from 0 in each conversation, null in the one row of one
    without turns. Nothing in, no node out.

    End lists: the key, ``first`` and ``ids``, rows of at most ``ENDS`` ascending ids each.
    A text is told by its digest; any column may be as long as it likes.
    """
    prefixes, sequences, members = collapse(turns)
    # Weighted prefixes of the distinct sequences, the root among them.
    weights = sequences.select("conv_id", "weight", F.col("depth").alias("end"))
    paths = prefixes.join(weights, "conv_id").unionAll(sequences.select(
        "conv_id", *_root(*[F.lit(None).cast("long").alias(c) for c in ("p1", "p2")],
                          F.lit(0).cast("long").alias("size")), "weight", F.col("depth").alias("end")))
    paths = cut_lineage(paths)
    inner = paths.filter("depth < end").select(*KEY).distinct()
    leaves = sequences.join(inner, list(KEY), "left_anti").select(
        "conv_id", F.lit(1).alias("leaf"))
    nodes = cut_lineage(paths.join(leaves, "conv_id", "left").groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"),
        F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"), F.max("size").alias("size"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2")))
    saved = _saved(paths, nodes)
    above = nodes.select(*[F.col(c).alias(f"up_{c}") for c in KEY],
                         F.col("conv_id").alias("parent_conv_id"))
    to_parent = ((F.col("depth") - 1 == F.col("up_depth")) & (F.col("p1") == F.col("up_k1"))
                 & (F.col("p2") == F.col("up_k2")))
    below = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"),
                                              F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count("*").alias("n_children"))
    out = (nodes.join(above, to_parent, "left").join(below, list(KEY), "left")
           .join(saved, list(KEY), "left"))
    return out.select(*KEY, "conv_id", "parent_conv_id", "n_convs",
                      F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves",
                      F.coalesce("saved", F.lit(0)).alias("saved")), _end_lists(members)


def _saved(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """Sum of each subtree's ``(n_convs - 1) * size``, by key.

    A node belongs to its smallest member, so each counts on one path only; what a path's nodes
    from some depth on save is a sum from the end, taken in runs.
    """
    gain = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("size")).alias("gain"))
    own = paths.join(gain, ["conv_id", "depth"], "left").select(
        "conv_id", *KEY, F.coalesce("gain", F.lit(0)).alias("gain"),
        F.floor(F.col("depth") / RUN).alias("run"))
    own = cut_lineage(own)
    later = Window.partitionBy("conv_id").orderBy(F.desc("run")).rowsBetween(
        Window.unboundedPreceding, -1)
    runs = own.groupBy("conv_id", "run").agg(F.sum("gain").alias("gain"))
    runs = runs.select("conv_id", "run", F.coalesce(F.sum("gain").over(later), F.lit(0)).alias("more"))
    rest = Window.partitionBy("conv_id", "run").orderBy(F.desc("depth"))
    own = own.withColumn("from", F.sum("gain").over(rest)).join(runs, ["conv_id", "run"])
    return own.groupBy(*KEY).agg(F.sum(F.col("from") + F.col("more")).alias("saved"))


def _gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of at most ENDS ids of one node, from rows sorted by node and id."""
    held, out = None, []

    def rows(done):
        key, first, ids = zip(*done)
        cols = [pa.array([k[i] for k in key], pa.int64()) for i in range(3)]
        return pa.RecordBatch.from_arrays(
            [*cols, pa.array(first, pa.int64()), pa.array(ids, pa.list_(pa.int64()))],
            names=[*KEY, "first", "ids"])

    for batch in batches:
        *key, ids = (c.to_pylist() for c in batch.columns)
        for k, i in zip(zip(*key), ids):
            if held is None or held[0] != k or len(held[2]) >= ENDS:
                if held is not None:
                    out.append(held)
                held = (k, i, [])
            held[2].append(i)
        if out:
            yield rows(out)
            out = []
    if held is not None:
        yield rows([held])


def _end_lists(members: DataFrame) -> DataFrame:
    order = [*KEY, "conv_id"]
    dealt = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.mapInArrow(_gather, "depth long, k1 long, k2 long, first long, ids array<long>")


def _hash_lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for batch in batches:
        out = []
        *key, ids = (batch.column(i).to_pylist() for i in (0, 1, 2, 4))
        for k, own in zip(zip(*key), ids):
            if held is None or held[0] != k:
                if held is not None:
                    out.append((*held[0], held[1].hexdigest()))
                held = (k, hashlib.sha256())
            else:
                held[1].update(b",")
            held[1].update(",".join(map(str, own)).encode())
        if out:
            yield pa.RecordBatch.from_pydict(dict(zip([*KEY, "sha256"], map(list, zip(*out)))))
    if held is not None:
        yield pa.RecordBatch.from_pydict(
            {c: [v] for c, v in zip([*KEY, "sha256"], (*held[0], held[1].hexdigest()))})


def hash_ends(ends: DataFrame) -> DataFrame:
    """SHA-256 of each node's ascending ids, comma-joined; the lists stream through the hash.

    A hash runs from its first byte to its last, so one node's lists pass one task, a row of
    many ids at a time; they are never held together.
    """
    dealt = ends.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return dealt.mapInArrow(_hash_lists, "depth long, k1 long, k2 long, sha256 string")
