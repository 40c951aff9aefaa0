"""Near copies of word shingles: every pair of texts with a Jaccard similarity of a share or more.

Fingerprints come first: multi-index hashing (:mod:`feedloom.llm.simhash`) finds the pairs within
three bits, which verify cheaply and join most copies. At a similarity of 0.8 about ten bits
differ, in some pairs over twenty, so no radius of 64 bits finds them all; the rest is searched by
prefixes. Two sets with that similarity share a member of their prefixes, whatever order ranks the
members: of n shingles the first ``n - ceil(share * n) + 1``. The order puts shingles that a
sample finds in many texts last, so a common line seldom makes candidates. Where two texts first
meet, the members that follow bound what they can share. So do their parities: a text keeps a bit
or two per shingle, each the parity of the shingles that fall on it, and two texts differ in as
many shingles as parities at least. Texts that may be similar still are verified on all their
shingles (64-bit hashes). No pair is missed.

Linked are the pairs that matter to components. Of texts that share a shingle those go first whose
sizes, places and parities leave them no partner among up to ``WIDE`` others, as texts that share no
more than a common line. A shingle that few texts share gives all their pairs. Where many share one, each text is told against a leading text only: those like it are in its
component. A pair of which one is not like it has either another shingle in common that the lead
lacks, or a text smaller than the lead and as much in common within it as the pair needs. So the
texts meet again, in prefixes of what the lead lacks, and the few that can be of the second kind
among themselves, round by round. What is left is paired in full once that is no more than a few
pairs per text, or after the last round.

Rows are dealt and sorted by their words' digest (128 bits) and id once, and every later look at
a text finds it there. Prefix rows are exchanged once. Hash arrays are never exchanged: of a
candidate pair that parities leave one text goes to the other's place, once, or, where one text
leads many pairs, its hashes are broadcast within a bound.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm import simhash
from feedloom.llm.components import components
from feedloom.llm.text import gram_hashes, let, spare, words
from feedloom.session import cut_by_key, cut_lineage, release, sized_at_run_time

WIDTH, SHARE = 5, 0.8
# Texts sampled for common shingles, common shingles held, texts of a shingle that are paired at
# once, rounds of leading texts, pairs per text below which no round is made, texts of a shingle
# that need no lead, as their pairs grow with the rows only.
SAMPLE, HELD, PAIRED, ROUNDS, FEW, LONG = 4000, 100_000, 8, 4, 2, 64
# Pairs of a text that make it a lead, leads looked at, hashes of leads broadcast at once.
LED, LEADS, BROADCAST = 16, 10_000, 500_000
# Texts of a shingle that are looked through in one task, words of parities compared at once.
WIDE, WORDS = 2048, 1 << 21
PRINT, PAIR, MANY = 0, 1, 2
KEY = ["k1", "k2", "who"]
LOW = (1 << 32) - 1
# MANY: the place in nb; PRINT: the parities in bits
FOUND = "kind byte, h long, a long, na int, b long, nb int, bits array<long>"
# A prefix row of what b lacks of a, with its place; with no h, how much b lacks.
OUTSIDE = "h long, a long, na int, b long, nb int, place int"


def _halves(text: Column) -> list[Column]:
    """Digest of the lower-cased words in two numbers; texts equal in them are one node."""
    digest = F.md5(F.array_join(words(F.lower(text)), " "))
    return [F.conv(F.substring(digest, at, 16), 16, -10).cast("long") for at in (1, 17)]


def _hashes(text: Column, width: int) -> Column:
    return let(words(F.lower(text)),
               lambda w: F.array_distinct(gram_hashes(w, F.size(w), width)))


def _need(n: Column, share: float) -> Column:
    return F.ceil(F.lit(share) * n - 1e-9).cast("int")


def _fingerprint(own: np.ndarray) -> int:
    bits = np.unpackbits(own.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(own), bitorder="little").view("<i8")[0])


def _parities(own: np.ndarray) -> np.ndarray:
    """Parity of the hashes on each of as many bits as the next power of two, 64 at least. Places
    are low bits, so that the halves of a longer one, xored, are the shorter one."""
    width = max(64, 1 << (len(own) - 1).bit_length())
    odd = np.bincount(own.view("<u8") >> np.uint64(20) & np.uint64(width - 1), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _prefixes(common: np.ndarray, times: np.ndarray, share: float):
    """Prefix rows ``h, node, at``, ``at`` holding a set's size and the place in its order; and
    a row with the fingerprint in place of ``h``, the size below zero in ``at`` and the parities."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, at, h, bits, held = [], [], [], [], []
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(batch.column(1).value_lengths().to_numpy(zero_copy_only=False))
            start = 0
            for name, end in zip(batch.column(0).to_numpy(zero_copy_only=False), ends):
                own, start = np.ascontiguousarray(values[start:end]), int(end)
                rank = _ranks(own, common, times)
                first = len(own) - int(np.ceil(share * len(own) - 1e-9)) + 1
                h += [own[np.lexsort((own, rank))[:first]], [_fingerprint(own)]]
                at += [len(own) << 32 | np.arange(first), [-len(own)]]
                node.append(np.full(first + 1, name))
                bits.append(_parities(own))
                held.append(np.append(np.zeros(first, np.int32), len(bits[-1])))
            if h:
                sizes = np.concatenate(held)
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(np.concatenate(x).astype(np.int64)) for x in (h, node, at)],
                     pa.ListArray.from_arrays(
                         pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)),
                         pa.array(np.concatenate(bits)), mask=pa.array(sizes == 0))],
                    names=["h", "node", "at", "bits"])
    return run


def _outside(common: np.ndarray, times: np.ndarray, share: float):
    """Rows of ``OUTSIDE`` for ``a, na, b, nb, out``, ``out`` being the shingles of a that b lacks."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, na, b, nb = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            values = batch.column(4).flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(batch.column(4).value_lengths().to_numpy(zero_copy_only=False))
            start, h, place, pair = 0, [], [], []
            for k, end in enumerate(ends):
                own, start = values[start:end], int(end)
                # Of any text that is like a, at least so much is out of b.
                least = np.ceil(share * na[k] - 1e-9)
                shared = np.ceil(share / (1 + share) * (na[k] + least) - 1e-9) - (na[k] - len(own))
                first = max(0, len(own) - max(1, int(shared)) + 1)
                key = own[np.lexsort((own, _ranks(own, common, times)))[:first]].view(np.uint64)
                h.append((key ^ np.uint64(int(b[k]) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)).view(np.int64))
                place += [np.arange(first), [len(own)]]
                pair.append(np.full(first + 1, k))
            if pair:
                no = np.cumsum([len(x) + 1 for x in h]) - 1
                at = np.zeros(no[-1] + 1, bool)
                at[no] = True
                keys = np.zeros(len(at), np.int64)
                keys[~at] = np.concatenate(h)
                pair = np.concatenate(pair)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, mask=at), *[pa.array(x[pair]) for x in (a, na, b, nb)],
                     pa.array(np.concatenate(place).astype(np.int32))],
                    names=["h", "a", "na", "b", "nb", "place"])
    return run


def _ranks(own: np.ndarray, common: np.ndarray, times: np.ndarray) -> np.ndarray:
    """How many texts of the sample hold a shingle, zero if it is not a common one."""
    if not len(common):
        return own * 0
    where = np.minimum(np.searchsorted(common, own), len(common) - 1)
    return np.where(common[where] == own, times[where], 0)


def _rows(kind: int, h, a, na, b=None, nb=None, bits=None) -> pa.RecordBatch:
    """Rows of ``FOUND``."""
    n = len(h)
    cols = [pa.array(np.full(n, kind, np.int8)), pa.array(h), pa.array(a), pa.array(na, pa.int32())]
    cols += [pa.nulls(n, pa.int64()) if b is None else pa.array(b),
             pa.nulls(n, pa.int32()) if nb is None else pa.array(nb, pa.int32()),
             pa.nulls(n, pa.list_(pa.int64())) if bits is None else bits]
    return pa.RecordBatch.from_arrays(cols, names=["kind", "h", "a", "na", "b", "nb", "bits"])


def _pairer(share: float, paired: int):
    """Rows sorted by ``h, node`` to fingerprints, pairs of shingles that up to ``paired`` texts
    share, and the rows of shingles that more share. A task holds one batch and one short run."""
    def met(h, node, at):
        """Pairs of the short runs, and a mask of the long ones' rows."""
        cut = np.flatnonzero(np.diff(h)) + 1
        run = np.zeros(len(h), np.int64)
        run[cut] = 1
        run = np.cumsum(run)
        long_ = np.bincount(run)[run] > paired if len(h) else np.zeros(0, bool)
        n, place = at >> 32, at & LOW
        out = []
        for gap in range(1, paired):
            i = np.flatnonzero((run[gap:] == run[:-gap]) & ~long_[gap:])
            j = i + gap
            least, most = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
            more = np.minimum(n[i] - place[i], n[j] - place[j])
            both = np.ceil(share / (1 + share) * (n[i] + n[j]) - 1e-9)
            fits = (least >= np.ceil(share * most - 1e-9)) & (more >= both) & (node[i] != node[j])
            i, j = i[fits], j[fits]
            out.append((h[i], node[i], n[i], node[j], n[j]))
        return [np.concatenate(x) for x in zip(*out)], long_

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, long_h = None, None
        for batch in batches:
            h, node, at = (c.to_numpy(zero_copy_only=False) for c in batch.columns[:3])
            prints = at < 0
            if prints.any():
                yield _rows(PRINT, h[prints], node[prints], -at[prints],
                            bits=batch.column(3).filter(pa.array(prints)).cast(pa.list_(pa.int64())))
                h, node, at = h[~prints], node[~prints], at[~prints]
            if long_h is not None and len(h):
                on = int(np.searchsorted(h, long_h, "right"))
                if on:
                    yield _rows(MANY, h[:on], node[:on], at[:on] >> 32, nb=at[:on] & LOW)
                h, node, at = h[on:], node[on:], at[on:]
            if not len(h):
                continue
            long_h = None
            if held is not None:
                h, node, at = (np.concatenate(x) for x in zip(held, (h, node, at)))
            last = int(np.searchsorted(h, h[-1], "left"))
            held = h[last:], node[last:], at[last:]
            if len(held[0]) > paired:
                yield _rows(MANY, held[0], held[1], held[2] >> 32, nb=held[2] & LOW)
                held, long_h = None, h[-1]
            yield from done(h[:last], node[:last], at[:last])
        if held is not None:
            yield from done(*held)

    def done(h, node, at):
        if len(h):
            pairs, many = met(h, node, at)
            if len(pairs[0]):
                yield _rows(PAIR, *pairs)
            if many.any():
                yield _rows(MANY, h[many], node[many], at[many] >> 32, nb=at[many] & LOW)
    return run


def _partners(share: float):
    """Of rows ``h, node, n, place, root, bits`` sorted by ``h`` those that may be like another of
    the same ``h`` and another component. A task holds one batch and one run."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            h = rows["h"].to_numpy()
            last = int(np.searchsorted(h, h[-1], "left"))
            held = rows.slice(last)
            yield from kept(rows.slice(0, last))
        if held is not None:
            yield from kept(held)

    def kept(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if not rows.num_rows:
            return
        rows = rows.combine_chunks()
        h, n, place, root = (rows[c].to_numpy().astype(np.int64) for c in ("h", "n", "place", "root"))
        bits = rows["bits"].chunk(0)
        # Of signed numbers numpy counts the bits of the absolute value.
        words = bits.flatten().to_numpy().view(np.uint64)
        ends = np.cumsum(bits.value_lengths().to_numpy())
        hit = np.zeros(len(h), bool)
        cuts = [0, *(np.flatnonzero(np.diff(h)) + 1), len(h)]
        for a, b in zip(cuts, cuts[1:]):
            hit[a:b] = _may_meet(n[a:b], place[a:b], root[a:b], ends[a:b],
                                 np.diff(ends[a:b], prepend=ends[a - 1] if a else 0), words, share)
        yield from rows.drop_columns("bits").filter(pa.array(hit)).combine_chunks().to_batches()
    return run


def _may_meet(n, place, root, ends, width, words, share: float) -> np.ndarray:
    """Which texts may be like another, by sizes, places, components and parities, whose words
    lie in ``words`` up to ``ends``. Sizes that are near have as many parities or twice as many."""
    hit = np.zeros(len(n), bool)
    for w in np.unique(width):
        one, two = np.flatnonzero(width == w), np.flatnonzero(width == 2 * w)
        own = words[ends[one][:, None] - w + np.arange(w)]
        more = words[ends[two][:, None] - 2 * w + np.arange(2 * w)]
        others, theirs = np.append(one, two), np.concatenate((own, more[:, :w] ^ more[:, w:]))
        step = max(1, WORDS // (len(others) * int(w)))
        for first in range(0, len(one), step):
            i = one[first:first + step, None]
            both = np.ceil(share / (1 + share) * (n[i] + n[others]) - 1e-9)
            fits = (np.minimum(n[i], n[others]) >= np.ceil(share * np.maximum(n[i], n[others]) - 1e-9)) \
                & (np.minimum(n[i] - place[i], (n - place)[others]) >= both) & (root[i] != root[others])
            a, b = np.nonzero(fits)
            differ = np.bitwise_count(own[first + a] ^ theirs[b]).sum(axis=1, dtype=np.int64)
            near = (n[one[first + a]] + n[others[b]] - differ) >= 2 * both[a, b]
            hit[one[first + a[near]]] = hit[others[b[near]]] = True
    return hit


def _common(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several texts of a sample hold, by hash, and how many do."""
    found = sets.select(F.explode("hs").alias("h")).groupBy("h").agg(F.count("*").alias("c"))
    rows = found.filter("c > 2").orderBy(F.desc("c"), "h").limit(HELD).collect()
    rows.sort()
    return np.array([r.h for r in rows], np.int64), np.array([r.c for r in rows], np.int64)


class _Texts:
    """Texts at their places: ``rows`` are dealt by ``key``, ``nodes`` names each node's row."""

    def __init__(self, rows: DataFrame, key: list[str], text: str, nodes: DataFrame, width: int):
        self.rows = rows.select(*[F.col(c).alias(n) for c, n in zip(key, KEY)],
                                F.col(text).alias("text"))
        self.places = nodes.select("node", "k1", "k2", "first.who")
        self.width = width
        self.bits: DataFrame | None = None  # node, bits: parities, once they are known

    def may(self, pairs: DataFrame, share: float) -> DataFrame:
        """The pairs of ``a, na, b, nb`` whose sizes and parities let them be alike."""
        pairs = pairs.filter(F.least("na", "nb") >= _need(F.greatest("na", "nb"), share))
        for x in "ab":
            pairs = pairs.join(self.bits.select(F.col("node").alias(x), F.col("bits").alias(f"bits{x}")), x)
        size = F.least(F.size("bitsa"), F.size("bitsb"))
        one, two = (F.when(F.size(x) == size, F.col(x)).when(F.size(x) == 2 * size, F.zip_with(
            F.slice(x, F.lit(1), size), F.slice(x, size + 1, size), lambda u, v: u.bitwiseXOR(v)))
            for x in ("bitsa", "bitsb"))
        differ = F.aggregate(F.zip_with(one, two, lambda u, v: F.bit_count(u.bitwiseXOR(v))),
                             F.lit(0), lambda n, x: n + x)
        n = F.col("na") + F.col("nb")
        return pairs.filter(n - F.coalesce(differ, F.lit(0)) >= 2 * _need(n / (1 + share), share)) \
            .select("a", "na", "b", "nb")

    def partnered(self, rooted: DataFrame, share: float) -> DataFrame:
        """The rows ``h, node, n, place, root`` of shingles that texts of several components share,
        without those that can be like no other, and how many ``were`` there; a cut. Of a shingle of
        over ``WIDE`` texts all stay."""
        names = ["h", "node", "n", "place", "root", "were"]
        open_ = rooted.groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high"),
                                        F.count("*").alias("were")).filter("low <> high")
        rows = rooted.join(open_.select("h", "were"), "h")
        few = rows.filter(F.col("were") <= WIDE).join(self.bits, "node").select(*names, "bits")
        few = few.repartition("h").sortWithinPartitions("h").mapInArrow(
            _partners(share), "h long, node long, n int, place int, root long, were long")
        return cut_lineage(few.unionAll(rows.filter(F.col("were") > WIDE).select(*names)))

    def at(self, of: DataFrame, node: str = "node") -> DataFrame:
        """The rows of ``of`` with the text of their node; ``of`` moves, texts stay."""
        placed = of.join(self.places.withColumnRenamed("node", node), node)
        return placed.join(self.rows, KEY).drop(*KEY)

    def sets(self, of: DataFrame) -> DataFrame:
        """``node, hs`` of the nodes that have a shingle."""
        placed = of.select("node").join(self.places, "node").join(self.rows, KEY)
        return placed.dropDuplicates(KEY).select("node", _hashes(F.col("text"), self.width).alias(
            "hs")).filter(F.size("hs") > 0)

    def alike(self, pairs: DataFrame, share: float) -> DataFrame:
        """The pairs of ``a, na, b, nb`` (nodes and sizes) that are as similar as ``share`` asks."""
        some = cut_lineage(self.may(pairs, share))
        pairs = _led(some)
        release(some)
        found = self.told(pairs, lambda met: _fit(met, share))
        release(pairs)
        return found

    def told(self, pairs: DataFrame, say) -> DataFrame:
        """What ``say`` makes of the pairs ``a, na, b, nb`` with their shingles ``ha, hb``.

        ``b`` is the end that may lead many pairs; ``pairs`` is a cut.
        """
        spark = pairs.sparkSession
        led = pairs.groupBy("b").agg(F.count("*").alias("c"), F.max("nb").alias("n")).filter(
            F.col("c") >= LED).orderBy(F.desc("c"), "b").limit(LEADS).collect()
        block = np.cumsum([r.n for r in led]) // BROADCAST
        leads = F.broadcast(spark.createDataFrame(
            [(r.b, int(k)) for r, k in zip(led, block)], "b long, block int"))
        # Where b lies is looked up before a's text joins, which so moves once.
        there = [f"to_{c}" for c in KEY]
        rest = pairs.join(leads, "b", "left_anti").join(self.places.toDF("b", *there), "b")
        rest = self.at(rest, "a").withColumnRenamed("text", "ta")
        rest = rest.join(self.rows.toDF(*there, "text"), there).select(
            "a", "b", "na", "nb", *[_hashes(F.col(t), self.width).alias(h)
                                    for t, h in (("ta", "ha"), ("text", "hb"))])
        out = [say(rest)]
        for k in range(int(block[-1]) + 1 if led else 0):
            own = leads.filter(F.col("block") == k).select("b")
            known = F.broadcast(self.sets(own.withColumnRenamed("b", "node")).select(
                F.col("node").alias("b"), F.col("hs").alias("hb")))
            # A text is hashed once for all the leads that it meets.
            by = pairs.join(own, "b").groupBy("a", "na").agg(
                F.collect_list(F.struct("b", "nb")).alias("bs"))
            by = self.at(by, "a").select("a", "na", "bs", _hashes(F.col("text"), self.width).alias("ha"))
            # One block at a time, so that one broadcast is held at a time.
            out.append(cut_lineage(say(by.select("a", "na", "ha", F.inline("bs")).join(known, "b"))))
        found = cut_lineage(reduce(DataFrame.unionAll, out))
        release(*out[1:])
        return found

    def split(self, many: DataFrame, order: tuple[np.ndarray, np.ndarray], share: float):
        """Of ``many`` (``h, node, n, lead, small``: texts that share ``h``, its leading text, the
        smallest size) the pairs ``a, b`` of texts like their lead, rows of ``FOUND`` of those
        that meet outside it, and rows ``h, node, n, place`` of those that may be alike within it.

        A text with ``r`` shingles in its lead, too few to be like it, can only be like texts
        with which it shares one that the lead lacks, or like smaller ones than the lead: those
        whose size asks for no more than ``r``.
        """
        met = cut_lineage(many.filter("node <> lead.node").select(
            F.col("node").alias("a"), F.col("n").alias("na"), F.col("lead.node").alias("b"),
            F.col("lead.n").alias("nb")).distinct())
        out = self.told(met, lambda m: m.select("a", "na", "b", "nb", F.array_except("ha", "hb").alias(
            "out")).mapInArrow(_outside(*order, share), OUTSIDE))
        release(met)
        need = lambda n: _need(n / (1 + share), share)
        sizes = out.filter("h is null").withColumn("r", F.col("na") - F.col("place"))
        like = F.col("r") >= need(F.col("na") + F.col("nb"))
        fits = sizes.filter(like).select("a", "b")

        least = F.greatest("small", _need(F.col("na"), share))
        part = many.filter("small < lead.n").select(
            "h", "small", F.col("node").alias("a"), F.col("lead.node").alias("b")).join(
            sizes.drop("h"), ["a", "b"]).withColumn("like", like).filter(
            (F.col("like") & (F.col("na") < F.col("nb")))
            | (~F.col("like") & (F.col("r") >= need(F.col("na") + least))))
        most = part.filter(~F.col("like")).groupBy("h").agg(
            F.max(F.floor(F.col("r") * (1 + share) / share + 1e-6) - F.col("na")).alias("most"))
        part = part.join(most, "h").filter(~F.col("like") | (F.col("na") <= F.col("most"))).select(
            F.col("h").bitwiseXOR(F.lit(LOW)).alias("h"), F.col("a").alias("node"),
            F.col("na").alias("n"), "place")

        posts = out.filter("h is not null").select(
            "h", F.col("a").alias("node"),
            (F.shiftleft(F.col("na").cast("long"), 32) + F.col("place")).alias("at"))
        dealt = cut_lineage(posts.repartition("h").sortWithinPartitions("h", "node").mapInArrow(
            _pairer(share, PAIRED), FOUND))
        return fits, dealt, part


def _fit(met: DataFrame, share: float) -> DataFrame:
    n = F.col("na") + F.col("nb")
    fits = let(F.size(F.array_intersect("ha", "hb")), lambda both: both >= _need(n - both, share))
    return met.select("a", "b", fits.alias("fits")).filter("fits").select("a", "b")


def _led(pairs: DataFrame) -> DataFrame:
    """The pairs with the end that is in more of them as ``b``."""
    ends = pairs.select(F.col("a").alias("e")).unionAll(pairs.select("b"))
    times = ends.groupBy("e").agg(F.count("*").alias("t"))
    for x in "ab":
        pairs = pairs.join(times.select(F.col("e").alias(x), F.col("t").alias(f"t{x}")), x)
    turn = F.col("ta") > F.col("tb")
    return cut_lineage(pairs.select(*[
        F.when(turn, F.col(y)).otherwise(F.col(x)).alias(x)
        for x, y in (("a", "b"), ("na", "nb"), ("b", "a"), ("nb", "na"))]).distinct())


def _close(prints: DataFrame) -> DataFrame:
    """Pairs of nodes whose fingerprints are equal or within three bits: each fingerprint's least
    node with its others, and with that of the other fingerprint."""
    least = cut_lineage(prints.groupBy("fp").agg(F.min(F.struct("node", "n")).alias("least")))
    same = prints.join(least, "fp").filter("node <> least.node").select(
        F.col("node").alias("a"), F.col("n").alias("na"), F.col("least.node").alias("b"),
        F.col("least.n").alias("nb"))
    near = simhash.links(least.select("fp")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    ends = [least.select(F.col("fp").alias(x), F.col("least").alias(f"least_{x}")) for x in "ab"]
    return same.unionAll(near.join(ends[0], "a").join(ends[1], "b").select(
        "least_a.node", "least_a.n", "least_b.node", "least_b.n"))


def links(texts: _Texts, nodes: DataFrame, share: float = SHARE) -> DataFrame:
    """``node, root`` of every linked node of ``nodes``, one row per node.

    Texts below the width of a shingle are in no pair, nor are null and empty ones.
    """
    count = nodes.count()
    some = nodes.filter(F.pmod(F.xxhash64("node"), F.lit(max(1, count // SAMPLE))) == 0)
    order = _common(texts.sets(some))
    posts = texts.sets(nodes).mapInArrow(_prefixes(*order, share),
                                         "h long, node long, at long, bits array<long>")
    found = cut_lineage(posts.repartition("h").sortWithinPartitions("h", "node").mapInArrow(
        _pairer(share, PAIRED), FOUND))
    close = _close(found.filter(F.col("kind") == PRINT).select(
        F.col("h").alias("fp"), F.col("a").alias("node"), F.col("na").alias("n")))
    texts.bits = found.filter(F.col("kind") == PRINT).select(F.col("a").alias("node"), "bits")
    many = _many(found)
    edges = cut_lineage(texts.alike(close, share))
    roots = cut_lineage(components(edges))
    # What fingerprints have joined need not be verified again.
    edges = cut_lineage(_joined(roots).unionAll(texts.alike(_apart(_pairs(found), roots), share)))
    for k in range(ROUNDS + 1):
        if many.isEmpty():
            break
        roots = cut_lineage(components(edges))
        rooted = texts.partnered(many.join(roots, "node", "left").select(
            *many.columns, F.coalesce("root", "node").alias("root")), share)
        # A shingle whose texts are all in one component has nothing left to say. Of the others
        # the lead has the fewest rarer ones, as a text has that others were made from.
        open_ = rooted.groupBy("h").agg(
            F.min("root").alias("low"), F.max("root").alias("high"), F.min("n").alias("small"),
            F.count("*").alias("c"),
            F.min_by(F.struct("node", "n"), F.struct("place", "node")).alias("lead"))
        open_ = open_.filter("low <> high").select("h", "small", "c", "lead")
        last, many = many, cut_lineage(rooted.join(open_, "h"))
        release(rooted)
        if k:
            release(last)
        # As many as share a shingle, not as have a partner: those that do would be paired in full.
        long_ = F.col("were") > LONG
        tries, led = many.agg(F.sum((F.col("c") - 1) / 2), F.count_if(long_)).first()
        if not tries:
            release(many, found)
            return roots
        if k == ROUNDS or tries <= FEW * count or not led:
            edges = cut_lineage(_joined(roots).unionAll(texts.alike(_all_pairs(many, share), share)))
            release(many)
            break
        fits, dealt, part = texts.split(many.filter(long_), order, share)
        pairs = _all_pairs(many.filter(~long_), share).unionAll(_apart(_pairs(dealt), roots))
        last, many = many, cut_lineage(_many(dealt).unionAll(part))
        edges = cut_lineage(_joined(roots).unionAll(fits).unionAll(
            texts.alike(pairs, share)))
        release(last, dealt)
    release(found)
    return components(edges)


def _pairs(found: DataFrame) -> DataFrame:
    return found.filter(F.col("kind") == PAIR).select("a", "na", "b", "nb").distinct()


def _many(found: DataFrame) -> DataFrame:
    return found.filter(F.col("kind") == MANY).select(
        "h", F.col("a").alias("node"), F.col("na").alias("n"), F.col("nb").alias("place"))


def _all_pairs(many: DataFrame, share: float) -> DataFrame:
    """All pairs of texts that share a shingle and are not in one component."""
    one, two = (many.select("h", *[F.col(c).alias(f"{c}{x}") for c in ("node", "n", "place", "root")])
                for x in "ab")
    # Of a similar pair that is not joined yet, the first shingle they share is here.
    more = F.least(F.col("na") - F.col("placea"), F.col("nb") - F.col("placeb"))
    return one.join(two, "h").filter("roota < rootb").filter(
        more >= _need((F.col("na") + F.col("nb")) / (1 + share), share)).select(
        F.col("nodea").alias("a"), "na", F.col("nodeb").alias("b"), "nb").distinct()


def _joined(roots: DataFrame) -> DataFrame:
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b"))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose nodes are in different components."""
    for x in "ab":
        pairs = pairs.join(roots.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")),
                           x, "left")
    return pairs.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select(
        "a", "na", "b", "nb")


def _kept(docs: DataFrame, doc_id: str, text: str, width: int, share: float):
    """The rows as dealt, what names the one that stays of each component, and its columns."""
    k1, k2, who = (spare(docs, x) for x in ("k1", "k2", "who"))
    key = [k1, k2, who]
    digests = _halves(F.col(text))
    said = F.coalesce(F.concat(F.lit("id "), F.col(doc_id).cast("string")), F.lit("none"))
    rows = cut_by_key(docs.withColumns({k1: digests[0], k2: digests[1], who: said}), *key)
    told = rows.groupBy(*key).agg(F.first(doc_id).alias("id"), F.count("*").alias("c"))
    own = [F.col(c).alias(n) for c, n in zip(key, KEY)]
    told = cut_lineage(told.select(*own, "id", "c"))
    nodes = cut_lineage(told.groupBy("k1", "k2").agg(F.min(F.struct(
        F.col("id").isNull().alias("none"), "id", "who", "c")).alias("first")).withColumn(
            "node", F.monotonically_increasing_id()))
    release(told)

    roots = links(_Texts(rows, key, text, nodes, width), nodes, share)
    # The row that stays of each component, and whether others have its id and words.
    best = nodes.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")) \
        .agg(F.min(F.struct("first.none", "first.id", "k1", "k2", "first.who", "first.c")).alias("r"))
    many = spare(docs, "many")
    kept = cut_lineage(best.select(*[F.col(f"r.{c}").alias(n) for n, c in zip(key, KEY)],
                                   (F.col("r.c") > 1).alias(many)))
    return rows, kept, key, many


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
               width: int = WIDTH, share: float = SHARE) -> DataFrame:
    """One row of each component of near copies, that of the smallest id, with its columns.

    Shingles are ``width`` lower-cased words; texts below that length, null and empty ones are
    copies only of texts with the same words. Rows without an id and rows that repeat one are
    rows like any other; a row with an id goes before one without. Columns may have any names;
    an empty table gives an empty one. A text may be as long as memory holds one.
    """
    with sized_at_run_time(docs.sparkSession):
        rows, kept, key, many = _kept(docs, doc_id, text, width, share)
    left = rows.join(kept, key)
    once = left.filter(~F.col(many)).select(*docs.columns)
    return once.unionAll(left.filter(many).dropDuplicates(key).select(*docs.columns))
