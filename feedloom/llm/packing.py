"""Best-fit packing of documents into sequences of a fixed length, by sums of squares.

Documents are tokenized where they are read; those longer than a sequence are cut into whole
sequences and a rest. What is packed is the lengths of the rests: a plan says where each piece
lies, the tokens stay in the files they were written to and are not exchanged. Training reads
pieces by the plan, or :func:`sequences` puts whole sequences together.

A task packs as many pieces as ``GROUP``. It puts each where the sum, over all gaps, of the
squared number of open sequences with that gap becomes smallest; a new sequence is one of the
choices. Pieces come in an order that their number scrambles, but the smallest come last and the
longest of them first, so that they fill what is left open. Which share is held back for that
is tried from ``HELD``; the plan with the fewest sequences counts.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.tokens import encoder
from feedloom.session import cut_lineage, scratch_dir

LENGTH, END_ID = 2048, 0
GROUP = 65_536
HELD = (0.1, 0.2, 1.0)
PIECES = "slot long, doc_id long, piece int, start long, length long, width int, ids binary"
PLACES = "slot long, sequence_id long, offset long"


def _cutter(tokenizer: str, length: int, end_id: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        slot = TaskContext.get().partitionId() << 36
        for batch in batches:
            done = 0
            for flat, ends in enc.encode_column(batch.column(1)):
                n = len(ends) - 1
                size = np.diff(ends) + 1
                stop = np.cumsum(size)
                ids = np.full(stop[-1], end_id, enc.dtype)
                own = np.ones(stop[-1], bool)
                own[stop - 1] = False
                ids[own] = flat
                count = -(-size // length)
                doc = np.repeat(np.arange(n), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                part = np.minimum(length, size[doc] - piece * length)
                # Pieces lie one behind the other, so their bytes are cut without a copy.
                cuts = np.concatenate([[0], np.cumsum(part)]) * enc.dtype.itemsize
                data = pa.Array.from_buffers(pa.large_binary(), len(doc), [
                    None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_pydict({
                    "slot": slot + np.arange(len(doc)),
                    "doc_id": batch.column(0).slice(done, n).take(pa.array(doc)),
                    "piece": piece.astype(np.int32), "start": piece * length,
                    "length": part, "width": np.full(len(doc), enc.dtype.itemsize, np.int32),
                    "ids": data.cast(pa.binary())})
                slot += len(doc)
                done += n
    return run


def tokenize(docs: DataFrame, tokenizer: str, folder: str | None = None, *,
             doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
             end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``length`` ids of every row, written to ``folder`` and read back.

    ``slot`` numbers the pieces, ``start`` counts the ids of the document before the piece,
    ``ids`` are little-endian integers of ``width`` bytes. Each row ends with ``end_id``. A null
    or empty text is that id alone; null ids stay null, repeated rows and ids are rows of their
    own, an empty table gives no piece, other columns are not read. A long text is one row to
    the tokenizer and as many pieces as it fills.
    """
    folder = folder or scratch_dir(docs.sparkSession, "pieces")
    own = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string"))
    own.mapInArrow(_cutter(tokenizer, length, end_id), PIECES).write.parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def sum_of_squares(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of each size in turn, and the number of sequences."""
    held = np.zeros(length + 1, np.int64)  # open sequences by gap
    open_: list[list[int]] = [[] for _ in range(length)]
    where = np.empty(len(sizes), np.int64)
    offset = np.empty(len(sizes), np.int64)
    used, worst = 0, np.iinfo(np.int64).max
    for i, s in enumerate(sizes.tolist()):
        fits = held[s:length]
        # Growth of the sum if the piece goes to a sequence with gap s, s + 1, ...
        growth = 2 * (held[:length - s] - fits) + 2
        growth[:1] = 1 - 2 * fits[:1]  # a closed sequence counts no more
        growth[fits == 0] = worst
        best = int(growth.argmin()) if len(growth) else 0
        if not len(growth) or growth[best] > (2 * held[length - s] + 1 if s < length else 0):
            gap, seq = length, used
            used += 1
        else:
            gap = s + best
            seq = open_[gap].pop()
            held[gap] -= 1
        where[i], offset[i] = seq, length - gap
        if gap > s:
            open_[gap - s].append(seq)
            held[gap - s] += 1
    return where, offset, used


def packed(sizes: np.ndarray, length: int, held: Iterable[float] = HELD):
    """Sequence and offset of each size, with the fewest sequences of the shares held back."""
    fewest = -(-int(sizes.sum()) // length)
    best = None
    for share in held:
        small = sizes <= np.quantile(sizes, share)
        last = np.flatnonzero(small)
        order = np.concatenate([np.flatnonzero(~small),
                                last[np.argsort(-sizes[last], kind="stable")]])
        where, offset, used = sum_of_squares(sizes[order], length)
        if best is None or used < best[2]:
            back = np.empty(len(order), np.int64)
            back[order] = np.arange(len(order))
            best = where[back], offset[back], used
        if best[2] == fewest:
            break
    return best[:2]


def _packer(length: int, held: tuple[float, ...]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if not got:
            return
        slot, size = (np.concatenate(x) for x in zip(*got))
        # The order must not depend on the exchange's; the slots themselves follow the files.
        mixed = slot.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        order = np.argsort(mixed, kind="stable")
        where, offset = packed(size[order], length, held)
        where += TaskContext.get().partitionId() << 32
        for lo in range(0, len(order), 10_000):
            at = slice(lo, lo + 10_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (slot[order[at]], where[at], offset[at])],
                names=["slot", "sequence_id", "offset"])
    return run


def pack(pieces: DataFrame, length: int = LENGTH, *, group: int = GROUP,
         held: tuple[float, ...] = HELD) -> DataFrame:
    """``slot, sequence_id, offset`` of every piece, written to the shared folder.

    Pieces of full length are sequences of their own. The others are dealt over tasks by their
    slot, about ``group`` to each; only slots and lengths are exchanged. A rerun over the same
    pieces gives the same plan. Ties between gaps go to the smallest. No pieces, no rows.
    """
    full = pieces.filter(F.col("length") >= length).select(
        "slot", (-1 - F.col("slot")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.filter(F.col("length") < length).select("slot", "length")
    tasks = max(1, math.ceil(rest.count() / group))
    placed = rest.repartition(tasks, "slot").mapInArrow(_packer(length, tuple(held)), PLACES)
    return cut_lineage(full.unionAll(placed))


def sequences(pieces: DataFrame, plan: DataFrame) -> DataFrame:
    """``sequence_id, ids``: each sequence's pieces in the order of their offsets, put together.

    A sequence is bounded, so its pieces may meet in one row. All pieces have one width.
    """
    placed = pieces.select("slot", "ids").join(plan, "slot")
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", F.aggregate(
        "parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))


def _digester(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crc = [zlib.crc32(np.frombuffer(d, f"<u{w}").astype("<u4").tobytes())
               for d, w in zip(batch.column(5).to_pylist(), batch.column(6).to_pylist())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(crc, pa.int64())],
                                         names=[*batch.schema.names[:5], "ids_crc32"])


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum of their ids in place of them, read from their files."""
    own = pieces.select("slot", "doc_id", "piece", "start", "length", "ids", "width")
    return own.mapInArrow(_digester, "slot long, doc_id long, piece int, start long, "
                                     "length long, ids_crc32 long")
