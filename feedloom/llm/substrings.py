"""Substring dedup: runs of words that occur earlier in the corpus are removed.

The decision is that of suffix automata of reference passages: a document's words stream through
the automaton, and wherever the matching statistic reaches the window width, the window occurs
in a passage; it goes if that place is earlier. To send every document past the automaton of every
reference shard would cost documents times shards, so two passes of hashes first find which
passages are references at all and which documents need which:

1. Documents equal to an earlier one need no search.
2. Each window has an anchor, the run of eight words in it of the least hash. Anchors that occur
   once in the corpus rule out their windows.
3. Of the other windows the hashes are counted and the first place of each is found. The first
   places of repeated windows are the references, a tenth of the corpus or less.
4. References are cut to passages and go to those blocks of documents that hold a repeat.
5. A block's task builds automata of bounded size over the passages its documents need.

Texts never move: documents are read where they lie, in blocks of rows of a file, and what a
block needs is written to a folder of its own in the shared folder. Within a block hashes
are counted before they are exchanged, so a run that a third of the documents hold is a row per
block. Nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.automaton import SuffixAutomaton
from feedloom.llm.files import read_folder
from feedloom.session import cut_lineage, scratch_dir

WIDTH, ANCHOR = 20, 8
# Rows of a file that form a block, as a power of two.
BLOCK_ROWS = 14
# First places are grouped by so many words; a passage is what one group holds.
GROUP = 256
# Words of the passages in one automaton, about 400 bytes each.
SHARD_WORDS = 100_000
PIECE_WORDS = 1 << 16
# Words of the documents that wait for an automaton.
HELD_WORDS = 250_000
FLUSH = 1 << 19
NO_ID = -(1 << 63)

_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)
_powers = {_BASE: np.ones(1, np.uint64), _UNBASE: np.ones(1, np.uint64)}


def _power(base: int, n: int) -> np.ndarray:
    own = _powers[base]
    while len(own) < n:
        own = np.concatenate([own, own * np.uint64(pow(base, len(own), 1 << 64))])
    _powers[base] = own
    return own[:n]


class Piece:
    """Some words of a document with the hashes of all their runs of a given length."""

    def __init__(self, words: list[bytes]):
        data = np.frombuffer(b" ".join(words), np.uint8)
        self.ends = np.cumsum([len(w) + 1 for w in words]) - 1
        self.starts = np.concatenate([[0], self.ends[:-1] + 1])
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(data * _power(_BASE, len(data)), out=self.sums[1:])
        self.inverse = _power(_UNBASE, len(data) + 1)

    def runs(self, width: int) -> np.ndarray:
        at = self.starts[:len(self.starts) - width + 1]
        h = (self.sums[self.ends[width - 1:]] - self.sums[at]) * self.inverse[at]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))

    def anchors(self, width: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
        """Anchor hashes, and for each window the place of its anchor."""
        h = self.runs(anchor)
        views = np.lib.stride_tricks.sliding_window_view(h, width - anchor + 1)
        return h, views.argmin(axis=1) + np.arange(len(views))


def _pieces(words: list[bytes], width: int) -> Iterator[tuple[int, Piece]]:
    """Pieces that share the words of all but one of a window, so each window is in one."""
    for at in range(0, len(words) - width + 1, PIECE_WORDS):
        yield at, Piece(words[at:at + PIECE_WORDS + width - 1])


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").split()


def _docs(batches: Iterable[pa.RecordBatch], slice_rows: int = 256):
    """(block, id, copy of an earlier text, words) of each row."""
    for batch in batches:
        for k in range(0, batch.num_rows, slice_rows):
            part = batch.slice(k, slice_rows)
            for blk, doc, text, copy in zip(*(part.column(i).to_pylist() for i in range(4))):
                yield blk, NO_ID if doc is None else doc, copy, _split(text)


def _arrow(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c.view("<i8") if c.dtype == np.uint64 else c) for c in columns.values()],
        names=list(columns))


class _Side:
    """Rows that earlier steps left for the block at hand."""

    def __init__(self, path: str):
        self.path, self.blk, self.table = path, None, None

    def of(self, blk: int) -> bool:
        """Turn to a block; true if it is another one."""
        if blk == self.blk:
            return False
        self.blk, self.table = blk, read_folder(f"{self.path}/blk={blk}")
        return True

    def column(self, name: str, dtype="<i8") -> np.ndarray:
        if self.table is None:
            return np.zeros(0, dtype)
        return self.table.column(name).to_numpy().astype(dtype, copy=False)


def _leave(rows: DataFrame, name: str) -> str:
    """Write rows for their blocks: a folder per block."""
    path = scratch_dir(rows.sparkSession, name)
    rows.repartition("blk").write.partitionBy("blk").parquet(path)
    return path


def _find_anchors(width: int, anchor: int, copies: str):
    """Per block its anchors and how often each occurs there."""
    def run(batches):
        side = _Copies(copies)
        blk, held, size = None, [], 0

        def flush():
            h, n = np.unique(np.concatenate(held), return_counts=True)
            return _arrow({"h": h, "blk": np.full(len(h), blk, "<i8"), "n": n.astype("<i8")})

        for b, doc, text_hash, words in _docs(batches):
            if held and (b != blk or size > FLUSH):
                yield flush()
                held, size = [], 0
            blk = b
            if len(words) < width or side.is_copy(b, doc, text_hash):
                continue
            for _, piece in _pieces(words, width):
                h, at = piece.anchors(width, anchor)
                held.append(h[np.unique(at)])
                size += len(held[-1])
        if held:
            yield flush()
    return run


class _Copies:
    """Which documents of a block are equal to an earlier one."""

    def __init__(self, path: str):
        self.side, self.found = _Side(path), set()

    def is_copy(self, blk: int, doc: int, text_hash: str | None) -> bool:
        if self.side.of(blk):
            t = self.side.table
            self.found = set() if t is None else set(zip(t.column("id").to_pylist(),
                                                         t.column("hash").to_pylist()))
        return (doc, text_hash) in self.found


def _find_windows(width: int, anchor: int, copies: str, anchors: str):
    """Per block the windows with a repeated anchor: hash, first place, how often."""
    def run(batches):
        side, known, copied = _Side(anchors), np.zeros(0, np.uint64), _Copies(copies)
        blk, held, size = None, [], 0

        def flush():
            h, doc, pos = (np.concatenate(c) for c in zip(*held))
            order = np.lexsort((pos, doc, h))
            h, doc, pos = h[order], doc[order], pos[order]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            n = np.diff(np.append(first, len(h)))
            return _arrow({"h": h[first], "blk": np.full(len(first), blk, "<i8"),
                           "id": doc[first], "pos": pos[first], "n": n.astype("<i8")})

        for b, doc, text_hash, words in _docs(batches):
            if held and (b != blk or size > FLUSH):
                yield flush()
                held, size = [], 0
            blk = b
            if side.of(b):
                known = np.sort(side.column("h").view("<u8"))
            if not len(known) or len(words) < width or copied.is_copy(b, doc, text_hash):
                continue
            for start, piece in _pieces(words, width):
                h, at = piece.anchors(width, anchor)
                pos = np.flatnonzero(_among(h[at], known))
                if len(pos):
                    held.append((piece.runs(width)[pos], np.full(len(pos), doc, "<i8"),
                                 (pos + start).astype("<i8")))
                    size += len(pos)
        if held:
            yield flush()
    return run


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def _cut_passages(width: int, copies: str, firsts: str):
    """The words around a block's first places: a row per run of places within a group."""
    def run(batches):
        side, copied, places = _Side(firsts), _Copies(copies), {}
        for blk, doc, text_hash, words in _docs(batches):
            if side.of(blk):
                places = _by_id(side.column("id"), side.column("pos"))
            if doc not in places or copied.is_copy(blk, doc, text_hash):
                continue
            pos = np.unique(places[doc])
            pos = pos[pos + width <= len(words)]
            cut = np.flatnonzero((np.diff(pos) > 1) | (np.diff(pos // GROUP) > 0)) + 1
            rows = [(int(p[0]), b" ".join(words[p[0]:p[-1] + width]).decode("utf-8"))
                    for p in np.split(pos, cut) if len(p)]
            if rows:
                starts, texts = zip(*rows)
                starts = np.array(starts, "<i8")
                yield pa.RecordBatch.from_pydict({
                    "id": np.full(len(rows), doc, "<i8"), "grp": starts // GROUP,
                    "start": starts, "passage": pa.array(texts, pa.string())})
    return run


def _by_id(ids: np.ndarray, values: np.ndarray) -> dict[int, np.ndarray]:
    order = np.argsort(ids, kind="stable")
    ids, values = ids[order], values[order]
    cut = np.flatnonzero(np.diff(ids)) + 1
    return {int(i[0]): v for i, v in zip(np.split(ids, cut), np.split(values, cut)) if len(i)}


def _remove(width: int, copies: str, repeats: str, passages: str):
    """Each document with the spans that go and the text that stays."""
    def run(batches):
        side, refs, copied = _Side(repeats), _Side(passages), _Copies(copies)
        h = first_id = first_pos = None
        texts: dict[tuple[int, int], list] = {}
        held, need, size, n_words = [], set(), 0, 0

        def done():
            auto, places = _automaton(sorted(need), texts)
            spans = [_spans(auto, places, *x[1:], width) for x in held]
            return _result([x[0] for x in held], [x[2] for x in held], spans)

        for batch in batches:
            ids = batch.column(1).to_pylist()
            for real_id, (blk, doc, text_hash, words) in zip(ids, _docs([batch])):
                if blk != side.blk and held:
                    yield done()
                    held, need, size, n_words = [], set(), 0, 0
                if side.of(blk):
                    order = np.argsort(side.column("h").view("<u8"))
                    h = side.column("h").view("<u8")[order]
                    first_id, first_pos = side.column("id")[order], side.column("pos")[order]
                    refs.of(blk)
                    texts = _passages(refs.table)
                runs = None
                if copied.is_copy(blk, doc, text_hash):
                    runs = "all"
                elif len(h) and len(words) >= width:
                    runs = []
                    for start, piece in _pieces(words, width):
                        mine = piece.runs(width)
                        at = np.minimum(np.searchsorted(h, mine), len(h) - 1)
                        pos = np.arange(len(mine)) + start
                        later = (h[at] == mine) & ((first_id[at] < doc) | (
                            (first_id[at] == doc) & (first_pos[at] < pos)))
                        runs.append(pos[later])
                        groups = set(zip(first_id[at][later].tolist(),
                                         (first_pos[at][later] // GROUP).tolist())) - need
                        need |= groups
                        size += sum(len(p) // 6 for g in groups for _, p in texts.get(g, ()))
                    runs = np.concatenate(runs)
                held.append((real_id, doc, words, runs))
                n_words += len(words)
                if size > SHARD_WORDS or n_words > HELD_WORDS:
                    yield done()
                    held, need, size, n_words = [], set(), 0, 0
        if held:
            yield done()
    return run


def _passages(table: pa.Table | None) -> dict[tuple[int, int], list[tuple[int, str]]]:
    out: dict[tuple[int, int], list[tuple[int, str]]] = {}
    if table is not None:
        for i, g, s, p in zip(*(table.column(c).to_pylist()
                                for c in ("id", "grp", "start", "passage"))):
            out.setdefault((i, g), []).append((s, p))
    return out


def _automaton(groups: list[tuple[int, int]], texts: dict):
    """Automaton of the wanted passages, and (start in it, id, position) of each."""
    rows = [(g[0], start, _split(p)) for g in groups for start, p in texts.get(g, ())]
    auto = SuffixAutomaton(words for _, _, words in rows)
    return auto, (np.array(auto.passages, "<i8"), [(i, s) for i, s, _ in rows])


def _spans(auto: SuffixAutomaton, places, doc: int, words: list[bytes], runs, width: int):
    """(start, length) of the maximal spans that earlier windows cover.

    Only the stretches whose hashes were met are streamed; what goes is what matches there.
    """
    if isinstance(runs, str):
        return [(0, len(words))] if len(words) >= width else []
    if runs is None or not len(runs):
        return []
    starts, where = places
    out: list[tuple[int, int]] = []
    for p in np.split(runs, np.flatnonzero(np.diff(runs) > 1) + 1):
        lo, hi = int(p[0]), int(p[-1]) + width
        for i, end in auto.matches(words[lo:hi], width):
            at = int(np.searchsorted(starts, end, "right")) - 1
            ref_id, ref_start = where[at]
            pos = lo + i - width + 1
            if (ref_id, ref_start + end - width + 1 - int(starts[at])) < (doc, pos):
                if out and pos <= out[-1][1]:
                    out[-1] = (out[-1][0], pos + width)
                else:
                    out.append((pos, pos + width))
    return [(a, b - a) for a, b in out]


RESULT = ("doc_id long, n_words long, removed array<struct<start:bigint,length:bigint>>, "
          "kept string")
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))


def _result(ids: list, docs: list[list[bytes]], spans: list) -> pa.RecordBatch:
    kept = []
    for words, own in zip(docs, spans):
        at, parts = 0, []
        for start, length in own:
            parts += words[at:start]
            at = start + length
        kept.append(b" ".join(parts + words[at:]).decode("utf-8"))
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array([len(w) for w in docs], pa.int64()),
        pa.array([[{"start": a, "length": n} for a, n in s] for s in spans], _SPAN),
        pa.array(kept, pa.string())], names=["doc_id", "n_words", "removed", "kept"])


def _blocks(docs: DataFrame, doc_id: str, text: str, rows: int) -> DataFrame:
    """``blk, doc_id, text, hash``; a block is 2 ** ``rows`` rows of a file."""
    def own(df: DataFrame, id_c: str, text_c: str) -> DataFrame:
        blk = F.xxhash64(F.col("_metadata.file_path"), F.shiftright(
            F.col("_metadata.row_index"), rows))
        return df.select(blk.alias("blk"), F.col(id_c).cast("long").alias("doc_id"),
                         F.col(text_c).alias("text"), F.md5(F.col(text_c)).alias("hash"))
    try:
        return own(docs, doc_id, text)
    except AnalysisException:  # not a scan of parquet files
        narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        return own(cut_lineage(narrow), "doc_id", "text")


def dedupe(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
           anchor: int = ANCHOR, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``doc_id, n_words, removed, kept`` for every row of ``docs``.

    A word goes if it lies in a window of ``width`` words that also starts earlier: in a document
    of a smaller id, or earlier in the same one. ``removed`` lists the (start, length) spans in
    words, ``kept`` holds the other words joined by one space. Windows are judged on the input.
    Null and empty texts have no words; null ids count as the smallest. Rows that repeat an id are
    versions of one document: none is earlier than another at the same start. Other columns are
    ignored; an empty table gives no rows.

    A task holds what one block of 2 ** ``block_rows`` rows needs, about 100 bytes for each of its
    repeated words; each block has a folder per step. Large executors take larger blocks.
    """
    blocks = _blocks(docs, doc_id, text, block_rows)
    ids = F.coalesce("doc_id", F.lit(NO_ID)).alias("id")
    hashes = cut_lineage(blocks.select("blk", ids, "hash"))
    first = hashes.groupBy("hash").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    first = cut_lineage(first.filter("n > 1 AND hash IS NOT NULL").drop("n"))
    copies = _leave(hashes.join(first, "hash").filter("id > first").select(
        "blk", "id", "hash"), "copies")

    scan = blocks.select("blk", "doc_id", "text", "hash")
    found = scan.mapInArrow(_find_anchors(width, anchor, copies), "h long, blk long, n long")
    same = Window.partitionBy("h")
    found = found.withColumn("n", F.sum("n").over(same)).filter("n > 1")
    anchors = _leave(found.select("blk", "h").distinct(), "anchors")

    wins = scan.mapInArrow(_find_windows(width, anchor, copies, anchors),
                           "h long, blk long, id long, pos long, n long")
    place = F.struct("id", "pos")
    wins = wins.withColumns({"first": F.min(F.struct("id", "pos")).over(same),
                             "total": F.sum("n").over(same)}).filter("total > 1")
    wins = cut_lineage(wins.select("h", "blk", "first", "n", (place == F.col("first"))
                                   .alias("is_first")))
    firsts = _leave(wins.filter("is_first").select(
        "blk", F.col("first.id").alias("id"), F.col("first.pos").alias("pos")), "firsts")
    later = wins.filter("NOT is_first OR n > 1").select(
        "blk", "h", F.col("first.id").alias("id"), F.col("first.pos").alias("pos"))
    repeats = _leave(later, "repeats")

    passages = cut_lineage(scan.mapInArrow(_cut_passages(width, copies, firsts),
                                           "id long, grp long, start long, passage string"))
    needs = later.select("blk", "id", F.floor(F.col("pos") / GROUP).alias("grp")).distinct()
    routed = _leave(needs.join(passages.distinct(), ["id", "grp"]), "passages")
    return scan.mapInArrow(_remove(width, copies, repeats, routed), RESULT)
