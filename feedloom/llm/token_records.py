"""Token sequences as length-delimited binary records with an offset index.

A record is: length (u64), masked checksum of the length bytes (u32), payload, masked checksum
of the payload (u32), all little-endian. The frame and the masking are those of TFRecord; the
checksum is CRC-32. A payload is one byte of flags (1: has an id, 2: ids of four bytes), the
document id (i64), then the token ids. The index file beside it holds for each record its offset
and the number of tokens before it in the file (two i64), and closes with the totals, so any
record can be read on its own.

Tasks name their files freshly and report them in a row; only reported files count, so an attempt
that is lost or runs twice leaves nothing but an unread file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.files import open_fs
from feedloom.llm.tokens import encoder

END_ID = 1
HAS_ID, WIDE = 1, 2
MANIFEST = "part int, file string, records long, tokens long, bytes long"
ROWS_BYTES = 4 << 20


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload,
                     struct.pack("<I", masked(payload))))


def unframe(read, at: int) -> bytes:
    """Payload of the record whose frame ``read(n)`` goes through next."""
    head = read(12)
    length, crc = struct.unpack("<QI", head)
    if masked(head[:8]) != crc:
        raise ValueError(f"bad length checksum at {at}")
    payload = read(length)
    if struct.unpack("<I", read(4))[0] != masked(payload):
        raise ValueError(f"bad checksum at {at}")
    return payload


def _writer(folder: str, tokenizer: str, end_id: int, id_c: str, text_c: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        part = TaskContext.get().partitionId()
        n = enc.dtype.itemsize
        close = np.array([end_id], enc.dtype).tobytes()
        name, out, fs, root = None, None, None, None
        index, at, tokens = [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                name = f"tokens-{part:05d}-{uuid.uuid4().hex}"
                fs, root = open_fs(folder)
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(f"{root}/{name}.rec", buffer_size=1 << 20)
            ids = batch.column(batch.schema.get_field_index(id_c)).to_pylist()
            texts = batch.column(batch.schema.get_field_index(text_c))
            done = 0
            for flat, ends in enc.encode_column(texts):
                for k, doc in enumerate(ids[done:done + len(ends) - 1]):
                    data = flat[ends[k]:ends[k + 1]].tobytes()
                    flags = (HAS_ID if doc is not None else 0) | (WIDE if n == 4 else 0)
                    record = frame(struct.pack("<Bq", flags, doc or 0) + data + close)
                    out.write(record)
                    index.append((at, tokens))
                    at += len(record)
                    tokens += len(data) // n + 1
                done += len(ends) - 1
        if out is not None:
            out.close()
            with fs.open_output_stream(f"{root}/{name}.idx") as side:
                side.write(np.array(index + [(at, tokens)], "<i8").tobytes())
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "file": [name],
                "records": pa.array([len(index)], pa.int64()),
                "tokens": pa.array([tokens], pa.int64()), "bytes": pa.array([at], pa.int64())})
    return run


def write(docs: DataFrame, folder: str, tokenizer: str, doc_id: str = "doc_id",
          text: str = "text", end_id: int = END_ID) -> DataFrame:
    """Write one record per row in ascending id order; return the manifest, read back.

    Files follow one another by ``part``. Null texts count as empty, null ids come first, and
    rows that repeat an id are ordered by their text; each gets its record. Other columns are
    ignored. An empty table writes no file, and its manifest is empty.
    """
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    own = own.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows = own.mapInArrow(_writer(f"{folder}/data", tokenizer, end_id, "doc_id", "text"), MANIFEST)
    rows.write.parquet(f"{folder}/manifest")
    spark = docs.sparkSession
    files = spark.read.parquet(f"{folder}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first_token", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def _parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    flags, doc = struct.unpack_from("<Bq", payload)
    ids = np.frombuffer(payload, "<u4" if flags & WIDE else "<u2", offset=9)
    return (doc if flags & HAS_ID else None), ids


def _reader(folder: str, with_ids: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        for batch in batches:
            for f in batch.to_pylist():
                yield from _read_file(fs, f"{root}/{f['file']}.rec", f["bytes"],
                                      f["first_token"], with_ids)
    return run


def _read_file(fs, path: str, size: int, start: int, with_ids: bool):
    rows, held, at = [], 0, 0
    with fs.open_input_stream(path, buffer_size=1 << 20) as stream:
        while at < size:
            payload = unframe(stream.read, at)
            at += len(payload) + 16
            doc, ids = _parse(payload)
            data = ids.astype("<u4").tobytes()
            rows.append((doc, start, len(ids), zlib.crc32(data), data if with_ids else None))
            start += len(ids)
            held += len(data) if with_ids else 64
            if held > ROWS_BYTES:
                yield _rows(rows, with_ids)
                rows, held = [], 0
    if rows:
        yield _rows(rows, with_ids)


def _rows(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    doc, start, n, crc, data = zip(*rows)
    cols = {"doc_id": pa.array(doc, pa.int64()), "start": pa.array(start, pa.int64()),
            "n_tokens": pa.array(n, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
    if with_ids:
        cols["ids"] = pa.array([np.frombuffer(d, "<u4").astype("i4") for d in data],
                               pa.list_(pa.int32()))
    return pa.RecordBatch.from_pydict(cols)


def read(manifest: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """The records of the files in ``manifest``: ``doc_id, start, n_tokens, ids_crc32`` and, if
    asked for, ``ids``; checksums are verified. A file is read by one task, record by record."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (
        ", ids array<int>" if with_ids else "")
    files = manifest.select("file", "bytes", "first_token")
    tasks = max(1, manifest.sparkSession.sparkContext.defaultParallelism * 4)
    return files.repartition(tasks).mapInArrow(_reader(f"{folder}/data", with_ids), schema)


def read_record(folder: str, file: str, number: int) -> tuple[int | None, np.ndarray]:
    """Record ``number`` of a file through its index: document id and ids."""
    fs, root = open_fs(f"{folder}/data")
    with fs.open_input_file(f"{root}/{file}.idx") as index:
        at = struct.unpack("<q", index.read_at(8, number * 16))[0]
    with fs.open_input_file(f"{root}/{file}.rec") as data:
        data.seek(at)
        return _parse(unframe(data.read, at))
