"""WARC archives, written with an index first and read back by coalesced byte ranges.

Tasks write gzip-member WARC files and report per record its file, offset, length, URL and
digest; these rows are the index. A read selects records from the index, orders them by file and
offset, joins neighbours into one byte range as long as the gap between them is small, and fetches
each range once. A payload of at least ``MIN_REVISIT`` bytes that occurs before is stored once;
later pages hold a revisit record that names the first.

Tasks name their files freshly and report them; only reported files count.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.files import open_fs
from feedloom.session import cut_lineage

MIN_REVISIT = 100
# Members further apart than this are read by separate ranges; a range ends at RANGE bytes.
GAP, RANGE = 64 << 10, 4 << 20
FILE_BYTES = 256 << 20
# Bytes of archives one task reads.
TASK_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
INDEX = ("page_id long, url string, digest string, record_type string, refers_to long, "
         "file string, offset long, length long")


def _digest(sha256_hex: str) -> str:
    return "sha256:" + base64.b32encode(bytes.fromhex(sha256_hex)).decode()


def _line(text: object) -> str:
    """A header value on one line; line breaks are percent-encoded."""
    return str(text or "").replace("\r", "%0D").replace("\n", "%0A")


def record(page: dict) -> bytes:
    """One gzip member that holds the record of a page."""
    payload = page["payload"] if page["record_type"] == "response" else b""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {page['payload_bytes']}\r\n\r\n").encode()
    head = [f"WARC/1.1\r\nWARC-Type: {page['record_type']}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {_line(page['url'])}",
            f"WARC-Payload-Digest: {_digest(page['digest'])}",
            "Content-Type: application/http; msgtype=response"]
    if page["page_id"] is not None:
        head.append(f"WARC-Page-ID: {page['page_id']}")
    if page["record_type"] == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To-Target-URI: {_line(page['refers_url'])}",
                 f"WARC-Refers-To-Page-ID: {page['refers_to']}"]
    head.append(f"Content-Length: {len(http) + len(payload)}")
    data = "\r\n".join(head).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"
    gz = zlib.compressobj(1, zlib.DEFLATED, 31)
    return gz.compress(data) + gz.flush()


def parse(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of one gzip member."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, _fields(http), payload


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}


def _writer(folder: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        out, name, at = None, None, 0
        for batch in batches:
            rows = []
            for k in range(0, batch.num_rows, 64):
                for page in batch.slice(k, 64).to_pylist():
                    if out is None:
                        fs.create_dir(root, recursive=True)
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None,
                                                    buffer_size=1 << 20)
                    data = record(page)
                    out.write(data)
                    rows.append((*(page[c] for c in ("page_id", "url", "digest", "record_type",
                                                     "refers_to")), name, at, len(data)))
                    at += len(data)
                    if at >= FILE_BYTES:
                        out.close()
                        out = None
            if rows:
                yield _table(rows, _ARROW_INDEX)
        if out is not None:
            out.close()
    return run


_ARROW_INDEX = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()),
                          ("record_type", pa.string()), ("refers_to", pa.int64()),
                          ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
_ARROW_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()),
                           ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                           ("record_type", pa.string()), ("refers_to", pa.int64()),
                           ("payload", pa.binary())])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def classify(pages: DataFrame, page_id: str = "page_id", url: str = "url",
             payload: str = "html", min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Pages as records: payload, digest, type and the record a revisit refers to.

    Of equal payloads the page of the smallest id is the response. Rows without an id are always
    responses and are never referred to. Rows that repeat id and payload of a response are
    responses too, as none of them comes earlier.
    """
    own = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"))
    own = own.withColumns({"digest": F.sha2("payload", 256),
                           "payload_bytes": F.octet_length("payload").cast("long")})
    # Only payloads that occur twice have anything to refer to.
    firsts = own.filter((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull()) \
        .groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("page_id", "url"))
                               .alias("first")).filter(F.col("n") > 1)
    firsts = cut_lineage(firsts.select(F.col("digest").alias("d"), "first"))
    own = own.join(firsts, F.col("digest") == F.col("d"), "left").drop("d")
    later = F.coalesce(F.col("page_id") > F.col("first.page_id"), F.lit(False))
    return own.withColumns({
        "record_type": F.when(later, "revisit").otherwise("response"),
        "refers_to": F.when(later, F.col("first.page_id")),
        "refers_url": F.when(later, F.col("first.url"))}).drop("first")


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url",
          payload: str = "html", min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Write one record per row below ``folder``; return the index, read back.

    Null payloads are empty; a null url is written as an empty one and stays null in the index.
    Other columns are ignored. An empty table writes no file, and its index is empty.
    """
    records = classify(pages, page_id, url, payload, min_bytes)
    records.mapInArrow(_writer(f"{folder}/data"), INDEX).write.parquet(f"{folder}/index")
    return pages.sparkSession.read.parquet(f"{folder}/index")


def ranges(selected: DataFrame, gap: int = GAP, most: int = RANGE) -> DataFrame:
    """Byte ranges that cover the selected records: ``file, start, stop, records``.

    Records are numbered by the stretch of ``most`` bytes they start in; within a stretch a gap
    above ``gap`` bytes opens a new range.
    """
    own = selected.withColumn("stretch", F.floor(F.col("offset") / most))
    w = Window.partitionBy("file", "stretch").orderBy("offset")
    apart = F.col("offset") - F.lag(F.col("offset") + F.col("length")).over(w) > gap
    own = own.withColumn("run", F.sum(F.coalesce(apart.cast("int"), F.lit(0))).over(w))
    return own.groupBy("file", "stretch", "run").agg(
        F.min("offset").alias("start"), F.max(F.col("offset") + F.col("length")).alias("stop"),
        F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("records"))


def _reader(folder: str, with_payload: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        for batch in batches:
            for r in batch.to_pylist():
                with fs.open_input_file(f"{root}/{r['file']}") as f:
                    data = f.read_at(r["stop"] - r["start"], r["start"])
                rows = []
                for x in r["records"]:
                    at = x["offset"] - r["start"]
                    rows.append(_row(data[at:at + x["length"]], with_payload))
                yield _table(rows, _ARROW_RECORD)
    return run


def _row(member: bytes, with_payload: bool) -> tuple:
    fields, http, payload = parse(member)
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha256:")).hex()
    kind = fields["warc-type"]
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"bad digest of {fields['warc-record-id']}")
    number = lambda k: int(fields[k]) if k in fields else None
    return (number("warc-page-id"), fields["warc-target-uri"], int(http["content-length"]),
            digest, kind, number("warc-refers-to-page-id"), payload if with_payload else None)


def read(selected: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The selected records of the index, read from the archives; digests are verified.

    A revisit has the size and digest of the full payload but no payload of its own.
    """
    schema = ("page_id long, url string, payload_bytes long, payload_digest string, "
              "record_type string, refers_to long" + ", payload binary")
    # Ranges are small rows that stand for much reading: deal them by the bytes they cover.
    size = selected.agg(F.sum("length")).first()[0] or 0
    tasks = max(selected.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    found = ranges(selected).repartition(tasks).mapInArrow(
        _reader(f"{folder}/data", with_payload), schema)
    return found if with_payload else found.drop("payload")
