"""WARC archives and the chunked record table.

Writing: the first page of several with equal payloads is a ``response``, later ones are ``revisit``
records that point to it.  A payload longer than ``segment_bytes`` becomes a segmented record: the
first segment, then ``continuation`` records with their segment number.  Each segment is one row of
a text file whose line end closes the record, so Spark writes real gzip WARC files to any file system.

Reading: each file is read as a stream of lines by one task.  Every segment becomes a row of the
chunked record table: record identifier, chunk number, bytes, and the SHA-256 of the payload so far.
No more than a segment and a batch of lines is held, and the last chunk's digest is checked against
the record's header.

Null payloads count as empty.  Payloads under ``least`` bytes are always responses.  Ties: of equal
ids with equal payloads every one is a response; rows with a null id are responses and never
referred to.  Extra columns are ignored; an empty table writes no record.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import utf8

SEGMENT_BYTES = 1 << 20
LEAST = 100
DATE = "1970-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
CHUNKS = ("record_id long, record_type string, refers_to long, chunk_no int, last boolean, "
          "payload_bytes long, payload_digest string, data binary")


def with_record_type(pages: DataFrame, id_col: str, payload_col: str, url_col: str | None, least: int) -> DataFrame:
    """id, url, payload, digest, and the page a revisit refers to."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        (F.col(url_col) if url_col else F.lit(None)).cast("string").alias("url"),
        utf8(F.col(payload_col)).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    # digests that occur once need no partner: only repeated ones are joined
    first = (rows.filter(F.octet_length("payload") >= least).groupBy("digest")
             .agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first"))
    return rows.join(first, "digest", "left").withColumn(
        "refers_to", F.when((F.col("id") > F.col("first")) & (F.octet_length("payload") >= least), F.col("first")))


def _cuts(payload: memoryview, size: int) -> Iterator[tuple[int, int]]:
    """Segments of at most ``size`` bytes (4 at least) that do not split a character."""
    start, n = 0, len(payload)
    while n - start > size:
        end = start + size
        while payload[end] & 0xC0 == 0x80:
            end -= 1
        yield start, end
        start = end
    yield start, n


def _header(**fields) -> bytes:
    lines = [f"{k.replace('_', '-')}: {v}" for k, v in fields.items() if v is not None]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode()


def _name(record) -> str:
    return f"<urn:record:{'null' if record is None else record}>"


def segments(record, url, payload: memoryview, digest: str, refers_to, size: int) -> Iterator[bytes]:
    """The bytes of one record, segment by segment; each lacks the final line feed."""
    common = {"WARC_Date": DATE, "WARC_Target_URI": re.sub(r"\s", "%20", url) if url else None}
    if refers_to is not None:
        yield _header(WARC_Type="revisit", WARC_Record_ID=_name(record), **common,
                      WARC_Profile="http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                      WARC_Refers_To=_name(refers_to), WARC_Payload_Digest=f"sha256:{digest}",
                      X_Payload_Length=len(payload), Content_Type="application/http;msgtype=response",
                      Content_Length=len(HTTP)) + HTTP + b"\r\n\r"
        return
    cuts = list(_cuts(payload, size))
    for no, (a, b) in enumerate(cuts, 1):
        head = HTTP if no == 1 else b""
        several = len(cuts) > 1
        yield b"".join((_header(
            WARC_Type="response" if no == 1 else "continuation",
            WARC_Record_ID=_name(record) if no == 1 else _name(f"{record}:{no}"), **common,
            WARC_Segment_Number=no if several else None,
            WARC_Segment_Origin_ID=_name(record) if no > 1 else None,
            WARC_Segment_Total_Length=len(HTTP) + len(payload) if several and no == len(cuts) else None,
            WARC_Payload_Digest=f"sha256:{digest}",
            Content_Type="application/http;msgtype=response" if no == 1 else None,
            Content_Length=len(head) + b - a), head, payload[a:b], b"\r\n\r"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", payload_col: str = "html",
                   url_col: str | None = "url", segment_bytes: int = SEGMENT_BYTES, least: int = LEAST) -> None:
    """Write one WARC record per row as ``*.txt.gz`` files below ``path``."""
    rows = with_record_type(pages, id_col, payload_col, url_col, least).select(
        "id", "url", "payload", "digest", "refers_to")
    size = max(4, segment_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for i in range(len(batch)):
                record, url, digest, refers = (batch.column(c)[i].as_py() for c in (0, 1, 3, 4))
                payload = memoryview(batch.column(2)[i].as_buffer())
                for s in segments(record, url, payload, digest, refers, size):
                    out.append(s)
                    held += len(s)
                    if held > 8 << 20:
                        yield _values(out)
                        out, held = [], 0
            yield _values(out)

    rows.mapInArrow(run, "value string").write.option("compression", "gzip").option("lineSep", "\n").text(path)


def _values(rows: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()).cast(pa.string())], ["value"])


_FIELD = re.compile(rb"([^:\r\n]+): ([^\r\n]*)\r\n")


class _Reader:
    """Records of a stream of bytes; one segment is held at a time."""

    def __init__(self, keep: bool):
        self.keep, self.rest, self.record = keep, b"", None

    def feed(self, data: bytes) -> Iterator[tuple]:
        data = self.rest + data
        at = 0
        while True:
            end = data.find(b"\r\n\r\n", at)
            if end < 0:
                break
            fields = dict(_FIELD.findall(data, at, end + 2))
            start, n = end + 4, int(fields[b"Content-Length"])
            if len(data) < start + n + 4:
                break
            yield self.segment(fields, memoryview(data)[start:start + n])
            at = start + n + 4
        self.rest = data[at:]

    def segment(self, fields: dict[bytes, bytes], block: memoryview) -> tuple:
        kind = fields[b"WARC-Type"].decode()
        digest = fields[b"WARC-Payload-Digest"].decode().removeprefix("sha256:")
        if kind == "revisit":
            return (_number(fields[b"WARC-Record-ID"]), kind, _number(fields[b"WARC-Refers-To"]), 0, True,
                    int(fields[b"X-Payload-Length"]), digest, b"" if self.keep else None)
        if kind == "response":
            self.record = [_number(fields[b"WARC-Record-ID"]), 0, 0, hashlib.sha256()]
            block = block[bytes(block[:4096]).find(b"\r\n\r\n") + 4:]
        record, no, size, sha = self.record
        sha.update(block)
        self.record[1:3] = no + 1, size + len(block)
        last = b"WARC-Segment-Number" not in fields or b"WARC-Segment-Total-Length" in fields
        if last and sha.hexdigest() != digest:
            raise ValueError(f"record {record}: payload does not match its digest")
        return record, "response", None, no, last, size + len(block), sha.hexdigest(), bytes(block) if self.keep else None


def _number(name: bytes) -> int | None:
    n = name.decode().removeprefix("<urn:record:").removesuffix(">")
    return None if n == "null" else int(n)


def read_archives(spark: SparkSession, path: str, keep_data: bool = True) -> DataFrame:
    """The chunked record table.  ``payload_bytes`` and ``payload_digest`` cover the payload up to
    and with the chunk; for a revisit, the payload it refers to.  ``data`` is null unless kept."""
    names = [c.split(" ")[0] for c in CHUNKS.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(keep_data)
        for batch in batches:
            lines = batch.column(0).cast(pa.binary()).to_pylist()
            rows, held = [], 0
            for row in reader.feed(b"\n".join(lines) + b"\n" if lines else b""):
                rows.append(row)
                held += len(row[-1] or b"")
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
        if reader.rest:
            raise ValueError("an archive ends inside a record")

    lines = spark.read.schema("value string").option("lineSep", "\n").text(path)
    return lines.mapInArrow(run, CHUNKS)
