"""Legacy archive converter: ARC files to WARC files.

ARC (1996) files are a version block followed by records, each a one-line
header and as many bytes of content as the header declares:

* version 1: ``URL IP-address Archive-date Content-type Archive-length``
* version 2: ``URL IP-address Archive-date Content-type Result-code Checksum
  Location Offset Filename Archive-length``

The version block (``filedesc://``) says which of the two follows.  The
converter finds records only by those lengths, so a payload may hold anything,
header-like lines included.  It synthesises what WARC asks for and ARC lacks:
a record id (UUID 5 of the record's place and content), the W3C form of the
14-digit date, the record type and the SHA-1 digest of the payload.  Of records with equal
payloads the one with the largest source id is written as ``response``, the
others as ``revisit`` without payload that name it.

Archives are written by Spark's text writer (committed, retried and readable
on any file system Spark knows): a record per row, the record separator as
line separator, gzip over each file.  An archive is one partition of its
writer, so ``spark.sql.files.maxPartitionBytes`` bounds it.  Archives are read
back as binary files, unpacked and cut by declared lengths as a stream.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.llm.common import col, written
from snapflow.session import scratch_path

V1 = "URL IP-address Archive-date Content-type Archive-length"
V2 = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
BATCH_BYTES = 4_000_000
WARC_END = "\r\n\r\n"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def packed(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded bytes."""
    buffer, size = [], 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*buffer), schema)], schema=schema)

    for row in rows:
        buffer.append(row)
        size += 100 + sum(len(v) for v in row if isinstance(v, (bytes, str)))
        if size >= BATCH_BYTES:
            yield flush()
            buffer, size = [], 0
    if buffer:
        yield flush()


def by_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _write_records(df: DataFrame, path: str, separator: str) -> None:
    """Write the binary column ``record``; its bytes reach the files unchanged."""
    (
        df.select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", separator)
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .text(path)
    )


class Unpacked:
    """A gzip file's content, unpacked as it is read."""

    def __init__(self, packed_bytes: bytes) -> None:
        self.source, self.at, self.buffer = packed_bytes, 0, bytearray()
        self.engine = zlib.decompressobj(wbits=31)

    def _more(self) -> bool:
        if self.engine.unconsumed_tail:
            self.buffer += self.engine.decompress(self.engine.unconsumed_tail, 1 << 20)
        elif self.engine.eof and self.engine.unused_data:  # next member
            rest, self.engine = self.engine.unused_data, zlib.decompressobj(wbits=31)
            self.buffer += self.engine.decompress(rest, 1 << 20)
        elif self.at < len(self.source):
            piece = self.source[self.at : self.at + (1 << 18)]
            self.at += len(piece)
            self.buffer += self.engine.decompress(piece, 1 << 20)
        else:
            tail = self.engine.flush()
            self.buffer += tail
            return bool(tail)
        return True

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self._more():
                raise ValueError(f"archive ends {n - len(self.buffer)} bytes early")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out

    def until(self, mark: bytes) -> bytes | None:
        """Bytes before the next ``mark``, which is consumed; None at the end of the file."""
        start = 0
        while (i := self.buffer.find(mark, start)) < 0:
            start = max(0, len(self.buffer) - len(mark) + 1)
            if not self._more():
                if self.buffer.strip():
                    raise ValueError("archive ends inside a header")
                return None
        out = bytes(self.buffer[:i])
        del self.buffer[: i + len(mark)]
        return out


# ------------------------------------------------------------------ ARC


def _header_field(value: str | None) -> str:
    """A header field holds no white space and no control character."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value or "") or "-"


def _http(payload: bytes, source_id: int | None) -> bytes:
    mark = "" if source_id is None else f"X-Source-Id: {source_id}\r\n"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n{mark}\r\n"
    return head.encode() + payload


def write_arc(
    pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "20240101000000"
) -> None:
    """Write pages as ARC files, version 1 and 2 by turns of the partition.

    NULL html is an empty payload, NULL url a dash, NULL id no id.
    """
    rows = pages.select(col(id_col).cast("long"), col(url_col).cast("string"), F.encode(col(html_col), "UTF-8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        version = 1 + TaskContext.get().partitionId() % 2
        name = f"part-{TaskContext.get().partitionId():05d}.arc"

        def records() -> Iterator[tuple]:
            note = f"{version} 0 snapflow\n{V1 if version == 1 else V2}\n".encode()
            fields = f"filedesc://{name} 0.0.0.0 {date} text/plain"
            if version == 2:
                fields += f" 200 - - 0 {name}"
            record = f"{fields} {len(note)}\n".encode() + note
            yield (record,)
            at = len(record) + 1
            for source_id, url, html in by_rows(batches):
                content = _http(html or b"", source_id)
                fields = f"{_header_field(url)} 0.0.0.0 {date} text/html"
                if version == 2:
                    check = hashlib.md5(content).hexdigest()
                    fields += f" 200 {check} - {at} {name}"
                record = f"{fields} {len(content)}\n".encode() + content
                yield (record,)
                at += len(record) + 1

        yield from packed(records(), pa.schema([("record", pa.binary())]))

    _write_records(rows.mapInArrow(run, "record binary"), path, "\n")


def parse_arc(stream: Unpacked) -> Iterator[dict]:
    """Records of one ARC file, cut by declared lengths."""
    width = None
    while (line := stream.until(b"\n")) is not None:
        if not line.strip():
            continue  # the separator after a record
        fields = line.decode("utf-8", "replace").split(" ")
        length = int(fields[-1])
        content = stream.take(length)
        if width is None:
            if not fields[0].startswith("filedesc://"):
                raise ValueError("no version block")
            version = content.split(b" ", 1)[0]
            if version not in (b"1", b"2"):
                raise ValueError(f"unknown version {version!r}")
            width = 5 if version == b"1" else 10
            continue
        if len(fields) != width:
            raise ValueError(f"{len(fields)} header fields, {width} expected")
        record = {"url": fields[0], "ip": fields[1], "date": fields[2], "type": fields[3], "content": content}
        if width == 10:
            record["status"], check = fields[4], fields[5]
            if check != "-" and check != hashlib.md5(content).hexdigest():
                raise ValueError(f"checksum of {fields[0]} differs")
        yield record


ARC_ROWS = pa.schema(
    [
        ("source_id", pa.int64()),
        ("url", pa.string()),
        ("warc_date", pa.string()),
        ("record_id", pa.string()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("http_head", pa.binary()),
        ("payload", pa.binary()),
    ]
)


def _source_id(http_head: bytes) -> int | None:
    m = re.search(rb"\r\nX-Source-Id: (-?\d+)\r\n", http_head)
    return int(m[1]) if m else None


def w3c_date(arc_date: str) -> str:
    d = (arc_date + "0" * 14)[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """Rows of ``ARC_ROWS``, one per record of the ARC files under ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[tuple]:
            for name, content in by_rows(batches):
                name = name.rsplit("/", 1)[-1]
                for n, r in enumerate(parse_arc(Unpacked(content))):
                    head, mark, payload = r["content"].partition(b"\r\n\r\n")
                    digest = sha1_base32(payload)
                    rid = uuid.uuid5(uuid.NAMESPACE_URL, f"{name}#{n} {r['url']} {r['date']} {digest}")
                    yield (
                        _source_id(head + b"\r\n"), r["url"], w3c_date(r["date"]), f"urn:uuid:{rid}",
                        digest, len(payload), head + mark, payload,
                    )

        yield from packed(records(), ARC_ROWS)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(
        run,
        "source_id long, url string, warc_date string, record_id string, payload_digest string, "
        "payload_bytes long, http_head binary, payload binary",
    )


# ------------------------------------------------------------------ WARC


def convert(records: DataFrame, min_revisit_bytes: int = 0, broadcast_rows: int = 100_000) -> DataFrame:
    """WARC records (column ``record``) of ``read_arc``'s rows.

    Per payload of at least ``min_revisit_bytes`` the record with the largest
    source id (NULL smallest; of equal ids the largest record id) is the
    response, the others revisit it.  Payload sharing is found from digests
    and ids alone: partial maxima, no payload in that shuffle.  The table of
    repeated payloads is broadcast if it has at most ``broadcast_rows`` rows;
    beyond, records and table are joined by shuffle.
    """
    best = written(
        records.where(F.col("payload_bytes") >= min_revisit_bytes)
        .groupBy("payload_digest")
        .agg(F.max(F.struct("source_id", "record_id", "url", "warc_date")).alias("kept"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("payload_digest").alias("_digest"), "kept"),
        "repeated-payloads",
    )
    joined = records.join(
        F.broadcast(best) if best.count() <= broadcast_rows else best, (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") >= min_revisit_bytes), "left"
    )
    revisit = F.col("kept").isNotNull() & (F.col("kept.record_id") != F.col("record_id"))
    rows = joined.select(
        "source_id", "url", "warc_date", "record_id", "payload_digest", "payload_bytes", "http_head",
        F.when(~revisit, F.col("payload")).alias("payload"),
        F.when(revisit, F.col("kept.record_id")).alias("kept_id"),
        F.when(revisit, F.col("kept.source_id")).alias("kept_source"),
        F.when(revisit, F.col("kept.url")).alias("kept_url"),
        F.when(revisit, F.col("kept.warc_date")).alias("kept_date"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            first = True
            for source_id, url, date, rid, digest, n, head, payload, kept_id, kept_source, kept_url, kept_date in by_rows(batches):
                if first:
                    yield (_warc(_info_fields(rid, date), b"software: snapflow\r\nformat: WARC File Format 1.1\r\n"),)
                    first = False
                fields = [
                    ("WARC-Type", "revisit" if kept_id else "response"),
                    ("WARC-Record-ID", f"<{rid}>"),
                    ("WARC-Target-URI", url),
                    ("WARC-Date", date),
                    ("WARC-Payload-Digest", f"sha1:{digest}"),
                    ("X-Payload-Length", str(n)),
                    ("Content-Type", "application/http; msgtype=response"),
                ]
                if source_id is not None:
                    fields.append(("X-Source-Id", str(source_id)))
                if kept_id:
                    fields += [
                        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                        ("WARC-Refers-To", f"<{kept_id}>"),
                        ("WARC-Refers-To-Target-URI", kept_url),
                        ("WARC-Refers-To-Date", kept_date),
                    ]
                    if kept_source is not None:
                        fields.append(("X-Refers-To-Source-Id", str(kept_source)))
                block = head if kept_id else head + payload
                fields.append(("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"))
                yield (_warc(fields, block),)

        yield from packed(out(), pa.schema([("record", pa.binary())]))

    return rows.mapInArrow(run, "record binary")


def _info_fields(rid: str, date: str) -> list[tuple[str, str]]:
    info = uuid.uuid5(uuid.NAMESPACE_URL, f"warcinfo {rid}")
    return [
        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{info}>"), ("WARC-Date", date),
        ("Content-Type", "application/warc-fields"),
    ]


def _warc(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block


def write_warc(records: DataFrame, path: str) -> None:
    _write_records(records, path, WARC_END)


def parse_warc(stream: Unpacked) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of one WARC file."""
    while (head := stream.until(b"\r\n\r\n")) is not None:
        lines = head.decode("utf-8").lstrip("\r\n").split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record: {lines[0][:40]!r}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        block = stream.take(int(fields["Content-Length"]))
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError("record is not closed")
        yield fields, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Response and revisit records: ``page_id, payload_bytes, payload_digest,
    record_type, refers_to, record_id, url, warc_date, payload``.

    Digests of responses are computed again from the payload and must agree
    with the header; a revisit has a NULL payload and its header's figures.
    """
    schema = pa.schema(
        [
            ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()),
            ("url", pa.string()), ("warc_date", pa.string()), ("payload", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for (content,) in by_rows(batches):
                for f, block in parse_warc(Unpacked(content)):
                    if f["WARC-Type"] == "warcinfo":
                        continue
                    digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
                    n, payload = int(f["X-Payload-Length"]), None
                    if f["WARC-Type"] == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        if len(payload) != n or sha1_base32(payload) != digest:
                            raise ValueError(f"payload of {f['WARC-Record-ID']} differs from its digest")
                    ids = [int(f[k]) if k in f else None for k in ("X-Source-Id", "X-Refers-To-Source-Id")]
                    yield (
                        ids[0], n, digest, f["WARC-Type"], ids[1], f["WARC-Record-ID"][1:-1],
                        f["WARC-Target-URI"], f["WARC-Date"], payload,
                    )

        yield from packed(out(), schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(
        run,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "record_id string, url string, warc_date string, payload binary",
    )


def pages_to_warc(pages: DataFrame, *, min_revisit_bytes: int = 0, **columns: str) -> DataFrame:
    """Write pages as ARC archives, convert those to WARC archives, and read these back.

    Payloads are the html in UTF-8 (NULL: empty).  Repeated rows are separate
    records.  An empty table gives no rows.  Other columns are not read.
    """
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc, **columns)
    write_warc(convert(read_arc(spark, arc), min_revisit_bytes), warc)
    return read_warc(spark, warc)
