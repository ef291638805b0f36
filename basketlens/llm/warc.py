"""Legacy archive converter: ARC files to WARC files.

An ARC file starts with a version block (``filedesc://``) whose second line gives the version. Version 1
header lines are ``URL IP date type length``; version 2 has ``URL IP date type status checksum location
offset filename length``. Records follow one another by their declared lengths; nothing is searched
for inside a payload. Every record becomes a WARC/1.1 record: the identifier is a name-based UUID of
type, key, URL, date and payload digest, the 14-digit date an ISO time, the type ``response`` or ``revisit``
and the digests SHA-256 of payload and block. A payload of at least ``MIN_REVISIT`` bytes that an earlier
record (by key) has too is a revisit of that one and is not stored again.

Archives are files of one string each, written and read by Spark's own text and binary sources, so any
file system will do. A task packs at most ``ARCHIVE_BYTES`` into an archive, or one longer record.

Defined results: a null html is an empty payload, a null URL ``urn:page:<id>``; spaces and line ends in
a URL are escaped; pages with a null id are responses with an empty key, as nothing could refer to them;
rows of one id with different payloads are judged each by its own payload; repeated rows (one id, URL and
payload) are captures of their own under one identifier, none a revisit of the other; an empty table gives
no archive; other columns are ignored. A record whose declared length runs beyond its file raises an error.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.session import scratch_path
from basketlens.sources.writers import staged

ARCHIVE_BYTES = 8 << 20
MIN_REVISIT = 100
KEY = "X-Page-Id"
DATE = "20240229120000"
END = "\r\n\r\n"


@dataclass(frozen=True)
class ArcRecord:
    url: str
    ip: str
    date: str
    mime: str
    status: int | None
    block: bytes


def arc_file(name: str, version: int, records: list[ArcRecord]) -> bytes:
    """An ARC file of the given version."""
    fields = {
        1: "URL IP-address Archive-date Content-type Archive-length",
        2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
    }[version]
    head = f"{version} {0 if version == 1 else 1} Archive\n{fields}\n".encode()
    first = f"filedesc://{name} 0.0.0.0 {DATE} text/plain"
    first += f" {len(head)}\n" if version == 1 else f" 200 - - 0 {name} {len(head)}\n"
    out = bytearray(first.encode() + head + b"\n")
    for r in records:
        line = f"{r.url} {r.ip} {r.date} {r.mime}"
        if version == 2:
            line += f" {r.status or 200} - - {len(out)} {name}"
        out += f"{line} {len(r.block)}\n".encode() + r.block + b"\n"
    return bytes(out)


def read_arc(data: bytes) -> Iterator[ArcRecord]:
    """The records of an ARC file after its version block."""
    at, version = 0, None
    while at < len(data):
        if data[at:at + 1] == b"\n":  # the separator after a record
            at += 1
            continue
        end = data.index(b"\n", at)
        parts = data[at:end].decode("utf-8").split(" ")
        length = int(parts[-1])
        block = data[end + 1:end + 1 + length]
        if len(block) < length:
            raise ValueError(f"record at byte {at}: {length} bytes declared, {len(block)} there")
        at = end + 1 + length
        if version is None:
            version = int(block.split(b" ", 1)[0])
            continue
        if len(parts) != (5 if version == 1 else 10):
            raise ValueError(f"header line of {len(parts)} fields in a version {version} file")
        yield ArcRecord(parts[0], parts[1], parts[2], parts[3], int(parts[4]) if version == 2 else None, block)


def http_parts(block: bytes) -> tuple[bytes, bytes]:
    head, _, body = block.partition(b"\r\n\r\n")
    return head, body


def http_field(head: bytes, name: str) -> str | None:
    for line in head.decode("latin-1").split("\r\n")[1:]:
        key, _, value = line.partition(":")
        if key.lower() == name.lower():
            return value.strip()
    return None


def _key(head: bytes) -> int | None:
    text = http_field(head, KEY)
    return int(text) if text else None


def iso_time(date: str) -> str:
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(kind: str, key: str | None, url: str, date: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind} {key or str()} {url} {date} {digest}')}>"


def _digest(data: bytes) -> str:
    return "sha256:" + base64.b32encode(hashlib.sha256(data).digest()).decode()


def warc_record(r: ArcRecord, first: tuple[str, str, str, str] | None = None) -> bytes:
    """The WARC record of an ARC record; ``first``: key, URL, date and digest of the record that it
    revisits."""
    head, body = http_parts(r.block)
    digest = hashlib.sha256(body).hexdigest()
    block = r.block if first is None else head + b"\r\n\r\n"
    kind = "response" if first is None else "revisit"
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(kind, http_field(head, KEY), r.url, r.date, digest)),
        ("WARC-Date", iso_time(r.date)),
        ("WARC-Target-URI", r.url),
        ("WARC-IP-Address", r.ip),
        ("WARC-Payload-Digest", _digest(body)),
        ("WARC-Block-Digest", _digest(block)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if first is not None:
        key, url, date, of = first
        fields[2:2] = [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id("response", key, url, date, of)),
            ("WARC-Refers-To-Target-URI", url),
            ("WARC-Refers-To-Date", iso_time(date)),
            ("X-Refers-To-Page-Id", key),
            ("X-Payload-Length", str(len(body))),
        ]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record, by declared lengths."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record at byte {at}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        length = int(fields["Content-Length"])
        block = data[end + 4:end + 4 + length]
        if len(block) < length or data[end + 4 + length:end + 8 + length] != END.encode():
            raise ValueError(f"record at byte {at} does not end where it says")
        yield fields, block
        at = end + 8 + length


def _url(url: str | None, page: int | None) -> str:
    text = f"urn:page:{'' if page is None else page}" if not url else url
    return "".join(c if c > " " and c != "\x7f" and not c.isspace() else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def pages_to_arc(pages: DataFrame) -> DataFrame:
    """``archive`` and ``content``: ARC files of the pages, both versions in turn."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, 0
        for batch in batches:
            for page, url, html in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                body = (html or "").encode()
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{KEY}: {'' if page is None else page}\r\nContent-Length: {len(body)}\r\n\r\n"
                held.append(ArcRecord(_url(url, page), "192.0.2.1", DATE, "text/html", 200, head.encode() + body))
                size += len(body) + len(head)
                if size > ARCHIVE_BYTES:
                    yield _archive(held, number)
                    held, size, number = [], 0, number + 1
        if held:
            yield _archive(held, number)

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(read, "archive string, content binary")


def _archive(records: list[ArcRecord], number: int) -> pa.RecordBatch:
    name = f"{hashlib.md5(records[0].url.encode()).hexdigest()[:12]}-{number}.arc"
    data = arc_file(name, 1 + number % 2 if number else 1 + len(records) % 2, records)
    return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([data], pa.binary())], ["archive", "content"])


def arc_digests(arcs: DataFrame) -> DataFrame:
    """``key``, ``url``, ``date``, ``bytes`` and ``digest`` of every record of ARC files."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                out = []
                for r in read_arc(content.as_py()):
                    head, body = http_parts(r.block)
                    out.append((_key(head), r.url, r.date, len(body), hashlib.sha256(body).hexdigest()))
                yield pa.RecordBatch.from_pylist([dict(zip(SURVEY.names, x, strict=True)) for x in out], SURVEY)

    return arcs.select("content").mapInArrow(read, "key long, url string, date string, bytes long, digest string")


SURVEY = pa.schema([("key", pa.int64()), ("url", pa.string()), ("date", pa.string()), ("bytes", pa.int64()), ("digest", pa.string())])


def revisits(found: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """``key`` and ``digest`` of every record whose payload another one with a smaller key has, and that one."""
    large = found.where((F.col("bytes") >= min_bytes) & F.col("key").isNotNull())
    first = large.groupBy("digest").agg(F.min(F.struct("key", "url", "date")).alias("first"), F.count(F.lit(1)).alias("n"))
    first = staged(first.where("n > 1").select("digest", "first"), "arc-first")
    return large.join(first, "digest").where(F.col("key") != F.col("first.key")).select(
        "key", "digest", F.struct(F.col("first.key"), F.col("first.url"), F.col("first.date"), "digest").alias("first")).distinct()


RECORD = "key long, digest string, url string, ip string, date string, mime string, block binary"


def arc_records(arcs: DataFrame) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for r in read_arc(content.as_py()):
                    head, body = http_parts(r.block)
                    held.append({"key": _key(head), "digest": hashlib.sha256(body).hexdigest(), "url": r.url, "ip": r.ip, "date": r.date, "mime": r.mime, "block": r.block})
                    size += len(r.block)
                    if size > ARCHIVE_BYTES // 4:
                        yield pa.RecordBatch.from_pylist(held, PARTS)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, PARTS)

    return arcs.select("content").mapInArrow(read, RECORD)


PARTS = pa.schema([("key", pa.int64()), *((n, pa.string()) for n in ("digest", "url", "ip", "date", "mime")), ("block", pa.binary())])
INFO = (
    "WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{id}>\r\nWARC-Date: {date}\r\n"
    "Content-Type: application/warc-fields\r\nContent-Length: {n}\r\n\r\n{body}"
)


def warc_files(records: DataFrame) -> DataFrame:
    """``content``: WARC files without the end of their last record; ``records`` may have ``first``."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                first = row["first"] and (str(row["first"]["key"]), row["first"]["url"], row["first"]["date"], row["first"]["digest"])
                data = warc_record(ArcRecord(row["url"], row["ip"], row["date"], row["mime"], None, row["block"]), first)
                held.append(data)
                size += len(data)
                if size > ARCHIVE_BYTES:
                    yield _warc(held)
                    held, size = [], 0
        if held:
            yield _warc(held)

    return records.mapInArrow(read, "content binary")


def _warc(held: list[bytes]) -> pa.RecordBatch:
    body = "format: WARC File Format 1.1\r\nsoftware: basketlens\r\n"
    name = uuid.uuid5(uuid.NAMESPACE_OID, hashlib.sha256(held[0]).hexdigest())
    info = INFO.format(id=name, date=iso_time(DATE), n=len(body), body=body).encode()
    return pa.RecordBatch.from_arrays([pa.array([END.encode().join([info, *held])], pa.binary())], ["content"])


def convert(arcs: DataFrame, path: str, min_bytes: int = MIN_REVISIT) -> None:
    """Writes the records of ARC files as gzipped WARC files below ``path``."""
    again = revisits(staged(arc_digests(arcs), "arc-survey"), min_bytes)
    records = arc_records(arcs).join(staged(again, "arc-revisits").hint("merge"), ["key", "digest"], "left")
    files = warc_files(records).select(F.col("content").cast("string"))
    # a file for each row; the separator ends its last record
    files.write.option("lineSep", END).option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to`` and the WARC fields
    of every response and revisit below ``path``."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "warc_date"]
    schema = pa.schema([(n, pa.int64() if n in ("page_id", "payload_bytes", "refers_to") else pa.string()) for n in names])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for fields, block in read_warc(gzip.decompress(content.as_py())):
                    kind = fields["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    head, body = http_parts(block)
                    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha256:")).hex()
                    if kind == "response" and hashlib.sha256(body).hexdigest() != digest:
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
                    size = len(body) if kind == "response" else int(fields["X-Payload-Length"])
                    to = fields.get("X-Refers-To-Page-Id")
                    values = (_key(head), size, digest, kind, to and int(to), fields["WARC-Record-ID"], fields["WARC-Date"])
                    rows.append(dict(zip(names, values, strict=True)))
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, warc_date string")


def through_archives(pages: DataFrame) -> DataFrame:
    """Pages as ARC files, those as WARC files, and these read again."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    convert(pages_to_arc(pages), path)
    return read_back(spark, path)


CHECK_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND first <> page_id THEN first END AS refers_to
FROM f
"""
