"""WARC archives as a Spark data source.

``spark.read.format("warc")`` plans one partition per archive file, takes predicates on record type and headers, reads
each record's headers first and decodes a payload only for records that pass. Gzip members carry their length in an
extra field (subfield "sl"), so a rejected record is skipped by seeking; members of other writers are inflated through.
``df.write.format("warc")`` writes one gzip member per record, rolls files over at ``max_file_bytes`` and publishes
the files of a job in one manifest, so files of failed or repeated tasks are never read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, EqualNullSafe, EqualTo, In,
                                    InputPartition, IsNotNull, IsNull, StringStartsWith, WriterCommitMessage)

from ..session import scratch

#: Column name -> header it shows. These columns take predicates.
HEADERS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
    "warc_date": "WARC-Date", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest",
    "content_type": "Content-Type", "payload_length": "X-Payload-Length",
}
SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + ", payload binary, digest_valid boolean, file string, position long"
ARROW = pa.schema([*((c, pa.string()) for c in HEADERS), ("payload", pa.binary()), ("digest_valid", pa.bool_()), ("file", pa.string()),
                   ("position", pa.int64())])
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAX_FILE_BYTES = 64 << 20
_GZIP, _GZIP_SIZE = "<2sBBIBBH2sHII", 24  # fixed part, length of extra, "sl", its size, compressed and plain length


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(plain: bytes) -> bytes:
    """One gzip member with its own length in the header."""
    z = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = z.compress(plain) + z.flush()
    total = _GZIP_SIZE + len(body) + 8
    return (struct.pack(_GZIP, b"\x1f\x8b", 8, 4, 0, 0, 255, 12, b"sl", 8, total, len(plain)) + body
            + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF))


def record(fields: dict[str, str | None], block: bytes) -> bytes:
    """Header lines and block of one record; line breaks inside a value become spaces."""
    lines = ["WARC/1.1", *(f"{k}: {' '.join(v.split())}" for k, v in fields.items() if v is not None),
             f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Inflate:
    """Bytes of one record, from a gzip member or a plain file, asked for piece by piece."""

    def __init__(self, handle, at: int):
        self.handle, self.at = handle, at
        handle.seek(at)
        head = handle.read(_GZIP_SIZE)
        self.gzip = head[:2] == b"\x1f\x8b"
        self.length = None
        if self.gzip and len(head) == _GZIP_SIZE and head[3] == 4 and head[12:14] == b"sl":
            self.length = struct.unpack(_GZIP, head)[9]
        self.z = zlib.decompressobj(31) if self.gzip else None
        handle.seek(at)
        self.got = b""
        self.read_to = at

    def more(self, size: int = 1 << 14) -> bool:
        if self.z is not None and self.z.eof:
            return False
        raw = self.handle.read(size)
        if not raw:
            return False
        self.read_to += len(raw)
        self.got += self.z.decompress(raw) if self.z is not None else raw
        return True

    def until(self, n: int) -> bytes:
        while len(self.got) < n and self.more(max(1 << 14, n - len(self.got))):
            pass
        return self.got[:n]

    def header(self) -> bytes | None:
        while (k := self.got.find(b"\r\n\r\n")) < 0:
            if not self.more(1 << 12):
                return None
        return self.got[:k + 4]

    def next_at(self, plain_length: int) -> int:
        """Where the next record begins."""
        if not self.gzip:
            return self.at + plain_length
        if self.length is not None:
            return self.at + self.length
        while not self.z.eof and self.more():
            self.got = self.got[:0] if len(self.got) > plain_length else self.got
        return self.read_to - len(self.z.unused_data)


def read_records(handle, accept=None, payloads: bool = True) -> Iterator[tuple[dict[str, str], bytes | None, int]]:
    """(headers, payload or None, position) of every record whose headers ``accept``."""
    size, at = handle.size(), 0
    while at < size:
        r = _Inflate(handle, at)
        head = r.header()
        if head is None:
            return
        fields = {}
        for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
            name, sep, value = line.partition(":")
            if sep:
                fields[name.strip()] = value.strip()
        length = int(fields.get("Content-Length", 0))
        if accept is None or accept(fields):
            payload = None
            if payloads:
                payload = r.until(len(head) + length)[len(head):]
                if fields.get("Content-Type", "").startswith("application/http"):
                    payload = payload.partition(b"\r\n\r\n")[2]
            yield fields, payload, at
        at = r.next_at(len(head) + length + 4)


class WarcDataSource(DataSource):
    """Options: path; payloads (default true), false leaves every payload undecoded; max_file_bytes for writing."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options["path"], self.options.get("payloads", "true").lower() != "false")

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return WarcWriter(self.options["path"], int(self.options.get("max_file_bytes", MAX_FILE_BYTES)), overwrite)


@dataclass
class _File(InputPartition):
    path: str


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payloads: bool):
        self.path, self.payloads = path, payloads
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in HEADERS and isinstance(f, (EqualTo, EqualNullSafe)) and f.value is not None:
                self.tests.append(("in", HEADERS[column], (f.value,)))
            elif column in HEADERS and isinstance(f, In):
                self.tests.append(("in", HEADERS[column], tuple(v for v in f.value if v is not None)))
            elif column in HEADERS and isinstance(f, (IsNotNull, IsNull)):
                self.tests.append(("set" if isinstance(f, IsNotNull) else "unset", HEADERS[column], None))
            elif column in HEADERS and isinstance(f, StringStartsWith):
                self.tests.append(("prefix", HEADERS[column], f.value))
            else:
                yield f

    def accept(self, fields: dict[str, str]) -> bool:
        for kind, header, value in self.tests:
            have = fields.get(header)
            ok = {"set": have is not None, "unset": have is None}.get(kind)
            if ok is None:
                ok = have is not None and (have in value if kind == "in" else have.startswith(value))
            if not ok:
                return False
        return True

    def partitions(self):
        fs, root = open_fs(self.path)
        files = [f for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)) if f.is_file]
        manifests = [f for f in files if f.base_name.startswith("_committed-")]
        if manifests:
            names = set()
            for m in manifests:
                with fs.open_input_stream(m.path) as s:
                    names.update(json.loads(s.read().decode()))
            chosen = [f"{root}/{n}" for n in sorted(names)]
        else:
            chosen = sorted(f.path for f in files if f.base_name.endswith((".warc", ".warc.gz")))
        return [_File(p) for p in chosen] or [_File("")]

    def read(self, partition: _File):
        if not partition.path:
            return
        fs, _ = open_fs(self.path)
        held: list[tuple] = []
        size = 0
        with fs.open_input_file(partition.path) as handle:
            for fields, payload, at in read_records(handle, self.accept, self.payloads):
                stated, valid = fields.get("WARC-Payload-Digest"), None
                if payload is not None and stated is not None and fields.get("WARC-Type") != "revisit":
                    valid = stated.removeprefix("sha1:") == base32_sha1(payload)
                held.append((*(fields.get(h) for h in HEADERS.values()), payload, valid, partition.path, at))
                size += len(payload or b"")
                if len(held) >= 512 or size >= 8 << 20:
                    yield _batch(held)
                    held, size = [], 0
        if held:
            yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), ARROW.types, strict=True)], schema=ARROW)


@dataclass
class _Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceWriter):
    """Rows: the header columns that are present, and payload (binary). A revisit row is written without payload."""

    def __init__(self, path: str, max_file_bytes: int, overwrite: bool):
        self.path, self.limit, self.overwrite = path, max_file_bytes, overwrite

    def write(self, rows) -> _Written:
        fs, root = open_fs(self.path)
        fs.create_dir(root, recursive=True)
        names, out, size = [], None, 0
        for row in rows:
            r = row.asDict()
            if out is None:
                names.append(f"records-{uuid.uuid4().hex}.warc.gz")
                out, size = fs.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
            payload = bytes(r.get("payload") or b"")
            fields = {HEADERS[c]: r.get(c) for c in HEADERS if c in r}
            fields["Content-Type"] = r.get("content_type") or "application/http; msgtype=response"
            if r.get("record_type") == "revisit":
                fields["WARC-Profile"] = REVISIT_PROFILE
                block = b""
            else:
                block = HTTP % len(payload) + payload if fields["Content-Type"].startswith("application/http") else payload
            if "payload_length" not in r:
                fields["X-Payload-Length"] = str(len(payload))
            if "payload_digest" not in r:
                fields["WARC-Payload-Digest"] = f"sha1:{base32_sha1(payload)}"
            size += out.write(member(record(fields, block)))
            if size >= self.limit:
                out.close()
                out = None
        if out is not None:
            out.close()
        return _Written(names)

    def commit(self, messages) -> None:
        fs, root = open_fs(self.path)
        fs.create_dir(root, recursive=True)
        if self.overwrite:
            for f in fs.get_file_info(pafs.FileSelector(root)):
                if f.base_name.startswith("_committed-"):
                    fs.delete_file(f.path)
        with fs.open_output_stream(f"{root}/_committed-{uuid.uuid4().hex}") as s:
            s.write(json.dumps([n for m in messages if m is not None for n in m.names]).encode())

    def abort(self, messages) -> None:
        """Unpublished files are never read."""


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def archive_pages(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Writes a record per page (page_id, url, html): html in UTF-8 is the payload, null means empty.

    Of pages with equal payloads of ``min_bytes`` or more, the largest page_id is stored as a response and the others
    as revisits of it; smaller ones are all responses. Pages that repeat the largest id are responses too, and so are
    copies when no id is known. Extra columns are ignored.
    """
    register(pages.sparkSession)
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        "page_id", F.col("url").alias("target_uri"), html.cast("binary").alias("payload"),
        F.sha1(html.cast("binary")).alias("sha1"))
    largest = rows.groupBy("sha1").agg(F.max("page_id").alias("first"))
    out = rows.join(largest, "sha1")
    small = F.length("payload") < F.lit(min_bytes)
    again = ~small & F.coalesce(F.col("page_id") != F.col("first"), F.col("first").isNotNull())
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    out.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"), urn(F.col("page_id")).alias("record_id"),
        "target_uri", F.when(again, urn(F.col("first"))).alias("refers_to"), "payload",
    ).write.format("warc").mode("append").save(path)


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payloads", str(payloads).lower()).load(path)


def pages_of(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of an archive written by ``archive_pages``.

    Responses are decoded and measured anew; for revisits the headers are enough and no payload is decoded.
    """
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1)
    long_of = lambda c: F.when(page(c) != "", page(c).cast("long"))
    digest = F.regexp_replace("payload_digest", "^sha1:", "")
    responses = read_archive(spark, path).where(F.col("record_type") == "response")
    revisits = read_archive(spark, path, payloads=False).where(F.col("record_type") == "revisit")
    checked = F.when(F.col("digest_valid"), digest)
    return responses.select(
        long_of(F.col("record_id")).alias("page_id"), F.length("payload").cast("long").alias("payload_bytes"),
        checked.alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"),
    ).unionByName(revisits.select(
        long_of(F.col("record_id")).alias("page_id"), F.col("payload_length").cast("long").alias("payload_bytes"),
        digest.alias("payload_digest"), "record_type", long_of(F.col("refers_to")).alias("refers_to")))


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    spark = pages.sparkSession
    path = path or scratch(spark, "warc")
    archive_pages(pages, path)
    return pages_of(spark, path)
