"""WARC archives as a Spark data source (operator 8).

``spark.read.format("warc")`` plans partitions from the archive files and their sizes (a
large file is dealt in byte ranges; a record belongs to the range its first byte is in),
takes predicates on the record type and other header columns (tests of ``read_archives``, or
``where`` on a frame loaded with ``pushWhere``), parses a record's headers
first and inflates its payload only where the record passes and a payload is asked for
(a schema without ``payload`` never decodes one). Records are gzip members whose ``sl``
extra field holds the member's length, so an unwanted record is stepped over. Archives
without that field, members that hold many records (a whole file in one member, too) and plain
archives are read as well; one that ends within a record raises an error.

``df.write.format("warc").mode("append").save(folder)`` writes one file per task under a
name of its own attempt; the commit lists the files of the tasks that succeeded in a
manifest, and only those are read, so lost executors leave at most unused files.

Folders are opened with pyarrow's file systems, so they can be in any store it reads; s3a:// is
read as s3://.

Defined cases: null html is an empty payload; null page_id or url gives a record without
that header; equal payloads of at least ``MIN_DUPLICATE`` bytes are stored once, under the
largest page_id (repeated rows with that page_id are responses all); an empty table writes
no file and reads back as no rows.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition,
                                    IsNotNull, StringStartsWith, WriterCommitMessage)

from .common import open_fs, scratch_path, ship

MIN_DUPLICATE = 1000
SPLIT_BYTES = 64 << 20
HEAD_BYTES = 2048
FIELDS = ("record_type string, record_id string, target_uri string, warc_date string, page_id long, refers_to long, "
          "payload_digest string, payload_bytes long")
PAYLOAD = ", payload binary"
# header field -> column, as they appear in records
COLUMN = {"warc-type": "record_type", "warc-record-id": "record_id", "warc-target-uri": "target_uri",
          "warc-date": "warc_date", "warc-page-id": "page_id", "warc-refers-to-page-id": "refers_to",
          "warc-payload-digest": "payload_digest", "warc-payload-length": "payload_bytes"}
NUMBERS = {"page_id", "refers_to", "payload_bytes"}


# --- one record ------------------------------------------------------------------------
def member(data: bytes) -> bytes:
    """A gzip member with its own length and the data's length in an ``sl`` extra field."""
    c = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = c.compress(data) + c.flush()
    size = 10 + 2 + 12 + len(body) + 8
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size, len(data))
            + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF))


def record(row: dict) -> bytes:
    """The uncompressed WARC record of one row of ``archive_rows``."""
    revisit = row["record_type"] == "revisit"
    payload = b"" if revisit else row["payload"]
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n"
             ).encode() + payload
    head = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", row["warc_date"]),
            ("WARC-Target-URI", row["target_uri"]), ("WARC-Page-ID", row["page_id"]),
            ("WARC-Payload-Digest", row["payload_digest"]), ("WARC-Payload-Length", row["payload_bytes"]),
            ("WARC-Refers-To-Page-ID", row["refers_to"]),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
            ("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block))]
    lines = "".join(f"{k}: {clean(v)}\r\n" for k, v in head if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def clean(value) -> str:
    """A header value on one line."""
    return re.sub(r"[\r\n]+", " ", str(value))


def parse_head(raw: bytes) -> dict:
    """Columns from a record's header lines; ``_length`` is the block's length."""
    out = {}
    for line in raw.split(b"\r\n")[1:]:
        name, _, value = line.decode("utf-8", "replace").partition(":")
        name, value = name.strip().lower(), value.strip()
        if name == "content-length":
            out["_length"] = int(value)
        elif col := COLUMN.get(name):
            out[col] = int(value) if col in NUMBERS else value.removeprefix("sha1:") if col == "payload_digest" else value
    return out


# --- reading -----------------------------------------------------------------------------
@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int


class WarcReader(DataSourceReader):
    def __init__(self, folder: str, schema, split: int, tests: list):
        self.folder, self.names, self.split, self.tests = folder, schema.names, split, tests

    def partitions(self):
        fs, base = open_fs(self.folder)
        from pyarrow import fs as pafs
        found = fs.get_file_info(pafs.FileSelector(base, recursive=False, allow_not_found=True))
        listed = [f for f in found if f.base_name.startswith("_manifest-")]
        if listed:
            names = []
            for f in listed:
                with fs.open_input_stream(f.path) as s:
                    names += json.loads(s.read())["files"]
            sizes = {f.base_name: f.size for f in found}
            files = [(f"{base}/{n}", sizes[n]) for n in names]
        else:
            files = [(f.path, f.size) for f in found if re.search(r"\.warc(\.gz)?$", f.base_name)]
        return [Range(p, a, min(a + self.split, n)) for p, n in files for a in range(0, n, self.split)]

    def wanted(self, head: dict) -> bool:
        for name, kind, value in self.tests:
            v = head.get(name)
            if v is None or kind == "eq" and v != value or kind == "in" and v not in value \
                    or kind == "starts" and not v.startswith(value):
                return False
        return True

    def read(self, part: Range | None):
        if part is None:        # Spark's single task for a folder without archives
            return
        fs, _ = open_fs(self.folder)
        payload = "payload" in self.names
        with fs.open_input_file(part.path) as f:
            source = members if part.path.endswith(".gz") else plain
            for head, block in source(f, part.start, part.end):
                if not self.wanted(head):
                    continue
                if payload:
                    body = block()
                    head["payload"] = body.partition(b"\r\n\r\n")[2] if body.startswith(b"HTTP/") else body
                yield tuple(head.get(n) for n in self.names)


class FilteringReader(WarcReader):
    """The reader that also takes the filters of ``where`` from Spark. Spark keeps them with the
    loaded frame: used again without a filter, or with two filters in one plan, that frame gives the
    wrong records. So it is only taken on request, for a frame that is loaded for one use."""

    def pushFilters(self, filters):
        """Take equality, membership, prefix and not-null tests on header columns."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            kind = {EqualTo: "eq", In: "in", StringStartsWith: "starts", IsNotNull: "some"}.get(type(f))
            if kind and name in COLUMN.values():
                self.tests.append((name, kind, getattr(f, "value", None)))
            else:
                yield f


def members(f, start: int, end: int):
    """(headers, function that returns the block) of the records in the gzip members that start
    in a range. A member that says its length and holds one record is stepped over where it is
    not wanted; any other is inflated in passing, record after record."""
    size = f.size()
    at = next_start(f, start, size, lambda raw: inflate(raw, 16).startswith(b"WARC/"), b"\x1f\x8b\x08") if start else 0
    while at < min(end, size):
        raw = f.read_at(min(HEAD_BYTES, size - at), at)
        packed, unpacked = member_lengths(raw)
        if at + packed > size:
            raise cut_off(at)
        have, grow = inflate(raw, 1 << 16) if packed else b"", HEAD_BYTES
        while packed and b"\r\n\r\n" not in have and grow < min(packed, 1 << 26):
            grow *= 4
            have = inflate(f.read_at(min(grow, packed), at), grow * 8)
        lines, found, _ = have.partition(b"\r\n\r\n")
        head = parse_head(lines)
        n = head.get("_length", 0)
        if not found or unpacked > len(lines) + 4 + n + 4:
            stream = Member(f, at, size)
            yield from stream.records()
            at = stream.end()
            continue

        def block(at=at, packed=packed, skip=len(lines) + 4, n=n):
            z = zlib.decompressobj(31)
            data = z.decompress(f.read_at(packed, at))
            if not z.eof or len(data) < skip + n:
                raise cut_off(at)
            return data[skip:skip + n]

        yield head, block
        at += packed


class Member:
    """The records of one gzip member in turn; only what is asked for is kept."""

    def __init__(self, f, at: int, size: int):
        self.f, self.start, self.at, self.size = f, at, at, size
        self.z, self.have = zlib.decompressobj(31), b""

    def more(self) -> bool:
        """Inflate a little further; False at the member's end."""
        if self.z.eof:
            return False
        raw = self.z.unconsumed_tail
        if not raw:
            raw = self.f.read_at(min(1 << 16, self.size - self.at), self.at)
            self.at += len(raw)
            if not raw:
                raise cut_off(self.start)
        self.have += self.z.decompress(raw, 1 << 20)
        return True

    def take(self, n: int, keep: bool) -> bytes:
        got = []
        while n > len(self.have):
            n -= len(self.have)
            if keep:
                got.append(self.have)
            self.have = b""
            if not self.more():
                raise cut_off(self.start)
        got.append(self.have[:n])
        self.have = self.have[n:]
        return b"".join(got) if keep else b""

    def records(self):
        while True:
            self.have = self.have.lstrip(b"\r\n")
            if not self.have:
                if self.more():
                    continue
                return
            while b"\r\n\r\n" not in self.have:
                if not self.more():
                    raise cut_off(self.start)
            lines, _, self.have = self.have.partition(b"\r\n\r\n")
            head, left = parse_head(lines), []
            left.append(head.get("_length", 0))
            yield head, lambda: self.take(left.pop(), True)
            if left:
                self.take(left.pop(), False)

    def end(self) -> int:
        """Where the next member starts."""
        return self.at - len(self.z.unused_data)


def cut_off(at: int) -> ValueError:
    return ValueError(f"the archive is cut off in the record at byte {at}")


def plain(f, start: int, end: int):
    """The same of an uncompressed archive."""
    size = f.size()
    at = next_start(f, start, size, lambda raw: re.match(rb"WARC/1\.\d\r\n", raw), b"WARC/1.") if start else 0
    while at < min(end, size):
        grow, have = HEAD_BYTES, b""
        while b"\r\n\r\n" not in have and len(have) < size - at:
            have = f.read_at(min(grow, size - at), at)
            grow *= 4
        raw, found, _ = have.partition(b"\r\n\r\n")
        if not have.strip():
            return
        head = parse_head(raw)
        body, n = at + len(raw) + 4, head.get("_length", 0)
        if not found or body + n > size:
            raise cut_off(at)
        yield head, lambda body=body, n=n: f.read_at(n, body)
        at = body + n + 4


def next_start(f, at: int, size: int, is_record, magic: bytes) -> int:
    """The first record that starts at or after a place."""
    while at < size:
        raw = f.read_at(min(1 << 20, size - at), at)
        k = raw.find(magic)
        while k >= 0:
            if is_record(f.read_at(min(HEAD_BYTES, size - at - k), at + k)):
                return at + k
            k = raw.find(magic, k + 1)
        at += max(1, len(raw) - len(magic) + 1)
    return size


def inflate(raw: bytes, limit: int) -> bytes:
    """What the first bytes of a member inflate to; nothing where they are none."""
    try:
        return zlib.decompressobj(31).decompress(raw, limit)
    except zlib.error:
        return b""


def member_lengths(raw: bytes) -> tuple[int, int]:
    """The member's length and its data's from its ``sl`` field; zeros if it has none."""
    if len(raw) < 24 or not raw[3] & 4:
        return 0, 0
    at, end = 12, 12 + struct.unpack_from("<H", raw, 10)[0]
    while at + 4 <= min(end, len(raw)):
        name, n = struct.unpack_from("<2sH", raw, at)
        if name == b"sl" and n == 8:
            return struct.unpack_from("<II", raw, at + 4)
        at += 4 + n
    return 0, 0


# --- writing -------------------------------------------------------------------------------
@dataclass
class Written(WriterCommitMessage):
    file: str | None


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, folder: str):
        self.folder = folder

    def write(self, batches):
        fs, base = open_fs(self.folder)
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        out = None
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    fs.create_dir(base, recursive=True)
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                out.write(member(record(row)))
        if out is not None:
            out.close()
        return Written(name if out is not None else None)

    def commit(self, messages):
        fs, base = open_fs(self.folder)
        fs.create_dir(base, recursive=True)
        with fs.open_output_stream(f"{base}/_manifest-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps({"files": [m.file for m in messages if m and m.file]}).encode())

    def abort(self, messages):
        fs, base = open_fs(self.folder)
        for m in messages:
            if m and m.file:
                fs.delete_file(f"{base}/{m.file}")


def check_tests(tests) -> list:
    for name, kind, value in tests:
        if name not in COLUMN.values() or kind not in ("eq", "in", "starts", "some"):
            raise ValueError(f"no test of a header: {name} {kind} {value}")
    return list(tests)


class WarcSource(DataSource):
    """Options: path; splitBytes (bytes of an archive that one task reads); tests (a JSON list of
    [header column, eq | in | starts | some, value] that records have to pass); pushWhere (true:
    filters of ``where`` reach the reader, see ``FilteringReader``)."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return FIELDS + PAYLOAD

    def reader(self, schema):
        kind = FilteringReader if self.options.get("pushwhere", "false").lower() == "true" else WarcReader
        return kind(self.options["path"], schema, int(self.options.get("splitbytes", SPLIT_BYTES)),
                    check_tests(json.loads(self.options.get("tests", "[]"))))

    def writer(self, schema, overwrite):
        return WarcWriter(self.options["path"])


def register(spark) -> None:
    """Make the format known to a session, with filter pushdown on for ``pushWhere``."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# --- pages ---------------------------------------------------------------------------------
def archive_rows(pages: DataFrame) -> DataFrame:
    """One record per page: the columns of ``FIELDS`` and the payload (null for revisits).

    Digests that come more than once are counted before any page is moved; pages then meet
    them in a join whose hot digests Spark can split."""
    p = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("target_uri"),
        F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload"))
    p = p.withColumn("payload_digest", F.sha1("payload")).withColumn("payload_bytes", F.length("payload").cast("long"))
    copies = (p.where(F.col("payload_bytes") >= MIN_DUPLICATE).groupBy("payload_digest")
              .agg(F.max("page_id").alias("first_copy"), F.count("*").alias("n")).where("n > 1").drop("n"))
    p = p.join(copies, "payload_digest", "left")
    revisit = F.coalesce(F.col("first_copy") != F.col("page_id"), F.col("first_copy").isNotNull())
    return p.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.format_string("<urn:uuid:%s>", F.regexp_replace(
            F.md5(F.concat_ws("|", F.col("page_id").cast("string"), F.col("target_uri"), F.col("payload_digest"))),
            "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5")).alias("record_id"),
        "target_uri", F.lit("2024-01-01T00:00:00Z").alias("warc_date"), "page_id",
        F.when(revisit, F.col("first_copy")).alias("refers_to"),
        F.concat(F.lit("sha1:"), F.col("payload_digest")).alias("payload_digest"), "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"))


def write_archives(pages: DataFrame, folder: str) -> None:
    register(pages.sparkSession)
    archive_rows(pages).write.format("warc").mode("append").save(folder)


def read_archives(spark, folder: str, payload: bool = True, tests=()) -> DataFrame:
    """The records whose headers pass all ``tests``, such as ``("record_type", "eq", "response")``,
    ``("page_id", "in", [4, 5])``, ``("target_uri", "starts", "https://a.org/")`` or
    ``("refers_to", "some", None)``; the payloads of others are never inflated."""
    register(spark)
    read = spark.read.format("warc").schema(FIELDS + (PAYLOAD if payload else ""))
    return read.option("tests", json.dumps(check_tests(tests))).load(folder)


def op8_warc(spark, sf_dir) -> DataFrame:
    """Pages written to archives and read back: headers of all records, and the payload of
    responses, whose length and digest are taken again from the bytes that were read."""
    folder = scratch_path(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    out = read_archives(spark, folder)
    full = F.col("record_type") == "response"
    return out.select(
        "page_id", F.when(full, F.length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(full, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", "refers_to")


SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {MIN_DUPLICATE} AND last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {MIN_DUPLICATE} AND last <> page_id THEN last END AS refers_to FROM m
"""
