"""Operator 10: web archives (WARC) packed in ZIP files, read by range without extraction.

An archive is a ZIP file whose members are all stored, not compressed:

    archive/data.warc.gz   WARC records, each a gzip member of its own
    indexes/index.cdx      a line for each record: key, offset and length in data.warc.gz

``ArchiveReader`` reads the end of the file, the ZIP64 locator and end record where there
are any, and the central directory; a member's bytes lie behind its local header, so any
record is one range read at (member's place + offset of the index). Nothing is unpacked
but the record itself. The reader takes archives of other writers as well: it needs
members with method 0 only, and accepts a preamble and a comment.

Writing is one narrow pass: each task writes archives of up to ``ARCHIVE_BYTES`` as its
rows come, so memory is bounded by one record and the index of one archive. Which records
are responses is decided before, by payload digest: groups of copies are combined on
each side of the shuffle, and the join to them may be split where a digest is hot.

Edge cases: a null payload is empty, a null url gives no target header; rows with the same
page_id and payload are all responses; a null page_id is never the smallest (copies whose
ids are all null are all responses); an empty table gives no archives and no rows. Further
columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.llm.common import new_shared_dir, tidy
from casegrid.llm.files import opened, read_at, written

#: An archive is closed once its records fill so many bytes.
ARCHIVE_BYTES = 256 << 20

#: Payloads of at least so many bytes are stored once.
MIN_REVISIT_BYTES = 100

WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdx"

# ZIP structures: signature and fixed part (fixed values of the format)
_LOCAL = struct.Struct("<4sHHHHHIIIHH")
_CENTRAL = struct.Struct("<4sHHHHHHIIIHHHHHII")
_END = struct.Struct("<4sHHHHIIH")
_END64 = struct.Struct("<4sQHHIIQQQQ")
_LOCATOR = struct.Struct("<4sIQI")
_MAX16, _MAX32 = 0xFFFF, 0xFFFFFFFF


class StoredZipWriter:
    """A ZIP of stored members, written front to back; sizes stand in ZIP64 fields and data descriptors, so any size will do."""

    def __init__(self, out: BinaryIO):
        self._out, self._at, self._members = out, 0, []

    def _put(self, data: bytes) -> None:
        self._out.write(data)
        self._at += len(data)

    def begin(self, name: str) -> None:
        raw = name.encode()
        self._open = [raw, self._at, 0, 0]
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._put(_LOCAL.pack(b"PK\3\4", 45, 0x0808, 0, 0, 0x21, 0, _MAX32, _MAX32, len(raw), len(extra)) + raw + extra)

    def write(self, data: bytes) -> None:
        self._put(data)
        self._open[2] += len(data)
        self._open[3] = zlib.crc32(data, self._open[3])

    def end(self) -> None:
        _, _, size, crc = self._open
        self._put(struct.pack("<4sIQQ", b"PK\7\10", crc, size, size))
        self._members.append(tuple(self._open))

    def close(self) -> None:
        start = self._at
        for raw, at, size, crc in self._members:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, at)
            self._put(_CENTRAL.pack(b"PK\1\2", 45, 45, 0x0808, 0, 0, 0x21, crc, _MAX32, _MAX32, len(raw), len(extra), 0, 0, 0, 0, _MAX32) + raw + extra)
        n, length, end64 = len(self._members), self._at - start, self._at
        self._put(_END64.pack(b"PK\6\6", _END64.size - 12, 45, 45, 0, 0, n, n, length, start))
        self._put(_LOCATOR.pack(b"PK\6\7", 0, end64, 1))
        self._put(_END.pack(b"PK\5\6", 0, 0, _MAX16, _MAX16, _MAX32, _MAX32, 0))


@dataclass(frozen=True)
class Member:
    name: str
    header_at: int
    size: int
    method: int


class ArchiveReader:
    """Members of a ZIP file by its central directory, and ranges of stored ones."""

    def __init__(self, f: BinaryIO):
        self._f = f
        f.seek(0, 2)
        self._length = f.tell()
        self.members = {m.name: m for m in self._directory()}
        self._starts: dict[str, int] = {}

    def _directory(self) -> Iterator[Member]:
        tail_at = max(0, self._length - _END.size - _MAX16)
        tail = read_at(self._f, tail_at, self._length - tail_at)
        at = tail.rfind(b"PK\5\6")
        while at >= 0 and at + _END.size + int.from_bytes(tail[at + 20 : at + 22], "little") != len(tail):
            at = tail.rfind(b"PK\5\6", 0, at)
        if at < 0:
            raise ValueError("no end of a central directory")
        _, _, _, _, count, size, start, _ = _END.unpack_from(tail, at)
        end = tail_at + at
        if _MAX16 == count or _MAX32 in (size, start):
            magic, _, end64, _ = _LOCATOR.unpack(read_at(self._f, end - _LOCATOR.size, _LOCATOR.size))
            if magic != b"PK\6\7":
                raise ValueError("no ZIP64 locator")
            head = read_at(self._f, end64, _END64.size)
            if head[:4] != b"PK\6\6":  # what stands before the archive isn't counted in its offsets
                end64 = end - _LOCATOR.size - _END64.size
                head = read_at(self._f, end64, _END64.size)
            count, size, start = _END64.unpack(head)[7:]
            end = end64
        before = end - size - start
        data, at = read_at(self._f, start + before, size), 0
        for _ in range(count):
            (magic, _, _, _, method, _, _, _, packed, plain, n, m, k, _, _, _, header) = _CENTRAL.unpack_from(data, at)
            if magic != b"PK\1\2":
                raise ValueError("no entry of a central directory")
            at += _CENTRAL.size
            name, extra = data[at : at + n], data[at + n : at + n + m]
            at += n + m + k
            wide = iter(self._wide(extra))
            plain = next(wide) if plain == _MAX32 else plain
            packed = next(wide) if packed == _MAX32 else packed
            header = next(wide) if header == _MAX32 else header
            yield Member(name.decode("utf-8", "replace"), header + before, packed if method else plain, method)

    @staticmethod
    def _wide(extra: bytes) -> list[int]:
        at = 0
        while at + 4 <= len(extra):
            kind, length = struct.unpack_from("<HH", extra, at)
            if kind == 1:
                return [x[0] for x in struct.iter_unpack("<Q", extra[at + 4 : at + 4 + length // 8 * 8])]
            at += 4 + length
        return []

    def read(self, name: str, start: int = 0, length: int | None = None) -> bytes:
        """A range of a stored member."""
        m = self.members[name]
        if m.method:
            raise ValueError(f"{name} is not stored")
        if name not in self._starts:
            head = _LOCAL.unpack(read_at(self._f, m.header_at, _LOCAL.size))
            if head[0] != b"PK\3\4":
                raise ValueError(f"{name} has no local header")
            self._starts[name] = m.header_at + _LOCAL.size + head[9] + head[10]
        length = m.size - start if length is None else length
        if start < 0 or length < 0 or start + length > m.size:
            raise ValueError(f"{name} has {m.size} bytes")
        return read_at(self._f, self._starts[name] + start, length)

    def index(self) -> Iterator[tuple[str, int, int]]:
        """(key, offset, length) of each record."""
        for line in self.read(INDEX_MEMBER).decode().splitlines():
            key, start, length = line.rsplit(" ", 2)
            yield key, int(start), int(length)

    def record(self, start: int, length: int) -> tuple[dict[str, str], bytes]:
        """Headers and payload of the record there."""
        unpacker = zlib.decompressobj(31)
        raw = unpacker.decompress(self.read(WARC_MEMBER, start, length))
        if not unpacker.eof or unpacker.unused_data:
            raise ValueError("the range is not one gzip member")
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record")
        headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        block = rest[: int(headers["content-length"])]
        _, _, payload = block.partition(b"\r\n\r\n")
        return headers, payload


def _record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {digest} {revisit}')}>",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}", "Content-Type: application/http;msgtype=response",
    ]
    if url:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page is not None:
        lines.append(f"X-Page-ID: {page}")
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-ID: {refers_to}"]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (b"" if revisit else payload)
    lines.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def with_responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """page_id, url, payload, digest and refers_to: the row's response, or null if it is one itself."""
    p = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("digest", F.sha2("payload", 256))
    copies = p.where(F.octet_length("payload") >= MIN_REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    copies = copies.where("n > 1 AND first IS NOT NULL").select(F.col("digest").alias("of"), "first")
    j = p.join(copies, F.col("digest") == F.col("of"), "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return j.select("page_id", "url", "payload", "digest", F.when(again, F.col("first")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives of the rows of ``with_responses``; a row for each: path, records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made, rows = TaskContext.get().partitionId(), 0, ((x for b in batches for x in zip(*(c.to_pylist() for c in b.columns), strict=True)))
        row = next(rows, None)
        while row is not None:
            name, index, at = f"part-{part:06d}-{made:04d}.zip", [], 0
            with written(folder, name) as out:
                z = StoredZipWriter(out)
                z.begin(WARC_MEMBER)
                while row is not None and at < archive_bytes:
                    page, url, payload, digest, refers_to = row
                    data = _record(page, url, payload, digest, refers_to, refers_to is not None)
                    z.write(data)
                    index.append(f"{'-' if page is None else page} {at} {len(data)}\n")
                    at += len(data)
                    row = next(rows, None)
                z.end()
                z.begin(INDEX_MEMBER)
                z.write("".join(index).encode())
                z.end()
                z.close()
            made += 1
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([len(index)], pa.int64())], names=["path", "records"])

    return records.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(tidy(run), "path string, records long")


def read_archives(spark: SparkSession, paths: list[str] | DataFrame, batch_records: int = 64) -> DataFrame:
    """All records of archives: page_id, url, record_type, payload, payload_digest, payload_bytes, refers_to."""
    schema = "page_id long, url string, record_type string, payload binary, payload_digest string, payload_bytes long, refers_to long"
    kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.int64()]
    names = [x.split()[0] for x in schema.split(", ")]
    found = paths if isinstance(paths, DataFrame) else spark.createDataFrame([(p,) for p in paths], "path string")

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for b in batches for p in b.column(0).to_pylist()):
            rows = []
            with opened(path) as f:
                archive = ArchiveReader(f)
                for _, start, length in archive.index():
                    headers, payload = archive.record(start, length)
                    response = headers["warc-type"] == "response"
                    digest = hashlib.sha256(payload).hexdigest() if response else headers["warc-payload-digest"].partition(":")[2]
                    if response and headers["warc-payload-digest"] != f"sha256:{digest}":
                        raise ValueError(f"{path}: a payload does not have its digest")
                    page, other = headers.get("x-page-id"), headers.get("x-refers-to-page-id")
                    rows.append((
                        None if page is None else int(page), headers.get("warc-target-uri"), headers["warc-type"], payload if response else None, digest,
                        len(payload) if response else int(headers["x-payload-length"]), None if other is None else int(other)))
                    if len(rows) >= batch_records:
                        yield batch(rows)
                        rows = []
            if rows:
                yield batch(rows)

    return found.select("path").mapInArrow(tidy(run), schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes the pages' archives at once, and returns what is read back from them."""
    spark = pages.sparkSession
    folder = new_shared_dir(spark, "warc")
    # the list of archives is a table as well, as long as there are archives
    listing = new_shared_dir(spark, "warc-list")
    write_archives(with_responses(pages), folder).write.parquet(listing)
    made = spark.read.schema("path string, records long").parquet(listing)
    n = max(1, made.count())
    back = read_archives(spark, made.repartition(n, "path") if n > 1 else made)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT CAST(page_id AS BIGINT) AS page_id, COALESCE(html, '') AS html, sha256(COALESCE(html, '')) AS digest FROM pages),
f AS (SELECT digest, MIN(page_id) AS first FROM p WHERE strlen(html) >= 100 GROUP BY digest)
SELECT p.page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN first IS NULL OR first IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest
"""
