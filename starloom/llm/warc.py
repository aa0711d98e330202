"""WARC archives: records with revisits for repeated payloads, and a reader that salvages damaged files.

Writing: one gzip member per record, in files of bounded size. Of records with equal payloads of
at least ``MIN_REVISIT`` bytes, that with the smallest page_id is a response; the others are
revisits that name it and keep the payload's digest and length.

Reading goes through a file in bounded pieces and accepts compressed members and plain records.
A record counts if all checks hold: its member's checksum, its version line and header, its
length, its end, and the digest of its payload. After a failed check the reader searches for the
next place where a valid member or version line begins a record that passes, goes on from there,
and reports the bytes in between as quarantined, with the check that failed.

Results for odd rows: a null html is an empty payload; a null url is left out. A null page_id
gets no name; it is a revisit if others with its payload have one. Repeated rows with the
smallest page_id are each a response. An empty table makes no files. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import blocks, parts, small_batches, table, with_group, written
from starloom.llm.files import create, open_seekable
from starloom.sources.workspace import new_folder

MIN_REVISIT = 100
FILE_BYTES = 64 * 1024 * 1024
DATE = "2024-01-01T00:00:00Z"
LEVEL = 1
PIECE = 1 << 20
#: A header longer than this is damage.
MAX_HEADER = 1 << 16

_GZIP = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/\d\.\d\r\n")
_START = re.compile(rb"\x1f\x8b\x08|WARC/\d\.\d\r\n")
_PAGE = re.compile(r"<urn:page:(-?\d+)>")


# --- writing


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record, uncompressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = f"urn:page:{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid4()}"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if refers_to is not None:
            lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    press = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


def with_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest, refers_to, revisit) of every page."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha2(html, 256).alias("digest"))
    long_ = F.octet_length("html") >= MIN_REVISIT
    counted = rows.where(long_).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("m"))
    repeated = written(counted.where("m > 1"), "repeated")
    joined = with_group(rows, repeated, "digest", "m")
    revisit = F.col("first").isNotNull() & F.coalesce(F.col("page_id") != F.col("first"), F.lit(True))
    return joined.select(
        "page_id", "url", "html", "digest", revisit.alias("revisit"), F.when(revisit, F.col("first")).alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the archives; returns (file, n_records), itself a written table."""
    small_batches(pages.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), []
        out: BinaryIO | None = None
        uri, size, n = "", 0, 0
        for rows in blocks(batches, "html"):
            names = ("page_id", "url", "html", "digest", "refers_to", "revisit")
            for page_id, url, html, digest, to, revisit in zip(*(rows.column(c).to_pylist() for c in names), strict=True):
                if out is None:
                    uri, size, n = f"{folder}/pages-{part:06d}-{len(done):04d}-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = create(uri)
                data = member(record(page_id, url, html.encode("utf-8", "surrogatepass"), digest, to, revisit))
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= file_bytes:
                    out.close()
                    done.append((uri, n))
                    out = None
        if out is not None:
            out.close()
            done.append((uri, n))
        if done:
            uris, counts = zip(*done, strict=True)
            yield pa.record_batch([pa.array(uris, pa.string()), pa.array(counts, pa.int64())], ["file", "n_records"])

    return written(with_revisits(pages).mapInArrow(write, "file string, n_records bigint"), "archives")


# --- reading


class Record(NamedTuple):
    offset: int
    kind: str
    name: str
    url: str | None
    refers_to: str | None
    payload: bytes | None  # None for revisits
    payload_bytes: int
    payload_digest: str


class Gap(NamedTuple):
    start: int
    end: int
    reason: str


class Damaged(ValueError):
    """A record fails a check."""


class Bytes:
    """A file's bytes by place, read in pieces."""

    def __init__(self, file: BinaryIO, size: int):
        self.file, self.size, self.base, self.held = file, size, 0, b""

    def at(self, start: int, n: int) -> bytes:
        if not self.base <= start or start + n > self.base + len(self.held):
            self.file.seek(start)
            self.base, self.held = start, self.file.read(max(n, PIECE))
        return self.held[start - self.base : start - self.base + n]

    def find(self, start: int) -> int | None:
        """The next place from ``start`` on where a member or a version line may begin."""
        while start < self.size:
            found = _START.search(self.at(start, PIECE))
            if found:
                return start + found.start()
            if start + PIECE >= self.size:
                return None
            start += PIECE - 16  # a mark may lie across two pieces
        return None


def _unzipped(data: Bytes, start: int) -> tuple[bytes, int]:
    """(content, end) of the gzip member at ``start``."""
    expand, out, at = zlib.decompressobj(31), [], start
    while not expand.eof:
        piece = data.at(at, min(PIECE, data.size - at))
        if not piece:
            raise Damaged("member is cut off")
        try:
            out.append(expand.decompress(piece))
        except zlib.error as error:
            raise Damaged("member checksum or coding") from error
        at += len(piece)
    return b"".join(out), at - len(expand.unused_data)


def _head(text: bytes) -> tuple[dict[str, str], int]:
    """Header fields and the header's length, from a version line on."""
    if not _VERSION.match(text):
        raise Damaged("version line")
    end = text.find(b"\r\n\r\n")
    if end < 0:
        raise Damaged("header end")
    fields = {}
    for line in text[:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not re.fullmatch(r"\d{1,18}", fields.get("content-length", "")):
        raise Damaged("record length")
    return fields, end + 4


def _parsed(fields: dict[str, str], block: bytes, offset: int) -> Record:
    def agrees(name: str, content: bytes) -> str:
        given = fields.get(name, "")
        own = hashlib.sha256(content).hexdigest()
        if given.startswith("sha256:") and given[7:] != own:
            raise Damaged(name.removeprefix("warc-").replace("-", " "))
        return own

    agrees("warc-block-digest", block)
    kind, payload, size = fields.get("warc-type", ""), block, len(block)
    if fields.get("content-type", "").startswith("application/http"):
        head, mark, payload = block.partition(b"\r\n\r\n")
        if not mark:
            raise Damaged("http header")
        size = len(payload)
        length = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", head)
        if kind == "revisit" and length:
            size = int(length[1])
    if kind == "revisit":
        digest, payload = fields.get("warc-payload-digest", "").removeprefix("sha256:"), None
    else:
        digest = agrees("warc-payload-digest", payload)
    return Record(
        offset, kind, fields.get("warc-record-id", ""), fields.get("warc-target-uri"), fields.get("warc-refers-to"),
        payload, size, digest,
    )


def _record_at(data: Bytes, start: int) -> tuple[Record, int]:
    """The record at ``start`` and where it ends; raises ``Damaged`` if a check fails."""
    if data.at(start, 3) == _GZIP:
        content, end = _unzipped(data, start)
        fields, n = _head(content)
        size = int(fields["content-length"])
        if len(content) != n + size + 4 or content[-4:] != b"\r\n\r\n":
            raise Damaged("record length")
        return _parsed(fields, content[n : n + size], start), end
    fields, n = _head(data.at(start, min(MAX_HEADER, data.size - start)))
    size = int(fields["content-length"])
    if start + n + size + 4 > data.size:
        raise Damaged("record is cut off")
    block = data.at(start + n, size + 4)
    if block[-4:] != b"\r\n\r\n":
        raise Damaged("record length")
    return _parsed(fields, block[:-4], start), start + n + size + 4


def salvage(file: BinaryIO, size: int) -> Iterator[Record | Gap]:
    """All records that pass, and the gaps between them, in order of their places."""
    data, at, bad = Bytes(file, size), 0, None
    while at < size:
        try:
            found, end = _record_at(data, at)
        except Damaged as error:
            bad = bad or (at, str(error))
            following = data.find(at + 1)
            at = size if following is None else following
            continue
        if bad:
            yield Gap(bad[0], at, bad[1])
            bad = None
        yield found
        at = end
    if bad:
        yield Gap(bad[0], size, bad[1])


ENTRIES = (
    "file string, start bigint, end bigint, reason string, record_type string, page_id bigint, url string, "
    "refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"
)


def read_archives(files: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record and per quarantined gap (those have a ``reason``) of the archives named in ``file``."""

    def page(name: str | None) -> int | None:
        found = _PAGE.fullmatch(name or "")
        return int(found[1]) if found else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        kinds += [pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = [c.split()[0] for c in ENTRIES.split(", ")]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for given in batches:
            for uri in given.column("file").to_pylist():
                with open_seekable(uri) as file:
                    rows, held = [], 0
                    for x in salvage(file, file.size()):
                        if isinstance(x, Gap):
                            rows.append((uri, x.start, x.end, x.reason, *[None] * 7))
                        else:
                            own = x.payload if payloads else None
                            rows.append((
                                uri, x.offset, None, None, x.kind, page(x.name), x.url, page(x.refers_to), x.payload_bytes,
                                x.payload_digest, own,
                            ))
                            held += len(own or b"")
                        if held > PIECE or len(rows) >= 4096:
                            yield batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield batch(rows)

    spark = files.sparkSession
    return files.select("file").repartition(parts(spark), "file").mapInArrow(read, ENTRIES)


def records(entries: DataFrame) -> DataFrame:
    return entries.where("reason is null")


def quarantined(entries: DataFrame) -> DataFrame:
    """(file, start, end, reason): byte ranges that hold no record that passes."""
    return entries.where("reason is not null").select("file", "start", "end", "reason")


def undamaged(entries: DataFrame) -> DataFrame:
    """The records, for archives that must be whole: a quarantined gap fails the job with its file and place."""
    gap = F.concat_ws(" ", F.lit("damaged archive:"), "file", "start", "end", "reason")
    return entries.where(F.when(F.col("reason").isNull(), F.lit(True)).otherwise(F.raise_error(gap).cast("boolean")))


def op2_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(table(spark, sf_dir, "pages"), new_folder(spark, "warc"))
    return undamaged(read_archives(archives, payloads=False)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE_OP2 = """
WITH p AS (
    SELECT page_id, sha256(coalesce(html, '')) AS d, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), f AS (SELECT d, min(page_id) AS first, count(*) AS m FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
    CASE WHEN m > 1 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN m > 1 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d AND n >= 100
"""
