"""WARC archives: writing pages as records, and a reader that salvages damaged files.

Spark's own text writer makes the archives: a row is a record, and the line
separator is the blank lines that end a WARC record. So they are committed like any
Spark output, on any file system. The reader takes plain records and gzip
members, checks every record, and after a failed check searches for the next member or
version line from which a valid record can be read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colmask.session import stored, work_folder

#: Payloads of fewer bytes are written in full even if another record has the same.
REVISIT_BYTES = 1000
#: The largest size of an archive file of more than one record; a reader task holds one file at a time.
FILE_BYTES = 16 << 20
#: Records of up to this size are the first size class.
CLASS_BYTES = 4096
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP = b"\x1f\x8b\x08"
#: Bytes that are given to the decompressor at once.
MEMBER_PIECE = 1 << 16
VERSION = re.compile(rb"WARC/1\.[01]\r\n")


def _payload(html: Column) -> Column:
    return F.coalesce(html, F.lit(""))


def page_records(pages: DataFrame) -> DataFrame:
    """``value``: a WARC record per row of ``pages``, without the blank lines that end it.

    The payload is the html in UTF-8, null as empty. Of rows with equal payloads of at
    least 1000 bytes the one with the largest ``page_id`` is a response and the
    others revisit it; repeated rows of that id are responses too, null ids are smaller than any.
    All other rows are responses. Revisits keep the HTTP header, which has the
    payload's length, and the payload's digest. Controls and spaces in urls become
    ``%20``. Which payloads repeat is found on digests alone.
    """
    narrow = pages.select("page_id", _payload(F.col("html")).alias("html")).select(
        "page_id", F.sha1(F.col("html")).alias("digest"), F.octet_length("html").alias("size")
    )
    kept = (
        narrow.filter(F.col("size") >= REVISIT_BYTES)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest", F.col("size").alias("kept_size"), "kept")
    )
    kept = stored(kept, "payloads")
    rows = pages.select("page_id", "url", _payload(F.col("html")).alias("html"))
    rows = rows.withColumn("sha", F.sha1("html")).withColumn("size", F.octet_length("html"))
    rows = rows.join(kept, (F.col("sha") == F.col("digest")) & (F.col("size") == F.col("kept_size")), "left")
    revisit = F.col("kept").isNotNull() & ~F.col("kept").eqNullSafe(F.col("page_id"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"),
        F.lit(END),
    )

    def urn(page: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))

    rows = rows.withColumn("revisit", revisit).withColumn(
        "block", F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("html")))
    )
    url = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\x00-\x20\x7F]", "%20")
    value = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(F.col("revisit"), "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "),
        urn(F.col("page_id")),
        F.lit("\r\nWARC-Target-URI: "),
        url,
        F.when(
            F.col("revisit"), F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), urn(F.col("kept")))
        ).otherwise(""),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        F.col("sha"),
        F.lit("\r\nWARC-Block-Digest: sha1:"),
        F.sha1("block"),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length("block").cast("string"),
        F.lit(END),
        F.col("block"),
    )
    return rows.select(value.alias("value"))


def write_warc(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Write a record per page into plain WARC files of at most ``file_bytes`` (or one record) under ``path``.

    Records are put into classes by size, each four times the one before, and a file takes so many
    records of a class that they fit at the class's largest size. Which rows share a file depends on the
    task that writes them, what the files hold together does not.
    """
    records = page_records(pages)
    size = F.octet_length("value") + len(END)
    step = F.greatest(F.lit(0), F.ceil(F.log(4.0, size / CLASS_BYTES))).cast("int")
    fits = F.greatest(F.lit(1), F.floor(file_bytes / (CLASS_BYTES * F.pow(F.lit(4.0), step)))).cast("bigint")
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    records = records.select("value", step.alias("class"), F.floor(row / fits).alias("lot"))
    records.write.partitionBy("class", "lot").option("lineSep", END).text(path)


@dataclass
class Record:
    offset: int
    length: int
    headers: dict[str, str]
    payload: bytes | None
    payload_bytes: int


@dataclass
class Gap:
    offset: int
    length: int
    reason: str


def _digest_fails(label: str | None, data: bytes) -> bool:
    """Whether a ``sha1:`` label, in hex or base32, disagrees; other algorithms are not checked."""
    if not label or not label.lower().startswith("sha1:"):
        return False
    said, sha = label[5:].strip(), hashlib.sha1(data)
    return said.lower() != sha.hexdigest() and said.upper() != base64.b32encode(sha.digest()).decode()


@dataclass
class Seen:
    """What calls at growing places of the same bytes have found ahead, so that no stretch is searched again."""

    stop: int = -1
    nameless: int = -1


def _record(data: bytes, at: int, seen: Seen) -> tuple[Record, int] | str:
    """The record at ``at`` and where it ends, or why there is none.

    A header may be of any length; a line without a name, such as the next version line, ends a damaged one.
    """
    version = VERSION.match(data, at)
    if not version:
        return "no version line"
    if seen.stop < at:
        stop = data.find(b"\r\n\r\n", at)
        seen.stop = len(data) if stop < 0 else stop
    stop = seen.stop
    if stop == len(data):
        return "header does not end"
    headers: dict[str, str] = {}
    place = version.end()
    if place <= seen.nameless:
        return "header line without a name"
    while place - 2 != stop or not headers:
        after = data.find(b"\r\n", place, stop + 2)
        name, colon, value = data[place:after].partition(b":") if after >= 0 else (b"", b"", b"")
        if not colon:
            seen.nameless = place
            return "header line without a name"
        headers[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
        place = after + 2
    length = headers.get("content-length", "")
    if not length.isdecimal():
        return "no content length"
    begin = stop + 4
    end = begin + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        return "block does not end where its length says"
    block = data[begin:end]
    if _digest_fails(headers.get("warc-block-digest"), block):
        return "block digest differs"
    kind = headers.get("warc-type")
    payload: bytes | None = block
    size = len(block)
    if headers.get("content-type", "").startswith("application/http"):
        head, blank, payload = block.partition(b"\r\n\r\n")
        if not blank:
            return "HTTP header does not end"
        size = len(payload)
        if kind == "revisit":
            said = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", head)
            payload, size = None, int(said[1]) if said else 0
    elif kind == "revisit":
        payload, size = None, 0
    if payload is not None and _digest_fails(headers.get("warc-payload-digest"), payload):
        return "payload digest differs"
    return Record(at, end + 4 - at, headers, payload, size), end + 4


def _member(data: bytes, at: int) -> tuple[list[Record], int] | str:
    """The records of the gzip member at ``at`` and where it ends, or why it is not valid."""
    unpack = zlib.decompressobj(31)
    parts, end = [], at
    # Bounded pieces: what lies behind the member is copied by the library.
    while not unpack.eof and end < len(data):
        piece = memoryview(data)[end : end + MEMBER_PIECE]
        try:
            parts.append(unpack.decompress(piece))
        except zlib.error as error:
            return f"gzip member: {error}"
        end += len(piece)
    if not unpack.eof:
        return "gzip member is cut off"
    end -= len(unpack.unused_data)
    plain = b"".join(parts)
    records, place, seen = [], 0, Seen()
    while place < len(plain):
        found = _record(plain, place, seen)
        if isinstance(found, str):
            return found
        record, place = found
        record.offset, record.length = at, end - at
        records.append(record)
    return records, end


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """All valid records of an archive file, and the stretches of bytes between them that are not."""
    at, lost, reason = 0, None, ""
    ahead = {GZIP: -1, b"WARC/": -1}
    seen = Seen()
    while at < len(data):
        found = _member(data, at) if data.startswith(GZIP, at) else _record(data, at, seen)
        if isinstance(found, str):
            if lost is None:
                lost, reason = at, found
            for mark, place in ahead.items():
                if place <= at:
                    place = data.find(mark, at + 1)
                    ahead[mark] = len(data) if place < 0 else place
            at = min(ahead.values())
            continue
        if lost is not None:
            yield Gap(lost, at - lost, reason)
            lost = None
        records, at = found if isinstance(found[0], list) else ([found[0]], found[1])
        yield from records
    if lost is not None:
        yield Gap(lost, len(data) - lost, reason)


READ = (
    "file string, offset bigint, length bigint, gap string, record_type string, record_id string, target_uri string, "
    "refers_to string, payload_bytes bigint, payload_digest string, payload binary"
)
_NAMES = [part.split()[0] for part in READ.split(", ")]
_KINDS = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.binary()]
#: Payload bytes after which the reader hands rows on.
ROWS_BYTES = 8 << 20


def _hex(label: str | None) -> str | None:
    """The bare hex digits of a ``sha1:`` label."""
    if not label or not label.lower().startswith("sha1:"):
        return None
    said = label[5:].strip()
    return said.lower() if len(said) == 40 else base64.b32decode(said.upper()).hex()


def _rows(file: str, data: bytes) -> Iterator[tuple]:
    for found in salvage(data):
        if isinstance(found, Gap):
            yield (file, found.offset, found.length, found.reason, *[None] * 7)
            continue
        h = found.headers
        digest = (
            hashlib.sha1(found.payload).hexdigest() if found.payload is not None else _hex(h.get("warc-payload-digest"))
        )
        yield (
            file, found.offset, found.length, None, h.get("warc-type"), h.get("warc-record-id"),
            h.get("warc-target-uri"), h.get("warc-refers-to"), found.payload_bytes, digest, found.payload,
        )


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archive files under ``path``, and the byte gaps that could not be read.

    A row with ``gap`` (the reason) set is a quarantined stretch of bytes of its
    ``file``; all others are records whose lengths and digests agree. ``offset`` and
    ``length`` are places in the file, for a gzip member those of the member. Revisits have no payload, but the
    length and digest of the full one. An empty file has no rows. Files are read
    by Spark, whole; they spread over tasks by size.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for i in range(batch.num_rows):
                for row in _rows(batch.column(0)[i].as_py(), batch.column(1)[i].as_py()):
                    rows.append(row)
                    size += len(row[-1] or b"") + 200
                    if size >= ROWS_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
            if rows:
                yield _batch(rows)

    return files.mapInArrow(run, READ)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], names=_NAMES)


def archived_pages(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of the records read from archives of pages."""

    def page(urn: str) -> Column:
        return F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1)

    def number(urn: str) -> Column:
        return F.when(page(urn) != "", page(urn)).cast("bigint")

    return records.filter(F.col("gap").isNull()).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"),
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives in the shared folder and read back."""
    path = work_folder(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return archived_pages(read_warc(spark, path))


OP5_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS size FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS kept FROM p)
SELECT page_id, size::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN kept END AS refers_to
FROM (SELECT *, size >= {REVISIT_BYTES} AND kept IS NOT NULL AND page_id IS DISTINCT FROM kept AS again FROM k)
"""

QUERIES = {"op5_warc": op5_warc}
ORACLES = {"op5_warc": OP5_SQL}
