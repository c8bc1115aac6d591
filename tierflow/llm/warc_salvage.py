"""WARC archives: a writer with revisits, and a reader that salvages.

``write_archive`` writes a table of pages as WARC 1.1 files: one record per
page, a ``response`` with the payload, or a ``revisit`` that refers to the
response of an equal payload.

``read_archive`` reads WARC files, plain or compressed member by member.  Every
record is checked: version line, header fields, Content-Length, the record's
end, and the digests it states.  After a failed check the reader looks for the
next version line (or compressed member) from which a record passes all
checks, goes on there, and logs the bytes in between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.stages import staged

#: Payloads under this size are never deduplicated.
MIN_REVISIT = 1000
#: Records and bytes of payloads and urls in a file: they bound what a reading
#: task holds.  A page of more bytes has a file of its own.
RECORDS_PER_FILE = 2000
FILE_BYTES = 256 << 20
DATE = "2024-01-01T00:00:00Z"

_EOL = "\r\n"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_MEMBER = b"\x1f\x8b\x08"


def _safe(value: Column) -> Column:
    """A header value: no line ends, no control characters, no outer space."""
    return F.trim(F.regexp_replace(value, r"[\x00-\x1F\x7F]", "%20"))


def write_archive(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT,
                  records_per_file: int = RECORDS_PER_FILE, date: str = DATE, file_bytes: int = FILE_BYTES) -> None:
    """Write (page_id, url, html) as WARC files in the folder ``path``.

    The payload is the html in UTF-8 (null: empty).  Of pages with equal
    payloads of at least ``min_revisit`` bytes the one with the largest
    page_id is a response, and the others revisit it; smaller payloads are all
    responses.  Rows that repeat that page_id and payload are all responses.
    Null page_ids are smaller than others; a group without any other has
    responses only.  A null url gives no target URI.  An empty table gives a
    folder without records.  Other columns are ignored.

    Spark's writer rolls files by records, so pages are written by three
    classes of size, each with as many records a file as fit ``file_bytes`` at
    the largest size of the class; a class without pages is not written.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    page = F.col("page_id").cast("long")
    sized = pages.select(page.alias("page_id"), "url", payload.alias("payload"),
                         F.sha1(payload.cast("binary")).alias("digest"),
                         F.octet_length(payload).cast("long").alias("length"))
    # a payload that stands alone needs no entry: the table of groups stays small
    groups = staged(sized.where(F.col("length") >= min_revisit).groupBy("digest")
                    .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
                    .where("n > 1 and keeper is not null").select("digest", "keeper"), "warc-groups")
    rows = sized.join(groups, "digest", "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper")) & (F.col("length") >= min_revisit)
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_EOL}Content-Type: text/html; charset=utf-8{_EOL}Content-Length: "),
                    F.col("length"), F.lit(_EOL + _EOL))
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))

    def field(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(_EOL))).otherwise("")

    def urn(page: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))

    record = F.concat(
        F.lit(f"WARC/1.1{_EOL}"),
        field("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        field("WARC-Record-ID", urn(F.col("page_id"))),
        field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", _safe(F.col("url"))),
        field("WARC-Profile", F.when(revisit, F.lit(
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        field("WARC-Refers-To", F.when(revisit, urn(F.col("keeper")))),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        field("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.sha1(F.col("block").cast("binary")))),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", F.octet_length(F.col("block")).cast("string")),
        F.lit(_EOL), F.col("block"))
    records = [records_per_file, max(1, records_per_file // 32), 1]
    size = F.col("length") + F.coalesce(F.octet_length("url"), F.lit(0))
    of_size = F.when(size <= file_bytes // records[0], 0).when(size <= file_bytes // records[1], 1).otherwise(2)
    present = [r[0] for r in sized.select(of_size).distinct().collect()]  # three values at most
    for nth, c in enumerate(sorted(present) or [0]):
        # Spark's text writer commits whole files only, so a lost task leaves none
        (rows.where(of_size == c).withColumn("block", block).select(record.alias("value")).write
         .mode("append" if nth else "error")
         .option("lineSep", _EOL * 2).option("maxRecordsPerFile", records[c]).text(path))


def _digest_ok(stated: bytes, data: bytes) -> bool:
    name, _, value = stated.partition(b":")
    if name.lower() != b"sha1":
        return True  # not one that can be checked here
    sha = hashlib.sha1(data)
    return value.lower() == sha.hexdigest().encode() or value == base64.b32encode(sha.digest())


def parse_record(data: bytes, at: int) -> tuple[dict[bytes, bytes], bytes, int] | None:
    """(header fields, block, end) of the record at an offset, or None if any
    check fails."""
    version = _VERSION.match(data, at)
    stop = data.find(b"\r\n\r\n", at)
    if not version or stop < 0:
        return None
    fields: dict[bytes, bytes] = {}
    for line in data[version.end():stop].split(b"\r\n") if stop > version.end() else []:
        name, colon, value = line.partition(b":")
        if not colon or not name:
            return None
        fields[name.strip().lower()] = value.strip()
    length = fields.get(b"content-length", b"")
    if not re.fullmatch(rb"\d{1,18}", length):
        return None
    begin, end = stop + 4, stop + 4 + int(length)
    if data[end:end + 4] != b"\r\n\r\n":
        return None
    block = data[begin:end]
    if b"warc-block-digest" in fields and not _digest_ok(fields[b"warc-block-digest"], block):
        return None
    if fields.get(b"warc-type") == b"response" and b"warc-payload-digest" in fields \
            and not _digest_ok(fields[b"warc-payload-digest"], payload_of(fields, block)):
        return None
    return fields, block, end + 4


def payload_of(fields: dict[bytes, bytes], block: bytes) -> bytes:
    """The block without its HTTP headers, if it has any."""
    if fields.get(b"content-type", b"").startswith(b"application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def _plain(data: bytes) -> Iterator[tuple[int, int, dict | None, bytes]]:
    """(start, end, fields or None for a gap, block), in order."""
    at = gap = 0
    while at < len(data):
        found = parse_record(data, at)
        if found:
            if gap < at:
                yield gap, at, None, b""
            yield at, found[2], found[0], found[1]
            at = gap = found[2]
        else:
            nxt = _VERSION.search(data, at + 1)
            at = nxt.start() if nxt else len(data)
    if gap < at:
        yield gap, at, None, b""


def _members(data: bytes) -> Iterator[tuple[int, int, dict | None, bytes]]:
    """As ``_plain``, for compressed members; offsets are of compressed bytes.
    A member may hold several records."""
    at = gap = 0
    while at < len(data):
        inner, end = None, at
        if data[at:at + 3] == _MEMBER:
            try:
                unzip = zlib.decompressobj(31)
                text = unzip.decompress(data[at:])
                if unzip.eof:
                    inner, end = text, len(data) - len(unzip.unused_data)
            except zlib.error:
                pass
        records = list(_plain(inner)) if inner is not None else []
        if any(r[2] is not None for r in records):
            if gap < at:
                yield gap, at, None, b""
            for r in records:
                # what is damaged inside a sound member is logged at its place
                yield at, end, r[2], r[3]
            at = gap = end
        else:
            nxt = data.find(_MEMBER, at + 1)
            at = nxt if nxt >= 0 else len(data)
    if gap < at:
        yield gap, at, None, b""


def salvage(data: bytes) -> Iterator[tuple[int, int, dict | None, bytes]]:
    """Records and gaps of one file, in order.  A file counts as compressed if
    it holds a member that can be read before any plain record."""
    version, member = _VERSION.search(data), data.find(_MEMBER)
    if member >= 0 and (not version or member < version.start()):
        return _members(data)
    return _plain(data)


_SCHEMA = ("file string, start long, end long, gap boolean, record_id string, type string, uri string, "
           "refers_to string, payload_digest string, declared_length long, payload binary")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), *[pa.string()] * 5, pa.int64(), pa.binary()]

    def text(fields, name):
        value = fields.get(name)
        return None if value is None else value.decode("utf-8", "replace")

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for b in batches:
        for file, data in zip(b["path"], b["content"]):
            rows, held = [], 0
            for start, end, fields, block in salvage(data.as_py()):
                if fields is None:
                    rows.append((file.as_py(), start, end, True, *[None] * 7))
                else:
                    declared = re.search(rb"(?im)^content-length:\s*(\d{1,18})\s*$", block.partition(b"\r\n\r\n")[0])
                    payload = payload_of(fields, block)
                    rows.append((file.as_py(), start, end, False, text(fields, b"warc-record-id"),
                                 text(fields, b"warc-type"), text(fields, b"warc-target-uri"),
                                 text(fields, b"warc-refers-to"), text(fields, b"warc-payload-digest"),
                                 int(declared[1]) if declared else len(payload), payload))
                    held += len(payload)
                if held > 16 << 20 or len(rows) >= 10_000:
                    yield batch(rows)
                    rows, held = [], 0
            if rows:
                yield batch(rows)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records and quarantined gaps of the WARC files in a folder.

    A record has file, start, end (byte offsets), ``gap`` false, record_id,
    type, uri, refers_to, payload_digest (as stated), declared_length (of the
    HTTP headers, else the payload's) and payload.  A gap has ``gap`` true and
    nulls.  Empty files have neither; a folder without files gives an empty
    table.  A file is read as a whole by one task, so files should be of
    bounded size.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(_read, _SCHEMA)
