"""WARC archives of pages: a writer that points equal pages at one, and a reader that salvages damaged files.

Writing. Each page becomes one record. Of pages with equal payloads of some length, the one with the
largest id is written whole as ``response`` and the others as ``revisit`` records that refer to it.
Records become bytes in the tasks; Spark's own writer puts them into files, so archives can lie in any
store that Spark writes, and a lost executor's files are written again by its committer. A volume (file)
has a bounded number of bytes. A record is a gzip member of its own, followed by one zero byte, the
padding that gzip allows between members, or, uncompressed, ends in its two line ends as the format asks.

Reading. A file is read by one task, from its first byte on. At each place a record must pass all checks:
a gzip member its length and CRC, a record its version line, its Content-Length, the two line ends behind
it and its digests. After a failed check the reader searches for the next member or version line at
which all checks pass, goes on there, and logs the bytes between as a gap with the reason of the failure.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slowtide.llm.common import beside, stored

LEAST_BYTES = 1000
VOLUME_BYTES = 8 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_END = b"\r\n\r\n"
_NEEDED = {"warc-type", "warc-record-id", "content-length"}
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_MEMBER = b"\x1f\x8b\x08"
#: Bytes of a member that are unpacked at a time.
_CHUNK = 1 << 16
#: Bytes of records that a task hands on at a time.
_PORTION = 1 << 20


class Damage(ValueError):
    """A check that failed, named as the reason of a gap."""


class Record(NamedTuple):
    headers: dict[str, str]  # names in lower case
    block: bytes

    @property
    def payload(self) -> bytes:
        """The block without the head of the HTTP message, if it is one."""
        if self.headers.get("content-type", "").startswith("application/http"):
            return self.block.partition(_END)[2]
        return self.block


def _line(text: str) -> str:
    """Text as it may stand in a header: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record_bytes(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """An uncompressed record without the two line ends behind it; headers that are None are left out."""
    lines = ["WARC/1.1", *(f"{k}: {_line(v)}" for k, v in headers if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + _END + block


def as_member(record: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record + _END) + packer.flush()


def parse_record(data: bytes | memoryview, at: int = 0) -> tuple[Record, int]:
    """The record at ``at`` and where it ends; raises Damage at the first check that fails."""
    window = bytes(data[at : at + 10])
    if not _VERSION.fullmatch(window):
        raise Damage("version")
    head, size = b"", 1 << 12
    while True:
        piece = bytes(data[at + 10 : at + 10 + size])
        stop = piece.find(_END)
        if stop >= 0:
            head = piece[:stop]
            break
        # No header goes on over a later version line, nor beyond the data.
        if len(piece) < size or _VERSION.search(piece):
            raise Damage("headers")
        size *= 4
    headers: dict[str, str] = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise Damage("headers")
        headers.setdefault(name.strip().lower().decode("utf-8", "replace"), value.strip().decode("utf-8", "replace"))
    if not _NEEDED <= headers.keys():
        raise Damage("headers")
    length = headers["content-length"]
    if not (length.isascii() and length.isdigit()):
        raise Damage("length")
    begin = at + 10 + len(head) + 4
    end = begin + int(length)
    if end + 4 > len(data):
        raise Damage("truncated")
    if bytes(data[end : end + 4]) != _END:
        raise Damage("length")
    record = Record(headers, bytes(data[begin:end]))
    _check_digest(headers.get("warc-block-digest"), record.block)
    if headers.get("warc-type") != "revisit":
        _check_digest(headers.get("warc-payload-digest"), record.payload)
    return record, end + 4


def _check_digest(said: str | None, data: bytes) -> None:
    """SHA-1 in hexadecimal or base 32; other algorithms are not checked."""
    kind, _, value = (said or "").partition(":")
    if kind.lower() != "sha1":
        return
    own = hashlib.sha1(data).digest()
    if value.lower() != own.hex() and value.upper() != base64.b32encode(own).decode():
        raise Damage("digest")


def read_member(data: bytes, at: int) -> tuple[bytes, int]:
    """What the gzip member at ``at`` holds and where it ends; zlib checks its CRC and length."""
    unpacker, out, view, pos = zlib.decompressobj(31), [], memoryview(data), at
    try:
        while not unpacker.eof:
            chunk = view[pos : pos + _CHUNK]
            if not len(chunk):
                raise Damage("truncated")
            pos += len(chunk)
            out.append(unpacker.decompress(chunk))
            if pos == at + len(chunk) and len(out[0]) >= 10 and not _VERSION.match(out[0]):
                raise Damage("version")
    except zlib.error:
        raise Damage("member") from None
    return b"".join(out), pos - len(unpacker.unused_data)


def _records_at(data: bytes, at: int) -> tuple[list[Record], int]:
    """The whole records of the member at ``at``, or the uncompressed one there, and where they end."""
    if not data.startswith(_MEMBER, at):
        record, end = parse_record(data, at)
        return [record], end
    inside, end = read_member(data, at)
    records, pos = [], 0
    while pos < len(inside) or not records:
        record, pos = parse_record(inside, pos)
        records.append(record)
    return records, end


def salvage(data: bytes) -> Iterator[tuple[int, int, list[Record], str | None]]:
    """(begin, end, records, None) of each member or uncompressed record, (begin, end, [], reason) of each gap.

    The ranges cover the data in order, but for zero bytes behind a member.
    """
    pos = 0
    while pos < len(data):
        begin, end, found, reason = pos, len(data), None, ""
        while found is None:
            try:
                found, end = _records_at(data, begin)
            except Damage as failed:
                reason = reason or str(failed)
                start = _START.search(data, begin + 1)
                if start is None:
                    begin = len(data)
                    break
                begin = start.start()
        if begin > pos:
            yield pos, begin, [], reason
        if found is not None:
            yield begin, end, found, None
        if found is not None and data.startswith(_MEMBER, begin):
            while end < len(data) and data[end] == 0:
                end += 1
        pos = end


def with_record_types(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Columns page_id, url, payload and its digest, and refers_to: the page whose equal payload is written whole.

    That is the largest id among equal payloads of ``least_bytes`` or more; rows with that id, and payloads
    without any id, are written whole themselves.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= least_bytes
    heads = rows.filter(large).groupBy("digest").agg(F.max("page_id").alias("head"), F.count("*").alias("n")).filter("n > 1 AND head IS NOT NULL")
    # The table of repeated payloads is stored, so that its measured size decides whether it is broadcast.
    heads = stored(heads.select(F.col("digest").alias("own"), "head"), "warc-heads")
    joined = rows.join(heads, large & (rows["digest"] == heads["own"]), "left")
    return joined.select("page_id", "url", "payload", "digest", F.when(~F.col("head").eqNullSafe(F.col("page_id")), F.col("head")).alias("refers_to"))


def write_pages(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES, volume_bytes: int = VOLUME_BYTES, gzip: bool = True) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) to archives below ``path``, a new folder.

    Of rows with equal html of ``least_bytes`` or more, those with the largest page_id are responses and the others
    revisits. A volume ends with the record that takes it over ``volume_bytes``. Null html is an empty payload, null
    url leaves the target out, rows without page_id have no id in their record. Repeated rows make a record each,
    an empty table no record; other columns are not read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        volume, size = 0, 0
        for batch in batches:
            out: list[bytes] = []
            volumes: list[int] = []
            held = 0
            for page, url, payload, digest, head in zip(*(c.to_pylist() if pa.types.is_integer(c.type) else c for c in batch.columns), strict=True):
                record = page_record(page, url.as_py(), payload.as_py(), digest.as_py(), head)
                out.append(as_member(record) if gzip else record)
                volumes.append(volume)
                size += len(out[-1])
                held += len(out[-1])
                if size >= volume_bytes:
                    volume, size = volume + 1, 0
                if held >= _PORTION:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(volumes, pa.int32())], names=["record", "volume"])
                    out, volumes, held = [], [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(volumes, pa.int32())], names=["record", "volume"])

    records = with_record_types(pages, least_bytes).mapInArrow(work, "record binary, volume int")
    text = records.select(F.col("record").cast("string").alias("record"), "volume")
    text.write.partitionBy("volume").option("lineSep", "\x00" if gzip else _END.decode()).option("compression", "none").text(path)


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response with the payload, or a revisit that refers to the page with the same payload."""
    head = _HTTP % len(payload)
    block = head if refers_to is not None else head + payload
    name = lambda page: f"<urn:page:{'' if page is None else page}:{digest}>"
    return record_bytes(
        [
            ("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", name(page_id)),
            ("WARC-Date", DATE),
            ("WARC-Target-URI", url),
            ("WARC-Refers-To", None if refers_to is None else name(refers_to)),
            ("WARC-Profile", None if refers_to is None else PROFILE),
            ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"),
            ("Content-Type", "application/http; msgtype=response"),
        ],
        block,
    )


COLUMNS = "file string, begin long, end long, gap string, record_type string, record_id string, target_uri string, date string, refers_to string, payload_digest string, payload binary"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives below ``path``, and the byte ranges that hold none.

    One row per record: file, begin and end of the member or uncompressed record that holds it, record_type,
    record_id, target_uri, date, refers_to, payload_digest (as the record says, null if it does not), payload
    (of a revisit: what its own block holds). One row per gap: file, begin, end and gap, the check that failed
    where the gap begins (member, version, headers, length, digest, truncated); all else is null. An empty file gives
    no row. A task holds one file at a time, of up to 2 GB; archives may mix members and uncompressed records.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                name, rows, held = batch.column(0)[k].as_py(), [], 0
                for begin, end, records, gap in salvage(batch.column(1)[k].as_py() or b""):
                    if gap:
                        rows.append((name, begin, end, gap, *[None] * 7))
                    for r in records:
                        said = [r.headers.get(h) for h in ("warc-type", "warc-record-id", "warc-target-uri", "warc-date", "warc-refers-to", "warc-payload-digest")]
                        rows.append((name, begin, end, None, *said, r.payload))
                        held += len(r.payload)
                    if held >= _PORTION or len(rows) >= 1 << 12:
                        yield _as_batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _as_batch(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(work, COLUMNS)


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = [pa.field(n, kinds[t]) for n, t in (c.split(" ") for c in COLUMNS.split(", "))]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], schema=pa.schema(fields))


def page_report(records: DataFrame) -> DataFrame:
    """One row per record of a page, from what ``read_archives`` found: the payload's size and digest, and the page referred to.

    A revisit has the size of the response that it refers to, null if that one is lost; the digest is the
    bare hexadecimal one of its header. Gaps and records of other writers' ids give no page_id.
    """
    id_of = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+):", 1).try_cast("long")
    rows = records.filter("gap IS NULL").select(
        id_of(F.col("record_id")).alias("page_id"),
        "record_id",
        F.octet_length("payload").cast("long").alias("own_bytes"),
        F.lower(F.regexp_extract("payload_digest", "^(?i)sha1:(.*)$", 1)).alias("payload_digest"),
        "record_type",
        F.col("refers_to").alias("refers_id"),
    )
    rows = stored(rows, "warc-records")
    responses = rows.filter("record_type = 'response'").groupBy(F.col("record_id").alias("full_id")).agg(F.max("own_bytes").alias("full_bytes"))
    wanted = rows.filter("record_type = 'revisit'").select(F.col("refers_id").alias("full_id")).distinct()
    sizes = responses.join(wanted, "full_id", "left_semi")
    return rows.join(sizes, rows["refers_id"] == sizes["full_id"], "left").select(
        "page_id",
        F.when(F.col("record_type") == "revisit", F.col("full_bytes")).otherwise(F.col("own_bytes")).alias("payload_bytes"),
        "payload_digest",
        "record_type",
        id_of(F.col("refers_id")).alias("refers_to"),
    )
