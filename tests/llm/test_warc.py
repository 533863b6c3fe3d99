"""Archives written and read back, whole and damaged."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from slowtide.llm import warc
from slowtide.llm.catalog import QUERIES

PAGES = [
    (1, "http://a/1", "x" * 1000),
    (2, "http://a/2\r\nWARC-Type: evil", "x" * 1000),
    (9, None, "x" * 1000),
    (9, "http://again", "x" * 1000),
    (None, "http://none", "x" * 1000),
    (3, "http://b", "x" * 999),
    (4, "http://b", "x" * 999),
    (5, "http://c", None),
    (6, "http://d", ""),
    (7, "http://é", "é" * 500),
    (8, "http://é", "é" * 500),
    (10, "http://e", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n" + "\x1f\x00\r\n\r\n" * 300),
    (11, "http://f", "long " * 1_000_000),
    (None, "http://g", "z" * 2000),
    (None, "http://h", "z" * 2000),
]


def report(spark, pages, path, **options):
    warc.write_pages(spark.createDataFrame(pages, "page_id long, url string, html string, record string"), path, **options)
    return warc.page_report(warc.read_archives(spark, path))


def expected(pages):
    out = []
    for page, _, html in pages:
        html = html or ""
        size = len(html.encode())
        ids = [p for p, _, h in pages if (h or "") == html and p is not None]
        head = max(ids, default=None) if size >= 1000 else None
        whole = head is None or head == page
        out.append((page, size, hashlib.sha1(html.encode()).hexdigest(), "response" if whole else "revisit", None if whole else head))
    return sorted(out, key=str)


@pytest.mark.parametrize("gzipped", [True, False])
def test_pages_come_back(spark, tmp_path, gzipped):
    pages = [(*p, "extra") for p in PAGES]
    got = report(spark, pages, str(tmp_path / "w"), volume_bytes=3000, gzip=gzipped)
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(PAGES)
    rows = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert all(r.gap is None for r in rows)
    assert len({r.file for r in rows}) > 1
    assert {r.payload.decode() for r in rows if r.record_type == "response"} == {h or "" for _, _, h in PAGES}
    assert {r.target_uri for r in rows if r.record_id.startswith("<urn:page:2:")} == {"http://a/2%0D%0AWARC-Type: evil"}


def test_empty_table_and_empty_file_give_no_rows(spark, tmp_path):
    assert report(spark, [], str(tmp_path / "none")).count() == 0
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "empty.warc").write_bytes(b"")
    assert warc.read_archives(spark, str(tmp_path / "e")).count() == 0


def test_query_equals_a_plain_version(spark, tmp_path):
    table = pa.table({"page_id": pa.array([p[0] for p in PAGES], pa.int64()), "url": [p[1] for p in PAGES], "html": [p[2] for p in PAGES]})
    pq.write_table(table, tmp_path / "pages.parquet")
    got = QUERIES["op12_warc_round_trip"](spark, str(tmp_path))
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(PAGES)


def record(k, size=300, gzipped=False):
    payload = bytes(random.Random(k).choices(b"abcdef \r\n", k=size))
    r = warc.page_record(k, f"http://x/{k}", payload, hashlib.sha1(payload).hexdigest(), None)
    return warc.as_member(r) if gzipped else r + b"\r\n\r\n"


def outcome(data):
    """Ids of the records found, and the gaps."""
    rows = list(warc.salvage(data))
    ids = [int(r.headers["warc-record-id"].split(":")[2]) for _, _, found, _ in rows for r in found]
    gaps = [(a, b, why) for a, b, found, why in rows if why]
    covered = sorted((a, b) for a, b, _, _ in rows)
    assert all(b <= c and not data[b:c].strip(b"\0") for (_, b), (c, _) in zip(covered, covered[1:]))
    return ids, gaps


@pytest.mark.parametrize("gzipped", [True, False])
def test_records_after_damage_are_recovered_and_gaps_logged(gzipped):
    parts = [record(k, gzipped=gzipped) for k in range(6)]
    at = [sum(map(len, parts[:k])) for k in range(7)]
    whole = b"".join(parts)
    assert outcome(whole) == ([0, 1, 2, 3, 4, 5], [])
    # A changed byte in the middle of record 2.
    spoilt = bytearray(whole)
    spoilt[at[2] + len(parts[2]) - 40] ^= 0x55
    ids, gaps = outcome(bytes(spoilt))
    assert ids == [0, 1, 3, 4, 5] and [g[:2] for g in gaps] == [(at[2], at[3])]
    # Record 1 lost its first 20 bytes, record 4 its last 25; both gaps end where the next record begins.
    cut = whole[: at[1]] + whole[at[1] + 20 : at[5] - 25] + whole[at[5] :]
    ids, gaps = outcome(cut)
    assert ids == [0, 2, 3, 5] and [g[:2] for g in gaps] == [(at[1], at[2] - 20), (at[4] - 20, at[5] - 45)]
    # Foreign bytes between records, and an end that is missing.
    ids, gaps = outcome(whole[: at[3]] + b"??junk\r\n" + whole[at[3] : -10])
    assert ids == [0, 1, 2, 3, 4] and gaps[0][:2] == (at[3], at[3] + 8) and gaps[1] == (at[5] + 8, at[6] - 2, "truncated")


def test_every_single_byte_may_be_damaged():
    for gzipped in (True, False):
        parts = [record(k, 60, gzipped) for k in range(3)]
        whole, a, b = b"".join(parts), len(parts[0]), len(parts[0] + parts[1])
        for k in range(a, b):
            rows = list(warc.salvage(whole[:k] + bytes([whole[k] ^ 0x10]) + whole[k + 1 :]))
            # A changed header that no check covers leaves a record; else exactly that range is a gap.
            assert [r[:2] for r in rows] == [(0, a), (a, b), (b, len(whole))]
            assert [len(r[2]) for r in rows] in ([1, 0, 1], [1, 1, 1]) and bool(rows[1][3]) == (not rows[1][2])


def test_mixed_members_paddings_and_other_writers():
    both = record(1, gzipped=True) + b"\0" * 7 + record(2) + record(3, gzipped=True) + b"\0"
    assert outcome(both) == ([1, 2, 3], [])
    block = b"plain text"
    digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
    foreign = f"WARC/1.0\r\nwarc-type: resource\r\nWARC-Record-ID: <urn:page:5:>\r\nWARC-Payload-Digest: sha1:{digest}\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    assert outcome(foreign) == ([5], [])
    assert outcome(foreign.replace(b"plain", b"plane")) == ([], [(0, len(foreign), "digest")])
    two = gzip.compress(record(6) + record(7))
    assert outcome(two) == ([6, 7], [])
    assert outcome(gzip.compress(b"no record")) == ([], [(0, len(gzip.compress(b"no record")), "version")])
    assert outcome(b"\0" * 10) == ([], [(0, 10, "version")])


def test_reasons_of_gaps():
    good, size = record(1), b"Content-Length: "
    last = good.rindex(size, 0, good.index(b"\r\n\r\n"))
    for bad, why in [
        (good.replace(b"WARC/1.1", b"WARC/9.1"), "version"),
        (good.replace(b"WARC-Type: response", b"WARC-Type response"), "headers"),
        (good.replace(b"WARC-Record-ID", b"WARC-Record-Id-2"), "headers"),
        (b"WARC/1.1\r\nA: b\r\nWARC/1.1\r\n", "headers"),
        (good[:last] + size + b"-" + good[last + len(size) :], "length"),
        (good[:-4] + b"\r\n\n\n", "length"),
        (good[:last] + size + b"9" + good[last + len(size) :], "truncated"),
        (good[:-4], "truncated"),
        (good[:-5] + b"?" + good[-4:], "digest"),
    ]:
        assert list(warc.salvage(bad)) == [(0, len(bad), [], why)]
    member = bytearray(record(3, gzipped=True))
    member[-6] ^= 1
    assert [x[3] for x in warc.salvage(bytes(member))] == ["member"]


def test_damaged_archives_through_spark(spark, tmp_path):
    data = [b"".join(record(k * 10 + j, gzipped=k % 2 == 0) for j in range(5)) for k in range(4)]
    for k, d in enumerate(data):
        spoilt = bytearray(d)
        if k != 3:
            spoilt[len(spoilt) // 2] ^= 0xFF
        (tmp_path / f"part-{k}.warc").write_bytes(bytes(spoilt))
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    gaps = [r for r in rows if r.gap]
    assert len(gaps) == 3 and len(rows) == 20 and all(r.payload is None for r in gaps)
    lost = {k * 10 + 2 for k in range(3)}
    assert {int(r.record_id.split(":")[2]) for r in rows if not r.gap} == {k * 10 + j for k in range(4) for j in range(5)} - lost
    assert warc.page_report(warc.read_archives(spark, str(tmp_path))).count() == 17
