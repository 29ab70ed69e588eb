"""WARC archives: exact round trips, bounded chunks, equal payloads."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections import Counter, defaultdict

import pytest

from shelfmark.llm import warc


def expected(pages):
    low = lambda i: -(2**63) if i is None else i
    groups = defaultdict(list)
    for i, _, html in pages:
        groups[(html or "").encode()].append(i)
    out = Counter()
    for i, _, html in pages:
        data = (html or "").encode()
        keep = max(groups[data], key=low)
        own = keep == i
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out[(i, len(data), digest, "response" if own else "revisit", None if own else keep)] += 1
    return out


PAGES = [
    (1, "http://a.example/", "<p>same</p>"), (2, None, "<p>same</p>"), (3, "http://a.example/é\r\nX: y", "<p>é\r\n\r\nWARC/1.1\r\n</p>"),
    (4, "", None), (5, "u", ""), (6, "u", "x" * 300_000), (7, "u", "x" * 300_000), (None, "u", "no id"), (8, "u", "no id"),
    (6, "u", "x" * 300_000), (8, "u", "no id"),
]


def test_round_trip(spark):
    frame = spark.createDataFrame([(*p, "z") for p in PAGES], "page_id long, url string, html string, record_type string")
    assert Counter(map(tuple, warc.archive_round_trip(frame).collect())) == expected(PAGES)
    assert warc.archive_round_trip(frame.limit(0)).count() == 0


def test_small_payloads_are_all_responses(spark):
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    rows = warc.archive_round_trip(frame, min_bytes=1000).collect()
    assert Counter(r["page_id"] for r in rows if r["record_type"] == "revisit") == Counter([6, 6])


def test_payloads_come_back_in_chunks(spark, tmp_path):
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    manifest = warc.write_archives(frame, f"file://{tmp_path}/set")
    chunks = warc.read_chunks(manifest, chunk_bytes=1000).filter("record_type = 'response'").orderBy("record_id", "chunk").collect()
    parts = defaultdict(list)
    for c in chunks:
        assert c["size"] == len(c["data"]) <= 1000
        parts[c["record_id"]].append(c)
    wanted = {(html or "").encode() for _, _, html in PAGES}
    got = set()
    for own in parts.values():
        data = b""
        # Rows that repeat the response give their record twice.
        for c in {c["chunk"]: c for c in own}.values():
            assert c["start"] == len(data)
            data += c["data"]
            assert base64.b32decode(c["sha1"]) == hashlib.sha1(data).digest()
        got.add(data)
    assert got == wanted


def test_records_are_gzip_members_with_their_fields(tmp_path):
    out = io.BytesIO()
    sizes = [warc.write_record(out, i, f"http://h/{i}", b"body" * i, hashlib.sha1(b"body" * i).digest(), None) for i in range(3)]
    data = out.getvalue()
    assert sum(sizes) == len(data)
    first = gzip.decompress(data[: sizes[0]])
    assert first.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and first.endswith(b"\r\n\r\n")
    assert gzip.decompress(data).count(b"WARC/1.1") == 3
    with pytest.raises((EOFError, KeyError, TypeError)):
        list(warc.chunks_of(io.BytesIO(data[: sizes[0] - 20])))
