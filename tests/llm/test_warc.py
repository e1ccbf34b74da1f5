import hashlib
import io
import random
import zlib

import pytest

from rideflow.llm import warc
from rideflow.session import scratch_path


def _record(i, payload, **more):
    return warc.encode_record(i, f"http://x/{i}", payload, hashlib.sha1(payload).hexdigest(), more.get("refers_to"), "refers_to" in more, "1970-01-01T00:00:00Z", 4)


def test_every_cut_gives_every_record_once():
    rnd = random.Random(1)
    payloads = [bytes(rnd.randrange(256) for _ in range(rnd.choice([0, 3, 700]))) for _ in range(12)]
    payloads.append(_record(99, b"an archive inside a record" * 30) * 2)  # nested members
    blob = b"".join(_record(i, p) for i, p in enumerate(payloads))
    for step in (1, 7, 97, 1000, len(blob)):
        found = []
        for start in range(0, len(blob), step):
            found += warc.records_in_range(io.BytesIO(blob), start, min(start + step, len(blob)))
        own = [(at, r) for at, r in found if r["record_id"] != "<urn:x-page:99>"]
        assert [r["payload"] for _, r in own] == payloads
        assert len({at for at, _ in found}) == len(found)


def test_magic_that_is_no_record_is_passed_over():
    junk = b"\x1f\x8b\x08 junk" + zlib.compress(b"WARC/1.1", 9) + b"\x1f\x8b\x08\x00"
    blob = junk + _record(5, b"hello") + junk
    assert [r["payload"] for _, r in warc.records_in_range(io.BytesIO(blob), 0, len(blob))] == [b"hello"]


def test_a_cut_off_record_raises():
    blob = _record(5, random.Random(0).randbytes(30_000))[:-200]
    with pytest.raises(OSError):
        list(warc.records_in_range(io.BytesIO(blob), 0, len(blob)))


def test_round_trip_with_copies_nulls_and_ties(spark):
    long, other = "é" * 600, "b" * 5000
    rows = [
        (1, "http://a/1", long, "x"), (7, "http://a/7\r\nEvil: 1", long, "x"), (3, None, long, None),
        (None, "u", long, "x"), (4, "u", "short", "x"), (5, "u", "short", "x"), (6, "u", None, "x"), (8, "u", "", "x"),
        (9, "u", other, "x"), (9, "u", other, "x"), (10, "", "c" * 1000, "x"), (2, "u", "d" * 999, "x"), (12, "u", "d" * 999, "x"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(3)
    manifest = warc.write_warc(pages, scratch_path(spark, "warc-test"))
    assert manifest.agg({"n_records": "sum"}).first()[0] == len(rows)
    for split in (64, 1 << 20):
        records = warc.read_warc(manifest.select("file", "n_bytes"), split_bytes=split)
        got = sorted(
            (tuple(r) for r in records.select(
                warc.page_of("record_id"), "payload_bytes", "payload_digest", "record_type", warc.page_of("refers_to")).collect()),
            key=str,
        )
        want = []
        for i, _, html, _ in rows:
            body = (html or "").encode()
            same = [j for j, _, h, _ in rows if (h or "").encode() == body and j is not None]
            keep = max(same) if len(body) >= 1000 else i
            revisit = i != keep
            want.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", keep if revisit else None))
        assert got == sorted(want, key=str)
    one = records.filter("record_id = '<urn:x-page:7>'").first()
    assert one.target_uri == "http://a/7%0D%0AEvil:%201" and bytes(one.payload) == long.encode()


def test_listing_and_empty_tables(spark):
    folder = scratch_path(spark, "warc-list")
    pages = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
    warc.write_warc(pages, folder)
    assert warc.read_warc(warc.list_warc(spark, folder)).count() == 1
    empty = warc.write_warc(pages.limit(0), scratch_path(spark, "warc-empty"))
    assert empty.count() == 0 and warc.read_warc(empty.select("file", "n_bytes")).count() == 0


def test_headers_of_any_length_are_read():
    rnd = random.Random(3)
    urls = ["http://x/" + "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(200_000)), "http://x/" + "a" * 3_000_000, "http://y/"]
    digest = hashlib.sha1(b"hello").hexdigest()
    blob = b"".join(warc.encode_record(i, url, b"hello", digest, None, False, "1970-01-01T00:00:00Z", 4) for i, url in enumerate(urls))
    for step in (50_000, len(blob)):
        found = []
        for start in range(0, len(blob), step):
            found += [r for _, r in warc.records_in_range(io.BytesIO(blob), start, min(start + step, len(blob)))]
        assert [r["target_uri"] for r in found] == urls
