import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from stormglass.llm import warc

SCHEMA = "page_id bigint, url string, html string, block int, owner string"


def run(pages, scratch, **options):
    folder = scratch.path("archives")
    warc.write_pages(pages, folder, scratch, **options)
    figures = warc.payload_figures(warc.decode(warc.reassemble(warc.read_records(scratch.spark, folder))))
    return warc.resolve_revisits(figures, scratch)


def archived(pages, scratch, **options):
    folder = scratch.path("archives")
    warc.write_pages(pages, folder, scratch, **options)
    return warc.read_records(scratch.spark, folder)


def test_round_trip_with_segments_copies_and_odd_rows(make, scratch):
    long = "é\r\n\r\nWARC/1.1\r\n0\r\n" * 9000
    rows = [
        (1, "http://a", "same", 1, "x"), (2, "http://b", "same", 1, "x"), (3, None, None, 1, "x"), (4, "u", "", 1, "x"),
        (5, "bad\r\nurl", long, 1, "x"), (6, "u", long, 1, "x"), (7, "u", long + "!", 1, "x"), (None, "n", "same", 1, "x"),
        (2, "http://b", "same", 1, "x"), (8, "u", None, 1, "x"),
    ]
    got = run(make(rows, SCHEMA), scratch, segment_bytes=1000).collect()
    assert len(got) == len(rows)
    found = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in got}

    def row(page, kind, refers, text):
        data = (text or "").encode()
        return page, kind, refers, len(data), warc.base32_digest(hashlib.sha1(data).digest())

    assert found == {
        row(1, "revisit", 2, "same"), row(2, "response", None, "same"), row(None, "revisit", 2, "same"),
        row(3, "revisit", 8, ""), row(4, "revisit", 8, ""), row(8, "response", None, ""),
        row(5, "revisit", 6, long), row(6, "response", None, long), row(7, "response", None, long + "!"),
    }
    assert all(r.complete for r in got)


def test_short_payloads_are_not_revisited(make, scratch):
    rows = [(1, "u", "ab", 1, "x"), (2, "u", "ab", 1, "x"), (3, "u", "abc", 1, "x"), (4, "u", "abc", 1, "x")]
    got = run(make(rows, SCHEMA), scratch, least_bytes=3).collect()
    assert {r.page_id: r.record_type for r in got} == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_pages_without_numbers_and_empty_table(make, scratch):
    got = run(make([(None, "u", "ab", 1, "x"), (None, "v", "ab", 1, "x")], SCHEMA), scratch).collect()
    assert [(r.page_id, r.record_type) for r in got] == [(None, "response")] * 2
    assert run(make([], SCHEMA), scratch).count() == 0


def test_long_pages_are_segmented(make, scratch):
    records = archived(make([(1, "u", "x" * 5000, 1, "x")], SCHEMA), scratch, segment_bytes=1000)
    assert records.where("type = 'continuation'").count() == 5
    assert records.where("total_length IS NOT NULL").count() == 1


@pytest.mark.parametrize("lost", ["segment = 1", "segment = 3", "total_length IS NOT NULL"])
def test_missing_segments_are_incomplete(make, scratch, lost):
    pages = make([(1, "u", "x" * 5000, 1, "x"), (2, "u", "y", 1, "x")], SCHEMA)
    left = archived(pages, scratch, segment_bytes=1000).where(f"NOT coalesce({lost}, false)")
    got = warc.decode(warc.reassemble(left)).select("page_id", "complete", "payload").collect()
    assert {(r.complete, r.payload is None) for r in got if r.page_id != 2} == {(False, True)}
    assert [bytes(r.payload) for r in got if r.page_id == 2] == [b"y"]


def test_chunked_framing():
    for payload in (b"", b"a", b"\r\n0\r\n\r\n" * 3000):
        assert warc.unchunked(warc.chunked(payload, 7)) == payload
    assert warc.unchunked(b"3;x=1\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    for broken in (b"", b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\n", b"3\r\nabc", b"-1\r\n"):
        assert warc.unchunked(broken) is None


def test_parser_reads_gzip_members_and_refuses_other_files():
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:a>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [r["block"] for r in warc.parse_archive(gzip.compress(record) * 2)] == [b"abc"] * 2
    assert [r["block"] for r in warc.parse_archive(record[:-5])] == [b"ab"]
    with pytest.raises(ValueError):
        list(warc.parse_archive(b"something else\r\n"))


def test_digest_of_hot_payload_does_not_need_all_rows_in_a_task(make, scratch, spark):
    pages = spark.range(3000).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("html"))
    got = run(pages, scratch)
    assert got.where("record_type = 'revisit'").count() == 999
    assert got.where("refers_to <> 2997").count() == 0
