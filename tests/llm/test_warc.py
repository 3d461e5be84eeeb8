"""The archive converter: both ARC versions, exact round trips and its SQL."""

from __future__ import annotations

import base64
import gzip
import hashlib

import check_oracles
import pytest
from conftest import SMALL

from ledgerloom.llm import warc
from ledgerloom.llm.warc import Record

BODY = b"HTTP/1.0 200 OK\r\nContent-Type: text/html\r\n\r\n<html>\n1 2 3 4 5\nhttp://x 1.1.1.1 20010101000000 text/html 4\n</html>"
RECORDS = [
    Record("http://a.example/", "1.2.3.4", "20010203040506", "text/html", BODY), Record("dns:a.example", "1.2.3.4", "20010203040507", "text/dns", b"\n\n20010203040507\n"),
    Record("http://a.example/b", "0.0.0.0", "19991231235959", "image/gif", b""),
]


@pytest.mark.parametrize("version", [1, 2])
def test_arc_files_are_read_by_declared_lengths(version):
    data = warc.arc_file("x.arc", RECORDS, version)
    fields = data.split(b"\n", 1)[0].split(b" ")
    assert len(fields) == {1: 5, 2: 10}[version] and fields[0] == b"filedesc://x.arc"
    assert list(warc.parse_arc(data, "x.arc")) == RECORDS
    parts = data.split(b"\n", 1)
    assert list(warc.parse_arc(gzip.compress(data[:500]) + gzip.compress(data[500:]), "x.arc.gz")) == RECORDS
    with pytest.raises(ValueError, match="x.arc"):
        list(warc.parse_arc(data[:-5], "x.arc"))
    with pytest.raises(ValueError, match="no ARC header"):
        list(warc.parse_arc(parts[0].replace(b" ", b"  ", 1) + b"\n" + parts[1], "x.arc"))


def test_version_2_offsets_point_at_their_records():
    data = warc.arc_file("x.arc", RECORDS, 2)
    at = data.index(b"\nhttp://a.example/b ") + 1
    assert data[at:].split(b"\n", 1)[0].split(b" ")[7] == str(at).encode()


def test_converted_records_have_types_dates_ids_and_digests():
    answer, lookup, _ = (warc.warc_record(r) for r in RECORDS)
    (fields, block), = warc.parse_warc(answer + warc.END, "x")
    payload = BODY.split(b"\r\n\r\n", 1)[1]
    assert fields["warc-type"] == "response" and fields["warc-date"] == "2001-02-03T04:05:06Z" and block == BODY
    assert fields["warc-payload-digest"] == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    assert fields["warc-block-digest"] == "sha1:" + base64.b32encode(hashlib.sha1(BODY).digest()).decode()
    assert warc.warc_record(RECORDS[0]) == answer
    (fields, block), = warc.parse_warc(lookup + warc.END, "x")
    assert fields["warc-type"] == "resource" and fields["content-type"] == "text/dns" and block == RECORDS[1].body


def test_a_revisit_refers_to_the_response_that_holds_its_payload():
    def keyed(key, extra=b""):
        return Record("http://a/", "0.0.0.0", "20200101000000", "text/html", b"HTTP/1.1 200 OK\r\nX-Archive-Key: " + key + extra + b"\r\n\r\nsame", "200")

    kept, = warc.parse_warc(warc.warc_record(keyed(b"9")) + warc.END, "x")
    other, = warc.parse_warc(warc.warc_record(keyed(b"3"), "9") + warc.END, "x")
    assert other[0]["warc-refers-to"] == kept[0]["warc-record-id"] and other[1].endswith(b"\r\n\r\n") and b"same" not in other[1]
    assert other[0]["warc-payload-digest"] == kept[0]["warc-payload-digest"] and other[0]["x-payload-length"] == "4"


def test_query_equals_sql(spark):
    assert check_oracles.compare(spark, check_oracles.connect(SMALL), "op4_warc_archive", SMALL)[0] == "ok"


@pytest.mark.parametrize("version", [1, 2])
def test_nulls_repeats_line_ends_and_missing_ids(spark, version):
    tricky = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nb\x00ü\r\n\r\n"
    rows = [(1, "http://a b/ü", tricky, 0), (2, None, tricky, 0), (3, "u", None, 0), (4, "u", "", 0), (4, "u", "", 0), (None, "u", tricky, 0), (5, "", "x" * 300_000, 0)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, record_type int")
    got = sorted(((r.key or 0, r.record_type, r.refers_to, r.payload_bytes) for r in warc.archive(df, version=version).collect()), key=str)
    size = len(tricky.encode())
    assert got == sorted([(1, "revisit", 2, size), (2, "response", None, size), (0, "response", None, size), (3, "revisit", 4, 0), (4, "response", None, 0),
                          (4, "response", None, 0), (5, "response", None, 300_000)], key=str)
    longer = {r.key: r.record_type for r in warc.archive(df, least_bytes=1, version=version).collect()}
    assert longer[3] == "response" and longer[1] == "revisit"
    assert warc.archive(df.limit(0), version=version).count() == 0
