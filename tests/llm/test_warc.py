"""Archives: round trips, odd payloads, assembly."""

import hashlib

from pyspark.sql import functions as F

from meterflow.llm.shared import shared_folder
from meterflow.llm.warc import assemble, parsed, read_records, record, resolved, write_archives

SCHEMA = "page_id bigint, url string, html string"


def expected(rows, least=100):
    first = {}
    for i, _, h in rows:
        data = (h or "").encode()
        if len(data) >= least:
            first[data] = min(i, first.get(data, i))
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        to = first.get(data, i)
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "response" if to == i else "revisit", None if to == i else to))
    return sorted(out, key=str)


def test_round_trip_of_odd_pages(spark):
    tricky = "WARC/1.1\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\nWARC/1.1\r\n\r\n" * 3
    rows = [(1, "http://a/", "x" * 100), (2, None, "x" * 100), (0, "http://b/\r\nX: 1 %41é", "x" * 100), (5, "u", None), (6, "u", ""), (7, "u", "short"), (8, "u", "short"),
            (9, "u", tricky), (10, "u", tricky), (11, "u", "é\r\n\r\n" * 400_000), (12, "u", "\x00\x01 \n\n")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"capture": F.lit("c"), "digest": F.lit(1)})
    path = shared_folder(spark, "test")
    write_archives(df, path)
    captures = assemble(read_records(spark, path, with_payload=True)).cache()
    assert sorted((tuple(r) for r in resolved(captures).collect()), key=str) == expected(rows)
    by_page = {r.metadata[0].fields["page_id"]: r for r in captures.collect()}
    assert len(by_page) == len(rows)
    for i, url, html in rows:
        r = by_page[str(i)]
        assert len(r.requests) == len(r.metadata) == 1 and r.target_uri == url == r.requests[0].target_uri
        if r.record_type == "response":
            assert bytes(r.payload) == (html or "").encode()


def test_repeated_and_missing(spark):
    rows = [(3, "u", "y" * 200)] * 3 + [(None, "u", "y" * 200), (None, None, None)]
    path = shared_folder(spark, "test")
    write_archives(spark.createDataFrame(rows, SCHEMA), path)
    got = [tuple(r) for r in resolved(assemble(read_records(spark, path))).collect()]
    assert sorted((r[0] or 0, r[1], r[3], r[4]) for r in got if r[1]) == sorted([(3, 200, "response", None), (3, 200, "revisit", 3), (3, 200, "revisit", 3), (0, 200, "revisit", 3)], key=str)
    assert [r[3] for r in got if not r[1]] == ["response"]


def test_empty_table(spark):
    path = shared_folder(spark, "test")
    write_archives(spark.createDataFrame([], SCHEMA), path)
    assert resolved(assemble(read_records(spark, path))).collect() == []


def test_cut_and_foreign_records():
    a = record("response", {"WARC-Record-ID": "<a>"}, b"HTTP/1.1 200 OK\r\n\r\nbody")
    assert [(h["warc-record-id"], b) for h, b in parsed(a + b"\r\n\r\n" + a[:-2])] == [("<a>", b"HTTP/1.1 200 OK\r\n\r\nbody")]
    assert list(parsed(b"")) == list(parsed(b"no archive")) == []
