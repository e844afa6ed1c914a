import base64
import hashlib

from siltlake.llm import warc
from siltlake.llm.common import scratch

TRICKY = ["WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "\r\n\r\n\r\n", "é漢\U0001f600", "", "x" * 200_000, "HTTP/1.1 200 OK\r\n\r\n", "<html>a</html>"]


def trip(spark, rows, **options):
    path = scratch(spark, "warc-test")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload_bytes string")
    warc.write(pages, path, **options)
    return warc.read(spark, path), warc.assemble(warc.read(spark, path))


def test_exact_round_trip(spark):
    rows = [(i, f"http://h/{i}\r\nx: y" if i % 3 else None, TRICKY[i % 7] if i < 14 else f"<p>{i}</p>", None) for i in range(40)]
    records, found = trip(spark, rows, file_bytes=2000)
    assert records.count() == 120
    out = {int(r["capture_id"].split(":")[2]): r for r in found.collect()}
    assert len(out) == 40
    for i, _, html, _ in rows:
        data, r = html.encode(), out[i]
        top = max(j for j, _, h, _ in rows if h == html)
        assert r["response"]["payload_bytes"] == len(data)
        assert r["response"]["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert r["response"]["record_type"] == ("response" if i == top else "revisit")
        assert r["response"]["payload"] == (data if i == top else None)
        assert (r["response"]["refers_to"] is None) == (i == top)
        if i != top:
            assert r["response"]["refers_to"].split(":")[2] == str(top)
        assert r["request"]["block"].startswith("GET ") and r["metadata"]["block"] == f"page-id: {i}\r\n"


def test_small_payloads_stay_responses(spark):
    _, found = trip(spark, [(1, "u", "ab", None), (2, "u", "ab", None), (3, "u", "abcd", None), (4, "u", "abcd", None)], least_bytes=3)
    assert sorted((r["capture_id"].split(":")[2], r["response"]["record_type"]) for r in found.collect()) == [("1", "response"), ("2", "response"), ("3", "revisit"), ("4", "response")]


def test_edge_rows(spark):
    _, found = trip(spark, [(1, None, None, None), (2, "u", "", None), (5, "u", "same", None), (5, "u", "same", None), (None, "u", "same", None)])
    out = sorted((r["metadata"]["block"].strip(), r["response"]["record_type"], r["response"]["payload_bytes"]) for r in found.collect())
    assert out == [("page-id: 1", "revisit", 0), ("page-id: 2", "response", 0), ("page-id: 5", "response", 4), ("page-id: 5", "response", 4), ("page-id: null", "revisit", 4)]


def test_equal_ids_and_payloads_under_other_urls(spark):
    _, found = trip(spark, [(1, "http://a/", "same", None), (1, "http://b/", "same", None), (0, "http://c/", "same", None), (0, None, "same", None)])
    out = found.collect()
    assert sorted((r["response"]["target_uri"], r["request"]["target_uri"], r["response"]["record_type"]) for r in out) == [
        ("http://a/", "http://a/", "response"), ("http://b/", "http://b/", "response"), ("http://c/", "http://c/", "revisit"), ("urn:page:0", "urn:page:0", "revisit"),
    ]
    assert {r["response"]["refers_to"] for r in out} - {None} <= {r["capture_id"] for r in out if r["response"]["record_type"] == "response"}


def test_empty_table(spark):
    path = scratch(spark, "warc-test")
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.assemble(warc.read(spark, path)).count() == 0


def test_transactions_without_a_response_make_no_capture(spark):
    rows = [("r", "request", None, "gone", None, None, None, "GET", None), ("m", "response", "u", None, None, "D", 3, None, b"abc")]
    found = warc.assemble(spark.createDataFrame(rows, warc.RECORDS)).collect()
    assert [(r["capture_id"], r["request"], r["metadata"]) for r in found] == [("m", None, None)]
