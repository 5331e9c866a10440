import base64
import hashlib
from urllib.parse import urljoin

from tradewatch.llm import warc


def sha(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


PAGE = "<html><head><title>A &amp; B</title></head><body><p>Hé <a href='/x?y'>link</a><a href=\"http://o/\">o</a></p></body></html>"


def test_records_are_linked():
    key, headers, block = warc.response(7, "http://s/dir/p", PAGE)
    meta, conv = warc.derive(key, headers, block)
    for r, kind in ((meta, "metadata"), (conv, "conversion")):
        assert warc.first(r[1], "WARC-Type") == kind and warc.first(r[1], "WARC-Refers-To") == key
        assert warc.first(r[1], "WARC-Target-URI") == "http://s/dir/p"
        assert warc.first(r[1], "WARC-Block-Digest") == sha(r[2]) and warc.first(r[1], "Content-Length") == str(len(r[2]))
        assert warc.first(r[1], "WARC-Source-Payload-Digest") == sha(PAGE.encode())
    assert warc.first(conv[1], "WARC-Concurrent-To") == meta[0]
    assert conv[2].decode() == "Hé linko"
    fields = meta[2].decode().split("\r\n")
    assert "title: A & B" in fields and f"outlink: {urljoin('http://s/dir/p', '/x?y')}" in fields and "outlink: http://o/" in fields
    assert "http-status: HTTP/1.1 200 OK" in fields and "http-header-content-type: text/html; charset=utf-8" in fields
    assert f"source-warc-block-digest: {sha(block)}" in fields


def test_source_references_are_kept():
    headers = [("warc-type", "response"), ("WARC-Record-ID", "<r>"), ("WARC-Refers-To", "<older>"), ("WARC-Date", "2020-01-01T00:00:00Z"),
               ("WARC-Payload-Digest", "sha1:KEPT")]
    block = b"HTTP/1.0 404 Not Found\r\nX-A: 1\r\nContent-Type: text/html; charset=iso-8859-1\r\n\r\n<p>caf\xe9"
    for r in warc.derive("<r>", headers, block):
        assert warc.first(r[1], "WARC-Source-Refers-To") == "<older>" and warc.first(r[1], "WARC-Date") == "2020-01-01T00:00:00Z"
        assert warc.first(r[1], "WARC-Source-Payload-Digest") == "sha1:KEPT"
    assert r[2].decode() == "café"
    assert warc.derive("<q>", [("WARC-Type", "request")], b"GET /") == []


def test_bytes_round_trip():
    records = [warc.response(i, f"http://a/{i}\r\nX: y", t)[1:] for i, t in enumerate(["", PAGE, "x\r\n\r\nWARC/1.1\r\n" * 9])]
    data = b"".join(warc.to_bytes(h, b) for h, b in records)
    back = list(warc.from_bytes(data))
    assert [b for _, b in back] == [b for _, b in records]
    assert [h for h, _ in back] == [[(n, warc.line(v)) for n, v in h] for h, _ in records]


def test_query_rows_and_edge_cases(spark):
    rows = [(1, "http://a/b", PAGE, "clash"), (1, "http://a/b", PAGE, "clash"), (None, None, None, None), (2, "http://c", "", ""),
            (3, "http://[bad", "<a href='x'>" + "long " * 100_000, "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, block string")
    made = warc.derivatives(warc.responses(df))
    back = warc.read_members(warc.members(made)).collect()
    assert sorted(map(str, back)) == sorted(map(str, made.collect())) and len(back) == 10
    want = []
    for i, u, h, _ in rows:
        want += [(i, *r) for r in warc.derive(*warc.response(i, u, h))]
    assert sorted((str(r.page_id), r.record_id, bytes(r.block)) for r in back) == sorted((str(w[0]), w[1], w[3]) for w in want)
    assert warc.read_members(warc.members(warc.derivatives(warc.responses(df.limit(0))))).count() == 0


def test_links_resolve_as_urljoin_does():
    for target in ("http://a.b/c/d?e#f", "https://x:8/", "http://a", "ftp://a/b", "", None, "http://u:p@a/b"):
        for link in ("/x", "/x/y.z/", "/", "/é", "/a/../b", "/./a", "//c/d", "q", "?x", "#y", "", "/a?b", "/a#", "/a;b", "http://z/", "/a//b", "/.a"):
            assert warc.absolute(target, link) == urljoin(target or "", link), (target, link)
