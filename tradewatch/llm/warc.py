"""WARC derivatives: linked metadata and plain-text conversion records of response records.

A record is a row (record_id, headers, block). From each `response` come

* a `metadata` record (application/warc-fields): status and headers of the
  HTTP response as they were, title, links, and the source's identifiers and digests;
* a `conversion` record (text/plain): the page's text.

Both name the response in WARC-Refers-To, and the conversion names the
metadata record too (WARC-Concurrent-To); WARC-Refers-To and digests that
the response itself carries are kept. Identifiers are made from the content, so a retried
task writes the same ones. ``to_bytes`` gives a record as one gzip member:
members put one after the other are a WARC file.

Every record is made from one row, so nothing is shuffled.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import slices
from tradewatch.llm.html_extract import blocks

# Fixed values of the format (WARC 1.1).
VERSION = b"WARC/1.1"
HTTP_RESPONSE = "application/http; msgtype=response"
FIELDS = "application/warc-fields"
PLAIN = "text/plain; charset=utf-8"

#: Level of the gzip members: speed before size.
COMPRESSION = 1

#: Date of records made from tables that have none.
NO_DATE = "1970-01-01T00:00:00Z"

Headers = list[tuple[str, str]]
RECORD = "record_id string, headers array<struct<name:string,value:string>>, block binary"

_TITLE = re.compile(r"<title[^>]*>(.*?)</title\s*>", re.S | re.I)
_LINK = re.compile(r"""<a\s(?:[^>"']|"[^"]*"|'[^']*')*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_ORIGIN = re.compile(r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?(?=[/?#]|$)")
_ROOTED = re.compile(r"/(?:[\w,~-][\w.,~-]*/)*(?:[\w,~-][\w.,~-]*)?")
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)


def digest(data: bytes) -> str:
    """A labelled digest as WARC files have it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def identifier(*parts: bytes) -> str:
    """A record id that depends on the parts only."""
    h = hashlib.sha256(b"\0".join(str(len(p)).encode() + b":" + p for p in parts)).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=h[:16], version=5)}>"


def line(value: str) -> str:
    """A header value without line ends."""
    if "\r" in value or "\n" in value:
        value = re.sub(r"[\r\n]+", " ", value)
    return value.strip()


def first(headers: Headers, name: str) -> str | None:
    return next((v for n, v in headers if n.lower() == name.lower()), None)


def http_parts(block: bytes) -> tuple[str, Headers, bytes]:
    """(status line, headers, body) of an HTTP response; a block without a head is all body."""
    if not block.startswith(b"HTTP/"):
        return "", [], block
    head, _, body = block.partition(b"\r\n\r\n")
    rows = head.decode("iso-8859-1").split("\r\n")
    return rows[0], [(n.strip(), v.strip()) for n, _, v in (r.partition(":") for r in rows[1:]) if n.strip()], body


def decoded(body: bytes, content_type: str | None) -> str:
    """The body as text: the header's charset, else the page's own, else UTF-8."""
    m = _CHARSET.search(content_type or "") or _CHARSET.search(body[:2048].decode("ascii", "replace"))
    try:
        return body.decode(m[1] if m else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def absolute(target: str | None, link: str) -> str:
    """The link as an absolute URL; as it is when it can't be one."""
    m = _ORIGIN.match(target or "")
    if m and _ROOTED.fullmatch(link):
        return m[0] + link                       # what urljoin gives, without taking the URL apart
    try:
        return urljoin(target or "", link)
    except ValueError:
        return link


def plain_text(page: str) -> str:
    """The text of all blocks of a page, a line each."""
    return "\n".join(t for _, t in blocks(page))


def response(page_id: int | None, url: str | None, html: str | None, date: str = NO_DATE) -> tuple[str, Headers, bytes]:
    """The response record of a page (null html: an empty body; null url: no target)."""
    body = (html or "").encode("utf-8", "replace")
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body)) + body
    key = identifier(b"response", str(page_id).encode(), (url or "").encode("utf-8", "replace"), body)
    headers = [("WARC-Type", "response"), ("WARC-Record-ID", key), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", line(url)))
    return key, [*headers, ("Content-Type", HTTP_RESPONSE), ("WARC-Payload-Digest", digest(body)),
                 ("WARC-Block-Digest", digest(block)), ("Content-Length", str(len(block)))], block


def derive(key: str, headers: Headers, block: bytes) -> list[tuple[str, Headers, bytes]]:
    """The metadata and the conversion record of a response; nothing for records of another type."""
    if (first(headers, "WARC-Type") or "").lower() != "response":
        return []
    status, http, body = http_parts(block)
    kind = first(http, "Content-Type")
    page = decoded(body, kind)
    target, date = first(headers, "WARC-Target-URI"), first(headers, "WARC-Date") or NO_DATE
    shared = [("WARC-Date", date), *([("WARC-Target-URI", target)] if target is not None else []), ("WARC-Refers-To", key)]
    if first(headers, "WARC-Refers-To"):
        shared.append(("WARC-Source-Refers-To", first(headers, "WARC-Refers-To")))
    source = [(f"source-{n.lower()}", v) for n, v in headers
              if n.lower() in ("warc-payload-digest", "warc-block-digest", "content-length", "content-type")]
    payload = first(headers, "WARC-Payload-Digest") or digest(body)

    fields: Headers = [("http-status", status), *((f"http-header-{n.lower()}", v) for n, v in http), *source]
    title = _TITLE.search(page)
    if title:
        fields.append(("title", " ".join(t for _, t in blocks(f"<p>{title[1]}"))))
    for m in _LINK.finditer(page):
        fields.append(("outlink", absolute(target, m[1] or m[2] or m[3] or "")))
    about = "".join(f"{n}: {line(v)}\r\n" for n, v in fields).encode("utf-8", "replace")
    text = plain_text(page).encode("utf-8", "replace")

    def record(warc_type: str, content: str, data: bytes, more: Headers) -> tuple[str, Headers, bytes]:
        own = identifier(warc_type.encode(), key.encode(), data)
        return own, [("WARC-Type", warc_type), ("WARC-Record-ID", own), *shared, *more,
                     ("WARC-Source-Payload-Digest", payload), ("WARC-Block-Digest", digest(data)),
                     ("Content-Type", content), ("Content-Length", str(len(data)))], data

    metadata = record("metadata", FIELDS, about, [])
    return [metadata, record("conversion", PLAIN, text, [("WARC-Concurrent-To", metadata[0])])]


def to_bytes(headers: Headers, block: bytes) -> bytes:
    """A record as a gzip member (without a time, so equal records give equal bytes)."""
    head = b"".join([VERSION, b"\r\n", *(f"{n}: {line(v)}\r\n".encode("utf-8", "replace") for n, v in headers), b"\r\n"])
    return gzip.compress(head + block + b"\r\n\r\n", compresslevel=COMPRESSION, mtime=0)


def from_bytes(data: bytes) -> Iterator[tuple[Headers, bytes]]:
    """The records of (one or more) gzip members or of plain WARC bytes."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        rows = data[at:end].decode("utf-8").split("\r\n")
        if not rows[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = [(n, v.strip()) for n, _, v in (r.partition(":") for r in rows[1:])]
        size = int(first(headers, "Content-Length") or 0)
        yield headers, data[end + 4:end + 4 + size]
        at = end + 4 + size + 4


_ARROW = pa.schema([("record_id", pa.string()),
                    ("headers", pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))),
                    ("block", pa.binary())])


def _rows(records: list[tuple[str, Headers, bytes]]) -> dict:
    return {"record_id": [r[0] for r in records],
            "headers": [[{"name": n, "value": v} for n, v in r[1]] for r in records],
            "block": [r[2] for r in records]}


def responses(pages: DataFrame, date: str = NO_DATE) -> DataFrame:
    """(page_id, record_id, headers, block): a response record of every page row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "html"):
            ids = b.column("page_id").to_pylist()
            made = [response(i, u, h, date) for i, u, h in zip(ids, b.column("url").to_pylist(), b.column("html").to_pylist())]
            yield pa.RecordBatch.from_pydict({"page_id": ids, **_rows(made)},
                                             pa.schema([("page_id", pa.int64()), *_ARROW]))

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        run, f"page_id long, {RECORD}")


def derivatives(records: DataFrame) -> DataFrame:
    """(page_id, record_id, headers, block): the derived records of response records.

    Records of another type and null blocks give none or an empty body;
    repeated rows give repeated records; an empty table gives an empty result; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "block"):
            ids, made = [], []
            for i, key, headers, block in zip(*(b.column(c).to_pylist() for c in ("page_id", "record_id", "headers", "block"))):
                found = derive(key or "", [(h["name"], h["value"] or "") for h in headers or []], block or b"")
                ids += [i] * len(found)
                made += found
            yield pa.RecordBatch.from_pydict({"page_id": ids, **_rows(made)},
                                             pa.schema([("page_id", pa.int64()), *_ARROW]))

    return records.select("page_id", "record_id", "headers", "block").mapInArrow(run, f"page_id long, {RECORD}")


def members(records: DataFrame) -> DataFrame:
    """(page_id, member): each record as a gzip member of a WARC file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "block"):
            made = [to_bytes([(h["name"], h["value"]) for h in headers], block)
                    for headers, block in zip(b.column("headers").to_pylist(), b.column("block").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), pa.array(made, pa.binary())], ["page_id", "member"])

    return records.mapInArrow(run, "page_id long, member binary")


def read_members(stored: DataFrame) -> DataFrame:
    """(page_id, record_id, headers, block) of stored members, digests checked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "member", 2 << 20):
            ids, made = [], []
            for i, data in zip(b.column("page_id").to_pylist(), b.column("member").to_pylist()):
                for headers, block in from_bytes(data):
                    if first(headers, "WARC-Block-Digest") not in (None, digest(block)):
                        raise ValueError(f"damaged record {first(headers, 'WARC-Record-ID')}")
                    ids.append(i)
                    made.append((first(headers, "WARC-Record-ID"), headers, block))
            yield pa.RecordBatch.from_pydict({"page_id": ids, **_rows(made)},
                                             pa.schema([("page_id", pa.int64()), *_ARROW]))

    return stored.mapInArrow(run, f"page_id long, {RECORD}")


def header(name: str):
    """Column: the value of a record's header (null without it)."""
    return F.get(F.filter("headers", lambda h: F.lower(h["name"]) == name.lower()), 0)["value"]
