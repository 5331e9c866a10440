"""Secret scans with multipart credential linking.

Strong findings stand alone: assigned passwords and tokens, access key ids,
long hex strings. Weak candidates (an assigned user or client id, a service
endpoint, a short assigned value, a random-looking string) are common in
clean text and are reported only when the parts of one credential come
together: each part is an interval of the text, and an interval join pairs
secrets with access identifiers and endpoints that lie in the same scope
(a paragraph, or the whole text without blank lines), at most REACH
characters apart or at any distance within a run of configuration lines
(assignments, comments, brackets). A weak secret needs an identifier or an endpoint, a weak
identifier or an endpoint needs a secret.

A scope never leaves its document, and a document's text is in one task as a
whole, so the join runs there on sorted intervals; nothing is shuffled.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import binary_list, doc_texts, slices

# The three strong patterns and their least lengths.
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
# The same hex runs, found without stopping at every short one.
_LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{%d,}" % LEAST_HEX)

IDENTIFIER = re.compile(
    r"""(?ai:(?<![a-z0-9])(?:user(?:_?name)?|login|client_?id|account_?id|(?:access_?)?key_?id))["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9@+/_.-]{2,})""")
ENDPOINT = re.compile(
    r"""(?ai:(?<![a-z0-9])[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]{3,})|(?ai:(?<![a-z0-9])(?:host(?:name)?|server|endpoint))"""
    r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9._-]{4,}(?::[0-9]{2,5})?|(?<![^\W_])(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z0-9-]{1,63}:[0-9]{2,5}\b""")
WEAK_ASSIGN = re.compile(
    r"""(?ai:(?<![a-z0-9])(?:pwd|pass|passphrase|auth|credentials?|private_?key|(?:secret_?)?access_?key))["']?\x20*[:=]"""
    r"""\x20*["']?([A-Za-z0-9+/_.=!@#$%^&*-]{4,})""")
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?![A-Za-z0-9+/_-])")
_BLANK_LINE = re.compile(r"\n[\x20\t\r]*\n")
_LINE = (r"""[\x20\t]*(?:(?:-\x20+|export\x20+|set\x20+)?["']?[A-Za-z_][A-Za-z0-9_.\[\]-]*["']?\x20*[:=][^\n]*"""
         r"""|(?:\#|;|//)[^\n]*|[{}()\[\],;]+[\x20\t\r]*)""")
_CONFIG = re.compile(rf"^{_LINE}(?:\n{_LINE})+$", re.M)

KINDS = ("assign", "access", "hex", "weak_secret", "identifier", "endpoint")
#: Most characters between the parts of one credential outside of configuration lines.
REACH = 200
#: Least bits a character of a random-looking string.
LEAST_BITS = 3.5

Span = tuple[int, int]


def strong_spans(text: str) -> dict[str, list[Span]]:
    """The strong findings by kind: code points, end exclusive, leftmost non-overlapping."""
    return {
        "assign": [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN],
        "access": [m.span() for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS],
        "hex": [m.span() for m in _LONG_HEX.finditer(text)],
    }


def _random_looking(s: str) -> bool:
    if not (any(c.isdigit() for c in s) and any(c.islower() for c in s) and any(c.isupper() for c in s)):
        return False
    n = len(s)
    return -sum(k / n * math.log2(k / n) for k in Counter(s).values()) >= LEAST_BITS


def _apart(spans: list[Span], taken: list[Span]) -> list[Span]:
    """The spans that overlap none of `taken`."""
    if not spans or not taken:
        return list(spans)
    s, o = np.array(spans), np.array(sorted(taken))
    # Of those that begin before a span's end, does any end after its start?
    reached = np.concatenate(([-1], np.maximum.accumulate(o[:, 1])))
    hit = reached[np.searchsorted(o[:, 0], s[:, 1], "left")] > s[:, 0]
    return [x for x, h in zip(spans, hit.tolist()) if not h]


def linked(parts: list[Span], others: list[Span], breaks: np.ndarray, reach: int = REACH) -> np.ndarray:
    """Interval join: for each part, whether one of `others` is in its scope and within reach.

    `breaks` are the ascending positions at which a new scope begins.
    """
    if not parts or not others:
        return np.zeros(len(parts), bool)
    p, o = np.array(parts), np.array(sorted(others))
    scope = np.searchsorted(breaks, p[:, 0], "right")
    edges = np.concatenate(([0], breaks, [np.iinfo(np.int64).max]))
    low = np.maximum(p[:, 0] - reach, edges[scope])        # the other must end after this
    high = np.minimum(p[:, 1] + reach, edges[scope + 1])   # and begin before this
    upto = np.searchsorted(o[:, 0], high, "left")          # those that begin in time
    reached = np.concatenate(([-1], np.maximum.accumulate(o[:, 1])))
    return reached[upto] > low


def weak_spans(text: str, strong: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """The weak candidates whose complementary parts are there, by kind."""
    if ":" not in text and "=" not in text and not strong["access"]:
        return {}
    secrets = strong["assign"] + strong["hex"]
    taken = secrets + strong["access"]
    identifiers = _apart([m.span() for m in IDENTIFIER.finditer(text)], taken)
    endpoints = _apart([m.span() for m in ENDPOINT.finditer(text)], taken)
    partners = strong["access"] + identifiers + endpoints
    if not partners:
        return {}
    breaks = np.array([m.end() for m in _BLANK_LINE.finditer(text)], np.int64)
    # A run of configuration lines is a scope of its own, without a reach.
    runs = np.array([m.span() for m in _CONFIG.finditer(text)], np.int64).reshape(-1, 2)

    def joined(parts: list[Span], others: list[Span]) -> np.ndarray:
        near = linked(parts, others, breaks)
        if not len(runs) or near.all():
            return near
        inside = np.searchsorted(runs.ravel(), [a for a, _ in parts], "right") % 2 == 1
        return near | inside & linked(parts, others, runs.ravel(), len(text))

    found = [m.span() for m in WEAK_ASSIGN.finditer(text)]
    found += _apart([m.span() for m in RANDOM.finditer(text) if _random_looking(m[0])], found)
    weak = sorted(_apart(found, taken + identifiers + endpoints))
    weak = [s for s, ok in zip(weak, joined(weak, partners)) if ok]
    secrets = secrets + weak
    return {
        "weak_secret": weak,
        "identifier": [s for s, ok in zip(identifiers, joined(identifiers, secrets)) if ok],
        "endpoint": [s for s, ok in zip(endpoints, joined(endpoints, secrets)) if ok],
    }


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all findings of a text, by start, then kind as in KINDS, then end."""
    strong = strong_spans(text)
    every = strong | weak_spans(text, strong)
    return sorted(((k, a, b) for k, spans in every.items() for a, b in spans),
                  key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_SPANS = "array<struct<kind:string,start:long,end:long>>"


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, spans array<struct<kind,start,end>>) of every document row, whole text.

    Null and empty texts have no spans; repeated rows and null doc_ids stay;
    other columns are ignored; an empty table gives an empty result.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in scan(t.decode("utf-8"))]
                     for t in binary_list(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    return doc_texts(docs).mapInArrow(run, f"doc_id long, spans {_SPANS}")


def digest(found: DataFrame) -> DataFrame:
    """One row a document: counts of the strong kinds, their hash, and all spans as text."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:3]))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def redact_text(text: str, mask: str = "[SECRET]") -> str:
    """The text with each finding (overlapping ones together) replaced by the mask."""
    out, at = [], 0
    for _, a, b in scan(text):
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join([*out, text[at:]]) if out else text


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """The documents with their secrets masked: same rows and columns, n_chars (if there) recounted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            at = b.schema.get_field_index("text")
            texts = [None if t is None else redact_text(t, mask) for t in b.column(at).to_pylist()]
            yield b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                             .otherwise(F.char_length("text").cast(kind)))
    return out
