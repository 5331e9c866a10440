"""SimHash near-dedup with Golay-code fuzzy keys.

Fingerprints (64 bits over 3-word shingles) are cut into three segments of
22, 21 and 21 bits. A segment, padded to 23 bits, decodes to exactly one
codeword of the perfect binary Golay code [23,12,7] (at most 3 bits away).
Two segments that differ in at most one bit share a codeword among

* the codeword the one decodes to (its index key), and
* the codewords at most 4 bits from the other (its probe keys): the one it
  decodes to and, when that is 3 bits away, the 5 others at 4 bits.

Pigeonhole: of three segments with 3 errors in all, two have at most one
error each. So every pair of fingerprints at 3 bits or fewer meets on the
codewords of one of the three segment pairs: 3 index keys and on average
about 80 probe keys of 24 bits a fingerprint, one equi-join, and an exact
count of the differing bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import binary_list, doc_texts, slices, written
from tradewatch.llm.components import connected_components

# Seed of the shingle hash, generator polynomial of the Golay code.
SEED = 42
GOLAY = 0b110001110101

#: (shift, width) of the three segments of a fingerprint.
SEGMENTS = ((42, 22), (21, 21), (0, 21))
MAX_BITS = 3
_BLOCK = 255      # rows whose bits still add up in one byte


def shingles(words: list[bytes], n: int) -> list[bytes]:
    """The n-word shingles, space-joined; the whole sequence when it is shorter."""
    joined = b" ".join(words)
    if len(words) <= n:
        return [joined]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return [joined[a:b] for a, b in zip(starts[:len(words) - n + 1].tolist(), ends[n - 1:].tolist())]


def fingerprint(text: bytes, n: int = 3) -> int:
    """The 64-bit fingerprint of a UTF-8 text as a signed integer (0 without words)."""
    words = text.lower().split()          # bytes: lowers A-Z only, splits at the six ASCII blanks
    if not words:
        return 0
    parts = shingles(words, n)
    total, sums = len(parts), np.zeros(64, np.int64)
    for a in range(0, total, 1 << 14):    # bounded memory for very long texts
        piece = parts[a:a + (1 << 14)]
        h = np.fromiter(map(xxhash.xxh64_intdigest, piece, repeat(SEED)), np.uint64, len(piece))
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(piece) // _BLOCK * _BLOCK
        if whole:
            sums += np.add.reduce(bits[:whole].reshape(-1, _BLOCK, 64), axis=1,
                                  dtype=np.uint8).sum(axis=0, dtype=np.int64)
        sums += bits[whole:].sum(axis=0, dtype=np.int64)
    return int(np.packbits(sums * 2 > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp long) of every document, whole text, null text as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            fps = [fingerprint(t, shingle) for t in binary_list(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(fps, pa.int64())],
                                             ["doc_id", "text_hash", "fp"])

    return (doc_texts(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
            .mapInArrow(run, "doc_id long, text_hash long, fp long"))


@lru_cache(maxsize=1)
def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(syndromes of the low 12 bits, of the high 11 bits, error by syndrome, other 4-bit errors).

    The last is zero-filled for syndromes whose error has under 3 bits.
    """
    def remainder(v: int) -> int:
        for i in range(22, 10, -1):
            if v >> i & 1:
                v ^= GOLAY << (i - 11)
        return v

    unit = [remainder(1 << i) for i in range(23)]

    def linear(offset: int, width: int) -> np.ndarray:
        t = np.zeros(1 << width, np.int64)
        for i in range(width):
            t[1 << i:2 << i] = t[:1 << i] ^ unit[offset + i]
        return t

    error, other = np.zeros(2048, np.int64), np.zeros((2048, 5), np.int64)
    seen = np.zeros(2048, np.int64)
    for weight in range(1, 5):
        for at in combinations(range(23), weight):
            s, e = 0, 0
            for i in at:
                s, e = s ^ unit[i], e | 1 << i
            if weight < 4:
                error[s] = e
            elif np.bitwise_count(error[s]) == 3:
                other[s, seen[s]] = e
                seen[s] += 1
    return linear(0, 12), linear(12, 11), error, other


def segment_keys(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index key, n x 6 probe keys; -1 where there is none) of segments of up to 23 bits."""
    low, high, error, other = golay_tables()
    s = low[values & 0xFFF] ^ high[values >> 12]
    index = (values ^ error[s]) >> 11             # systematic: the high 12 bits name the codeword
    far = other[s]
    more = np.where(far > 0, (values[:, None] ^ far) >> 11, -1)
    return index, np.concatenate((index[:, None], more), axis=1)


def golay_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n x 3 index keys, probe keys, row of each probe key) of signed 64-bit fingerprints."""
    u = fps.astype(np.int64).view(np.uint64)
    parts = [segment_keys(((u >> np.uint64(a)) & np.uint64((1 << w) - 1)).astype(np.int64)) for a, w in SEGMENTS]
    index, probes, rows = [], [], []
    for tag, (i, j) in enumerate(combinations(range(3), 2)):
        (one, many), (two, also) = parts[i], parts[j]
        index.append(tag << 24 | one << 12 | two)
        grid = tag << 24 | many[:, :, None] << 12 | also[:, None, :]
        there = (many >= 0)[:, :, None] & (also >= 0)[:, None, :]
        probes.append(grid[there])
        rows.append(np.nonzero(there)[0])
    return np.stack(index, axis=1), np.concatenate(probes), np.concatenate(rows)


def _keyed(distinct: DataFrame, probe: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                f = batch.column(0).slice(a, 4096).to_numpy(zero_copy_only=False)
                index, keys, rows = golay_keys(f)
                if not probe:
                    keys, rows = index.ravel(), np.repeat(np.arange(len(f)), 3)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(f[rows])], ["k", "fp"])

    return distinct.select("fp").mapInArrow(run, "k long, fp long")


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(u, v), u < v: every two different fingerprints at `max_bits` (3 or fewer) differing bits.

    `fps` holds distinct fingerprints, so copies cost nothing here; a
    fingerprint has at most 43,744 others within 3 bits, however large its group.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("the segment keys hold for 3 differing bits or fewer")
    a = _keyed(fps, probe=True).withColumnRenamed("fp", "a")
    b = _keyed(fps, probe=False).withColumnRenamed("fp", "b")
    near = (a.join(b, "k")
            .where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)))
    return near.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()


def _components(docs: DataFrame, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(fingerprints, root of each fingerprint, first row of each root): `first` is the least
    (doc_id, text_hash), null doc_ids last."""
    prints = written(fingerprints(docs, shingle), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    nodes = written(prints.groupBy("fp").agg(F.min(row).alias("first")), "nodes")
    roots = connected_components(links(nodes, max_bits))
    known = (nodes.join(roots, nodes.fp == roots.node, "left")
             .select("fp", "first", F.coalesce("component", "fp").alias("root")))
    return prints, known, known.groupBy("root").agg(F.min("first").alias("first"))


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint hex, component_id) of every document row.

    component_id is the least doc_id reachable over links of `max_bits` or
    fewer differing bits. Equal fingerprints are one node. Texts that are
    null, empty or blank have fingerprint zero and link like any other;
    rows with a null doc_id take part and get the component of their links
    (null if it holds no doc_id). Repeated rows stay. An empty table gives an
    empty result; other columns are ignored.
    """
    prints, known, least = _components(docs, shingle, max_bits)
    named = known.select("fp", "root").join(least, "root").select("fp", F.col("first.doc_id").alias("component_id"))
    return (prints.join(named, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def near_dedup(docs: DataFrame, shingle: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents without near copies: of each component the row with the least doc_id.

    Columns stay as they are. Of rows that share that doc_id the one with the
    least hash of its text stays, and rows that repeat both collapse to one. A
    component without any doc_id keeps the row with the least hash.
    """
    _, _, least = _components(docs, shingle, max_bits)
    keep = written(least.select(F.col("first.doc_id").alias("_d"), F.col("first.text_hash").alias("_h")), "keep")
    # A name that no column of the documents has (Spark tells names apart without case).
    own, used = "_text_hash", {c.lower() for c in docs.columns}
    while own in used:
        own += "_"
    kept = docs.withColumn(own, F.xxhash64(F.coalesce("text", F.lit("")))).alias("a").join(
        keep.alias("b"), F.col("a.doc_id").cast("long").eqNullSafe(F.col("b._d")) & (F.col(f"a.{own}") == F.col("b._h")),
        "left_semi")
    return kept.dropDuplicates(["doc_id", own]).select(*docs.columns)
