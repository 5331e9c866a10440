"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. Every test item's word 3-grams are hashed. A bitmap of fixed size over
   these hashes goes to all tasks; each document's 3-grams are looked up in
   it, and only the neighbourhoods of hits (word hashes, not text) are
   written, each with its hits. The equi-joins that follow are exact, so the
   bitmap only saves work, however full it is.
2. The corpus count of each item 3-gram is taken over all documents. Seeds
   are the 3-grams that occur in at most RARE of the documents and, so that
   an item copied into very many documents keeps seeds, the rarest of every
   WINDOW 3-grams in a row.
3. Seed hits join documents' neighbourhoods to items on the diagonal of the hit;
   each (neighbourhood, item, diagonal) is aligned locally with a match score
   for equal words, half of it for equal stems, and penalties for
   substitutions and gaps, so edited and paraphrased copies score too.

A document is contaminated by an item when the best alignment reaches SHARE
of the item's words, or LONG words of a long item. A few common words in a row
reach SHARE of a short item, so nearly the whole of it is asked for (least_score).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewatch.llm.common import binary_list, slices, written

N_GRAM = 3
#: Share of the documents up to which a 3-gram is rare; 3-grams in a row of which the rarest is a seed.
RARE, WINDOW = 0.01, 3
#: Contaminated: alignment score by item words, or the score itself.
SHARE, LONG = 0.4, 25.0
#: Share of items of up to SHORT words; it falls to SHARE at FULL words.
SHORT_SHARE, SHORT, FULL = 0.9, 9, 15
#: Items of fewer words can't be told from chance and are never reported.
LEAST_WORDS = 5
MATCH, STEM, MISMATCH, GAP = 1.0, 0.5, -0.5, -0.5
STEM_LETTERS = 5
#: Bits of the lookup table (8 MB), in chunks as Spark's bitmap aggregate makes them.
BITMAP_BITS, _CHUNK = 26, 15

_BLANK = bytes(c if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_MARKS = re.compile(rb"\xe2\x80[\x80-\xbf]|\xc2[\xa0-\xbf]")       # general punctuation, Latin-1 signs
_MULTIPLIER, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def words(text: bytes) -> list[bytes]:
    """Lower-cased words of a UTF-8 text: letters and digits, other ASCII and typographic signs cut."""
    t = text.lower() if text.isascii() else text.decode("utf-8").lower().encode("utf-8", "surrogatepass")
    if not t.isascii():
        t = _MARKS.sub(b" ", t)
    return t.translate(_BLANK).split()


def word_hashes(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, ws), np.uint32, len(ws))


def stem_hashes(ws: list[bytes]) -> np.ndarray:
    """Hashes of the words' first letters; 0 for words too short to have a stem."""
    return np.fromiter((zlib.crc32(w[:STEM_LETTERS]) if len(w) >= STEM_LETTERS else 0 for w in ws),
                       np.uint32, len(ws))


def gram_hashes(hashes: np.ndarray, n: int = N_GRAM) -> np.ndarray:
    """64-bit hashes (signed) of the n-grams of word hashes."""
    if len(hashes) < n:
        return np.zeros(0, np.int64)
    h = hashes.astype(np.uint64)
    x = h[:len(h) - n + 1]
    for i in range(1, n):
        x = x * _MULTIPLIER + h[i:len(h) - n + 1 + i]
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return (x ^ (x >> np.uint64(29))).view(np.int64)


def _bitmap_at(grams: np.ndarray) -> np.ndarray:
    return (grams.view(np.uint64) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def in_table(bits: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Whether each hash's bit is set: always for hashes the table was made of, by chance for others."""
    at = _bitmap_at(grams)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, n_words, words, stems, grams) of each test item with LEAST_WORDS words or more.

    `item` numbers the rows: items may share an id or have none.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 33
        for b in slices(batches, "text"):
            out = []
            for i, t in zip(b.column("item_id").to_pylist(), binary_list(b.column("text"))):
                ws = words(t)
                if len(ws) >= LEAST_WORDS:
                    h = word_hashes(ws)
                    out.append({"item": key, "item_id": i, "n_words": len(ws), "words": h.tobytes(),
                                "stems": stem_hashes(ws).tobytes(), "grams": gram_hashes(h)})
                    key += 1
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("item", pa.int64()), ("item_id", pa.int64()), ("n_words", pa.int32()), ("words", pa.binary()),
                ("stems", pa.binary()), ("grams", pa.list_(pa.int64()))]))

    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text"))
    return written(rows.mapInArrow(run, "item long, item_id long, n_words int, words binary, stems binary, "
                                        "grams array<long>"), "items")


def lookup_table(grams: DataFrame) -> np.ndarray:
    """The bitmap of the grams' hashes: at most 2^(BITMAP_BITS - 15) rows of 4 KB reach the driver."""
    at = F.shiftrightunsigned("gram", 64 - BITMAP_BITS)
    chunks = (grams.select(at.alias("at"))
              .groupBy(F.shiftright("at", _CHUNK).alias("chunk"))
              .agg(F.expr(f"bitmap_construct_agg(at & {(1 << _CHUNK) - 1})").alias("bits")).collect())
    table = np.zeros((1 << BITMAP_BITS) // 8, np.uint8)
    for r in chunks:
        start = r["chunk"] << (_CHUNK - 3)
        table[start:start + len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    return table


def neighbourhoods(docs: DataFrame, table, reach: int) -> DataFrame:
    """(place, doc_id, text_hash, start, words, stems, grams, at): runs of words within `reach` of hits.

    Runs of one document don't overlap, so they hold no more than its words.
    `at` are the hits' positions in the run, `place` numbers the runs.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 33
        bits = table.value
        for b in slices(batches, "text"):
            out = []
            for d, th, t in zip(b.column("doc_id").to_pylist(), b.column("text_hash").to_pylist(),
                                binary_list(b.column("text"))):
                ws = words(t)
                h = word_hashes(ws)
                grams = gram_hashes(h)
                hits = np.flatnonzero(in_table(bits, grams))
                if not len(hits):
                    continue
                for group in np.split(hits, np.flatnonzero(np.diff(hits) > 2 * reach) + 1):
                    a, z = max(0, int(group[0]) - reach), min(len(ws), int(group[-1]) + N_GRAM + reach)
                    out.append({"place": key, "doc_id": d, "text_hash": th, "start": a, "words": h[a:z].tobytes(),
                                "stems": stem_hashes(ws[a:z]).tobytes(), "grams": grams[group], "at": group - a})
                    key += 1
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("place", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int32()),
                ("words", pa.binary()), ("stems", pa.binary()), ("grams", pa.list_(pa.int64())),
                ("at", pa.list_(pa.int32()))]))

    return written(docs.mapInArrow(run, "place long, doc_id long, text_hash long, start int, words binary, "
                                        "stems binary, grams array<long>, at array<int>"), "places")


def align(a: np.ndarray, a_stem: np.ndarray, b: np.ndarray, b_stem: np.ndarray) -> tuple[float, int, int]:
    """(score, start, end) of the best local alignment of item words `a` with text words `b`.

    start and end are the span of `b`. Linear gaps, so a row's gaps within
    `b` are a running maximum; ties go to the earliest end.
    """
    n = len(b)
    step = np.arange(n + 1) * -GAP
    score, begin = np.zeros(n + 1), np.arange(n + 1)
    best, span = 0.0, (0, 0)
    for w, s in zip(a, a_stem):
        pair = np.where(b == w, MATCH, np.where((b_stem == s) & (s != 0), STEM, MISMATCH))
        row, first = np.zeros(n + 1), np.arange(n + 1)
        diagonal, down = score[:-1] + pair, score[1:] + GAP
        take = diagonal >= down
        inner = np.where(take, diagonal, down)
        origin = np.where(take, begin[:-1], begin[1:])
        alive = inner > 0
        row[1:][alive], first[1:][alive] = inner[alive], origin[alive]
        # A gap within b: the best of row[k] + GAP * (j - k) for k < j.
        level = row + step
        top = np.maximum.accumulate(level)
        source = np.maximum.accumulate(np.where(level == top, np.arange(n + 1), 0))
        across = top - step
        longer = across > row
        row[longer], first[longer] = across[longer], first[source[longer]]
        score, begin = row, first
        j = int(score.argmax())
        if score[j] > best:
            best, span = float(score[j]), (int(begin[j]), j)
    return best, *span


def least_score(n: int, share: float = SHARE, long: float = LONG) -> float:
    """The alignment score from which on an item of `n` words contaminates."""
    part = min(max((n - SHORT) / (FULL - SHORT), 0.0), 1.0)
    return min(max(share, SHORT_SHARE + (SHARE - SHORT_SHARE) * part) * n, long)


def contamination(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, long: float = LONG) -> DataFrame:
    """(doc_id, text_hash, item_id, score, share, start, end): the contaminated documents and by which item.

    One row for each document row and item, its best alignment: `score` in
    words, `share` of the item's words, and the span in words of the document.
    text_hash is the xxhash64 of the text. Null and empty texts, and items of
    under LEAST_WORDS words, give no row; null ids and repeated rows are
    dealt with like others; other columns are ignored; an empty table on
    either side gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.where(F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").alias("text"))
    items = items_of(benchmark)
    grams = items.select("item", F.posexplode("grams").alias("item_at", "gram"))
    longest = items.agg(F.max("n_words")).first()[0] or 0
    table = spark.sparkContext.broadcast(lookup_table(grams))        # 8 MB at any size
    places = neighbourhoods(texts, table, longest + longest // 4 + 8)
    hits = (places.select("place", F.explode(F.arrays_zip("grams", "at")).alias("hit"))
            .select("place", F.col("hit.grams").alias("gram"), F.col("hit.at").alias("at")))

    counts = hits.groupBy("gram").agg(F.count("*").alias("n"))
    rare = RARE * texts.select("doc_id").count()
    row = Window.partitionBy("item").orderBy("item_at")
    seen = grams.join(counts, "gram")                    # 3-grams that no document has can't be seeds
    least = F.min(F.struct("n", "gram")).over(row.rowsBetween(Window.currentRow, WINDOW - 1))
    rarest = seen.withColumn("r", least).select("item", F.col("r.gram").alias("gram"))
    seeds = written(seen.join(rarest.distinct().withColumn("rarest", F.lit(True)), ["item", "gram"], "left")
                    .where((F.col("n") <= rare) | F.col("rarest")).select("item", "gram", "item_at"), "seeds")

    # Windows of the text to align: hits of one item on nearby diagonals are one candidate.
    near = (hits.join(seeds, "gram").join(items.select("item", "n_words"), "item")
            .select("place", "item", F.floor((F.col("at") - F.col("item_at")) / F.col("n_words")).cast("int").alias("lane"))
            .distinct())
    pairs = (near.join(items.select("item", "item_id", "n_words", F.col("words").alias("item_words"),
                                    F.col("stems").alias("item_stems")), "item")
             .join(places.select("place", "doc_id", "text_hash", "start", "words", "stems"), "place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                n = r["n_words"]
                slack = n // 4 + 8
                a = max(0, r["lane"] * n - slack)
                z = (r["lane"] + 2) * n + slack
                text, stems = (np.frombuffer(r[c], np.uint32)[a:z] for c in ("words", "stems"))
                item, item_stems = (np.frombuffer(r[c], np.uint32) for c in ("item_words", "item_stems"))
                score, s, e = align(item, item_stems, text, stems)
                if score >= least_score(n, share, long):
                    out.append({"doc_id": r["doc_id"], "text_hash": r["text_hash"], "item_id": r["item_id"],
                                "item": r["item"], "score": score, "share": score / n,
                                "start": r["start"] + a + s, "end": r["start"] + a + e})
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("item_id", pa.int64()), ("item", pa.int64()),
                ("score", pa.float64()), ("share", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]))

    aligned = pairs.mapInArrow(run, "doc_id long, text_hash long, item_id long, item long, score double, "
                                    "share double, start int, end int")
    best = F.max_by(F.struct("score", "share", "start", "end"),
                    F.struct("score", -F.col("start"), -F.col("end"))).alias("b")
    return aligned.groupBy("doc_id", "text_hash", "item", "item_id").agg(best).select(
        "doc_id", "text_hash", "item_id", "b.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that no test item contaminates, with their columns as they are."""
    found = contamination(docs, benchmark).select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"))
    found = written(found.distinct(), "contaminated")
    same = docs["doc_id"].cast("long").eqNullSafe(found["_d"]) & (F.xxhash64(docs["text"]) == found["_h"])
    return docs.join(found, same, "left_anti")
