"""Token files: a concatenated id array with Elias-Fano coded document boundaries.

A folder of the format holds `segments` (one record a segment, in Spark's
Parquet container so that its committer deals with retried tasks and any
file system) and `parts` (the ids before each part). A segment is one byte
string, little-endian:

    4s  magic "EFT1"     u8 bytes an id (2 or 4)
    u32 documents        u32 of them with a null doc_id (they come first)
    u64 ids              u64 ids of the same part before this segment
    i64 least doc_id
    Elias-Fano list of the documents' ends (ids of the segment up to each)
    Elias-Fano list of the doc_ids less the least one (null ids left out)
    the ids

An Elias-Fano list of n ascending numbers up to u keeps the low
floor(log2(u/n)) bits of each as they are and the high parts as unary gaps:
about 2 + log2(u/n) bits a number, with every 256th one bit's position as the
select directory. Nowhere is there a table of 64-bit offsets.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.llm.tokens import END_ID, encoded, encoder, in_order, vocabulary_path
from tradewatch.session import scratch_path

MAGIC = b"EFT1"
_HEAD = struct.Struct("<4sBIIQQq")
_LIST = struct.Struct("<QBQ")
STEP = 256
#: Ids after which a segment ends (with the document).
SEGMENT_IDS = 1 << 20


class EliasFano:
    """An ascending list of non-negative integers; ``select(i)`` gives the i-th."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, marks: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.marks = n, low_bits, low, high, marks
        # Ones before each byte of the unary part, from the directory on, are counted when asked for.

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n = len(v)
        top = int(v[-1]) if n else 0
        width = max(0, (top // n).bit_length() - 1) if n else 0
        bits = ((v[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        ones = (v >> np.uint64(width)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        unary[ones] = 1
        return cls(n, width, np.packbits(bits.ravel(), bitorder="little"), np.packbits(unary, bitorder="little"),
                   ones[::STEP].astype("<u4"))

    def to_bytes(self) -> bytes:
        return (_LIST.pack(self.n, self.low_bits, len(self.high)) + self.marks.tobytes()
                + self.low.tobytes() + self.high.tobytes())

    @classmethod
    def from_bytes(cls, data: memoryview, at: int) -> tuple[EliasFano, int]:
        """The list at a position, and the position after it."""
        n, width, size = _LIST.unpack_from(data, at)
        at += _LIST.size
        marks = np.frombuffer(data, "<u4", -(-n // STEP), at)
        at += 4 * len(marks)
        low = np.frombuffer(data, np.uint8, -(-n * width // 8), at)
        at += len(low)
        high = np.frombuffer(data, np.uint8, size, at)
        return cls(n, width, low, high, marks), at + size

    def select(self, i: int) -> int:
        """The i-th number: directory, then at most STEP ones of the unary part, then its low bits."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.marks[i // STEP]), i % STEP
        first = at // 8
        head = self.high[first:first + 1] & np.uint8(0xFF << at % 8 & 0xFF)   # ones from the mark on
        size = 64
        while True:
            part = np.concatenate((head, self.high[first + 1:first + size]))
            ones = np.flatnonzero(np.unpackbits(part, bitorder="little"))
            if len(ones) > left:
                break
            size *= 4
        high = first * 8 + int(ones[left]) - i
        at = i * self.low_bits
        bits = np.unpackbits(self.low[at // 8:(at + self.low_bits + 7) // 8], bitorder="little")
        low = bits[at % 8:at % 8 + self.low_bits]
        return high << self.low_bits | sum(int(b) << k for k, b in enumerate(low))

    def all(self) -> np.ndarray:
        """Every number, in order."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        bits = np.unpackbits(self.low, bitorder="little")[:self.n * self.low_bits]
        low = bits.reshape(self.n, self.low_bits).astype(np.uint64) @ (
            np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64))
        return (high | low).astype(np.int64)


def segment(doc_ids: list[int | None], ids: list[bytes], before: int, width: int) -> bytes:
    """The bytes of a segment; `ids` holds each document's as unsigned 32-bit numbers."""
    ends = np.cumsum([len(x) // 4 for x in ids])
    nulls = sum(d is None for d in doc_ids)
    own = np.array(doc_ids[nulls:], np.int64)
    least = int(own[0]) if len(own) else 0
    body = b"".join(ids)
    if width == 2:
        body = np.frombuffer(body, "<u4").astype("<u2").tobytes()
    offset = own.view(np.uint64) - np.array([least], np.int64).view(np.uint64)
    return b"".join((_HEAD.pack(MAGIC, width, len(ids), nulls, int(ends[-1]), before, least),
                     EliasFano.of(ends).to_bytes(), EliasFano.of(offset).to_bytes(), body))


class Segment:
    """A segment's bytes, read."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        magic, width, n, self.nulls, n_ids, self.before, self.least = _HEAD.unpack_from(view)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        self.ends, at = EliasFano.from_bytes(view, _HEAD.size)
        self.docs, at = EliasFano.from_bytes(view, at)
        self.ids = np.frombuffer(view, f"<u{width}", n_ids, at)
        self.n = n

    def span(self, i: int) -> tuple[int, int]:
        """Start and end of the i-th document among the segment's ids, by select."""
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.least + self.docs.select(i - self.nulls)

    def documents(self) -> tuple[list[int | None], np.ndarray, np.ndarray]:
        """(doc_ids, starts, ends) of all documents."""
        ends = self.ends.all()
        own = (self.docs.all().view(np.uint64) + np.array([self.least], np.int64).view(np.uint64)).view(np.int64)
        return [None] * self.nulls + own.tolist(), np.concatenate(([0], ends[:-1])), ends


def write_tokens(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = END_ID,
                 segment_ids: int = SEGMENT_IDS) -> None:
    """Write the ids of all documents, in ascending order of doc_id, as a folder of the format.

    Null and empty texts give a document of the end id alone; null doc_ids
    come first; repeated rows stay; an empty table gives an empty folder.
    Documents are dealt by ranges of doc_id; a part's task keeps one segment
    in memory. The driver sees one number a part.
    """
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        width = 2 if max(encoder(path).tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        names, texts, size, k = [], [], 0, 0

        def record() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"part": part, "segment": k, "n_docs": len(names), "n_ids": size,
                                                "data": segment(names, texts, before, width)}], schema)

        for doc_ids, ids in encoded(batches, path, end_id):
            for d, x in zip(doc_ids, ids):
                names.append(d)
                texts.append(x)
                size += len(x) // 4
                if size >= segment_ids:
                    yield record()
                    before, k = before + size, k + 1
                    names, texts, size = [], [], 0
        if names:
            yield record()

    schema = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("n_docs", pa.int64()),
                        ("n_ids", pa.int64()), ("data", pa.binary())])
    (in_order(docs).mapInArrow(run, "part int, segment int, n_docs long, n_ids long, data binary")
     .write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(f"{folder}/segments"))
    spark = docs.sparkSession
    sizes = (spark.read.parquet(f"{folder}/segments").groupBy("part")
             .agg(F.sum("n_ids").alias("n")).orderBy("part").collect())      # one row a part
    starts, total = [], 0
    for r in sizes:
        starts.append((r["part"], total))
        total += r["n"]
    spark.createDataFrame(starts, "part int, base long").coalesce(1).write.parquet(f"{folder}/parts")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary) of every document of a folder.

    start counts the ids of all documents before it; ids are unsigned 32-bit
    little-endian numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for base, data in zip(b.column("base").to_pylist(), b.column("data")):
                s = Segment(data.as_buffer())
                doc_ids, starts, ends = s.documents()
                first = base + s.before
                for a in range(0, s.n, 1024):
                    part = slice(a, a + 1024)
                    ids = [s.ids[x:y].astype("<u4").tobytes() for x, y in zip(starts[part], ends[part])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc_ids[part], pa.int64()), pa.array(first + starts[part], pa.int64()),
                         pa.array(ends[part] - starts[part], pa.int64()), pa.array(ids, pa.binary())],
                        ["doc_id", "start", "n_tokens", "ids"])

    segments = spark.read.schema("part int, segment int, n_docs long, n_ids long, data binary").parquet(
        f"{folder}/segments")
    parts = spark.read.schema("part int, base long").parquet(f"{folder}/parts")
    # parts holds one short row a part: its size is bounded by the number of partitions.
    return (segments.select("part", "data").join(F.broadcast(parts), "part")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary"))


def token_folder(spark: SparkSession) -> str:
    """A fresh folder for token files below the shared folder."""
    return scratch_path(spark, "llm/tokens")
