"""Order-preserving packing of documents into training sequences by dynamic programming.

The ids of the documents, in ascending order of doc_id, form a stream. The
windows of the stream become sequences of at most `size` ids. Windows may be
cut where a document or a sentence ends and, at a higher penalty, inside a
sentence where a full window that begins at such a place ends (and every
`size` ids inside a longer sentence). The best cuts minimise, over all windows,

    padding(length) + PER_WINDOW + penalty(cut)

where padding is size - length, or nothing at a power of two, and the
penalty is 0 at a document's end, CUT_SENTENCE at a sentence's end and
CUT_INSIDE within a sentence. With f(j) the least cost of the ids before j,

    f(j) = penalty(j) + PER_WINDOW + min( size - j + min_{j-size <= i < j} (f(i) + i),
                                          min_k f(j - 2^k) )   for 2^k >= LEAST_EXACT

The inner minimum runs over a sliding window, kept in a monotone queue, so a
cut costs constant time. The stream is solved in blocks of about
BLOCK_IDS ids that end with a document; the cuts are optimal for each block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.tokens import END_ID, encoded, encoder, in_order, vocabulary_path

SIZE = 2048
PER_WINDOW, CUT_SENTENCE, CUT_INSIDE = 64.0, 1.0, 6.0
#: The shortest power of two that a window may have without padding.
LEAST_EXACT = 64
BLOCK_IDS = 1 << 18


def best_cuts(cuts: np.ndarray, penalty: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The chosen ends of windows, from the ascending possible cuts (the last one is the end).

    `cuts` must leave no gap over `size`; position 0 is implied.
    """
    at = np.concatenate(([0], cuts))
    pos, pen = at.tolist(), [0.0, *(penalty + PER_WINDOW).tolist()]
    # Cuts that lie a power of two apart: the earlier ones' indices, few.
    exact: list[list[int] | None] = [None] * len(pos)
    k = LEAST_EXACT
    while k <= size:
        i = np.searchsorted(at, at - k)
        hit = np.flatnonzero((at[i] == at - k) & (at >= k))
        for j, e in zip(hit.tolist(), i[hit].tolist()):
            if exact[j] is None:
                exact[j] = [e]
            else:
                exact[j].append(e)
        k *= 2
    cost, back = [0.0], [0]
    # Monotone queue of f(i) + i, ascending: values, indices and positions, and where it begins.
    values, held, places, head = [0.0], [0], [0], 0
    for p, extra, pairs in zip(pos[1:], pen[1:], exact[1:]):
        first = p - size
        while places[head] < first:
            head += 1
        i = held[head]
        best = values[head] + size - p
        if pairs is not None:
            for e in pairs:
                if cost[e] <= best:
                    best, i = cost[e], e
        best += extra
        value = best + p
        while len(values) > head and values[-1] >= value:
            values.pop()
            held.pop()
            places.pop()
        values.append(value)
        held.append(len(cost))
        places.append(p)
        cost.append(best)
        back.append(i)
    chosen, j = [], len(pos) - 1
    while j:
        chosen.append(pos[j])
        j = back[j]
    return np.array(chosen[::-1], np.int64)


def possible_cuts(ids: np.ndarray, ends: np.ndarray, enders: np.ndarray,
                  size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """(cuts, penalties): document ends, sentence ends, ends of full windows that begin at one
    of these, and steps of `size` in longer gaps."""
    mark = np.zeros(len(ids) + 1, np.int8)
    mark[np.flatnonzero(np.isin(ids, enders)) + 1] = 2
    mark[ends] = 1
    cuts = np.flatnonzero(mark)
    gap = np.diff(np.concatenate(([0], cuts)))
    for j in np.flatnonzero(gap > size):
        mark[np.arange(cuts[j] - gap[j] + size, cuts[j], size)] = 3
    full = cuts + size
    full = full[full < len(ids)]
    mark[full[mark[full] == 0]] = 3
    cuts = np.flatnonzero(mark)
    return cuts, np.array([0.0, 0.0, CUT_SENTENCE, CUT_INSIDE])[mark[cuts]]


def pack_documents(docs: DataFrame, vocabulary: str | None = None, size: int = SIZE,
                   end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents: (doc_id, start, length, ids, doc_tokens, sequence_id, offset).

    A piece is a run of one document's ids in one sequence: start counts the
    document's ids before it, ids are unsigned 32-bit little-endian numbers,
    doc_tokens counts all ids of the document with the end id, offset is the
    place in the sequence. Every id lies in one piece. Null and empty texts
    are documents of the end id alone; rows with null doc_id come first;
    repeated rows are packed each; an empty table gives no piece.
    """
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enders = encoder(path).sentence_enders()
        sequence = TaskContext.get().partitionId() << 32

        def block(names: list[int | None], texts: list[bytes]) -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            body = b"".join(texts)
            ids = np.frombuffer(body, "<u4")
            ends = np.cumsum([len(x) // 4 for x in texts])
            windows = best_cuts(*possible_cuts(ids, ends, enders, size), size)
            stops = np.union1d(windows, ends)
            starts = np.concatenate(([0], stops[:-1]))
            doc = np.searchsorted(ends, starts, "right")
            window = np.searchsorted(windows, starts, "right")
            doc_start = np.concatenate(([0], ends[:-1]))[doc]
            offset = starts - np.concatenate(([0], windows[:-1]))[window]
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[d] for d in doc], pa.int64()), pa.array(starts - doc_start, pa.int64()),
                 pa.array(stops - starts, pa.int64()),
                 pa.array([body[4 * a:4 * b] for a, b in zip(starts.tolist(), stops.tolist())], pa.binary()),
                 pa.array(ends[doc] - doc_start, pa.int64()), pa.array(sequence + window, pa.int64()),
                 pa.array(offset, pa.int64())],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
            sequence += len(windows)

        names, texts, n = [], [], 0
        for doc_ids, ids in encoded(batches, path, end_id):
            for d, x in zip(doc_ids, ids):
                names.append(d)
                texts.append(x)
                n += len(x) // 4
                if n >= BLOCK_IDS:
                    yield from block(names, texts)
                    names, texts, n = [], [], 0
        if names:
            yield from block(names, texts)

    return in_order(docs).mapInArrow(
        run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the unsigned crc32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
