"""Hashed maximum-entropy language model with a class-factored softmax.

    P(word | history) = P(class(word) | history) * P(word | class, class of the previous word)

* Class stage: log-linear over CLASSES classes. Features of the history are
  the previous word, the previous two words, and the skip words two and three
  back, each hashed to a row of weights (BUCKETS rows at least, and as many as model words).
* Word stage: log-linear within a class over the words seen LEAST_COUNT times,
  with a weight for each word and each (word, class of the previous word).
* All other words form the class `rare`, where a word counts c + 1 (c: its
  training count) and an unknown word 1. So the probabilities of the V known
  words and the unknown one sum to 1 for every history.

Training: a trainer for each core of the cluster runs minibatch gradient steps over its
documents from the common weights; the changes are averaged, weighted by tokens, in
rounds. Sums of trainers' tables are made in levels of at most FAN tables a group. The
word stage is fitted in Spark too, a group for each (class, previous class): given the
words' own weights, these columns don't depend on each other. Neighbourhoods, pair
counts and gradient sums are sparse blocks in Spark; the driver gathers the model words
and the finished weights, which grow with the vocabulary. Tables of weights travel
rounded: a byte a weight and a scale a row in the class stage, float16 in the word
stage. Log probabilities are normalised over the rounded weights, so rounding doesn't
make them sum to more or less than one. Counts of all words stay in a written table and are joined to the
documents' rare words.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import binary_list, doc_texts, slices, split_train, written

HELD_OUT, MODULUS = 2, 7
#: Model words: all that were seen so often.
LEAST_COUNT = 3
CLASSES = 32                 # the last is `rare`
#: Least rows of weights; as many as model words where there are more (in whole blocks).
BUCKETS = 1 << 16
#: Most frequent words that a word's neighbourhood is described by, and its reach.
CONTEXT, REACH = 64, 3
#: Words of a block of neighbourhoods; blocks of frequent words that a task counts before it reports
#: them, and from which the first centres are picked.
ROWS, HEAD = 1024, 16
#: Rows of weights in a block.
WEIGHT_ROWS = 4096
ROUNDS, BATCH, RATE = 2, 8192, 0.5
#: Most rows of a run that is added up place by place.
SHORT = 8
#: Tables added up in one group.
FAN = 16
#: Steps of the word stage and the weight of its prior (in tokens).
WORD_STEPS, PRIOR = 25, 2.0
#: The end of a text as a token; no word holds a blank.
END = b"\n"

_SALTS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint64)


def tokens(text: bytes) -> list[bytes]:
    """Words (A-Z lower-cased, split at the six ASCII blanks), then the end."""
    return [*text.lower().split(), END]


def split_words(joined: bytes) -> list[bytes]:
    return joined.split(b" ") if joined else []


def encoded_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(different words with END as the last, each token's place among them, texts' numbers of tokens): the
    `tokens` of a string column (null: empty), encoded in Arrow."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    words = lists.flatten()
    full = pc.greater(pc.binary_length(words), 0)      # blanks at the ends of a text leave empty words
    if not pc.all(full).as_py():
        of = np.repeat(np.arange(len(lengths)), lengths)
        lengths = np.bincount(of[full.to_numpy(zero_copy_only=False)], minlength=len(lengths))
        words = words.filter(full)
    words = words.dictionary_encode()
    ends = np.cumsum(lengths + 1) - 1
    places = np.empty(len(words) + len(ends), np.int32)
    inside = np.ones(len(places), bool)
    inside[ends] = False
    places[inside] = words.indices.to_numpy(zero_copy_only=False)
    places[ends] = len(words.dictionary)
    return pa.concat_arrays([words.dictionary.cast(pa.binary()), pa.array([END], pa.binary())]), places, lengths + 1


def word_counts(docs: DataFrame) -> DataFrame:
    """(word binary, n) over documents (doc_id, text), ends included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            words, places, _ = encoded_words(b.column("text"))
            yield pa.RecordBatch.from_arrays([words, pa.array(np.bincount(places, minlength=len(words)))], ["word", "n"])

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def indexed(docs: DataFrame, vocabulary: bytes) -> DataFrame:
    """(row, doc_id, held_out, n_tokens, ids, rare): ids are ranks in the vocabulary (words parted by blanks;
    int32 bytes, their number for other words), rare those other words in order. `row` numbers the documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 33
        ranked = pc.split_pattern(pa.array([shared.value] if shared.value else [], pa.binary()), " ").flatten()
        other = len(ranked)
        for b in slices(batches, "text"):
            words, places, n = encoded_words(b.column("text"))
            # The smaller list is the one that is hashed.
            found = pc.index_in(ranked, words)
            rank = np.full(len(words), other, np.int32)
            rank[found.drop_null().to_numpy()] = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
            ids = rank.take(places)
            starts = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
            rare = np.flatnonzero(ids == other)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(key, key + b.num_rows), pa.int64()), b.column("doc_id"), b.column("held_out"), pa.array(n),
                 pa.Array.from_buffers(pa.binary(), b.num_rows, [None, pa.py_buffer(4 * starts), pa.py_buffer(ids)]),
                 pa.ListArray.from_arrays(np.searchsorted(rare, starts).astype(np.int32),
                                          words.take(pa.array(places[rare])))],
                ["row", "doc_id", "held_out", "n_tokens", "ids", "rare"])
            key += b.num_rows

    out = written(docs.mapInArrow(run, "row long, doc_id long, held_out boolean, n_tokens long, ids binary, "
                                       "rare array<binary>"), "indexed")
    shared.destroy()
    return out


_SPARSE = pa.schema([("task", pa.int64()), ("block", pa.int32()), ("data", pa.binary()), ("n", pa.binary()),
                     ("tokens", pa.int64())])
_SPARSE_DDL = "task long, block int, data binary, n binary, tokens long"


def _sparse(task: int, keys: np.ndarray, n: np.ndarray, edges: np.ndarray) -> pa.RecordBatch:
    """Counts at ascending places of a table that is cut at `edges`: a row a block, places from its start."""
    cut = np.searchsorted(keys, edges)
    found = np.flatnonzero(np.diff(cut))
    return pa.RecordBatch.from_pylist(
        [{"task": task, "block": int(k), "data": (keys[cut[k]:cut[k + 1]] - edges[k]).astype(np.int32).tobytes(),
          "n": n[cut[k]:cut[k + 1]].astype(np.float32).tobytes(), "tokens": 0} for k in found], _SPARSE)


def in_levels(rows: DataFrame, tasks: int, add: Callable[[pd.DataFrame], tuple[bytes, bytes, int]]) -> DataFrame:
    """(task, block, data, n, tokens): tasks' tables put together by `add` block by block, FAN tasks at a
    time, until each block is one row, whatever numbers the tasks have."""
    def level(pdf: pd.DataFrame) -> pd.DataFrame:
        data, n, count = add(pdf)
        return pd.DataFrame({"task": [pdf["task"].iloc[0] // FAN], "block": [pdf["block"].iloc[0]], "data": [data],
                             "n": [n], "tokens": [count]})

    while tasks > FAN:
        rows = rows.groupBy(F.expr(f"task div {FAN}").alias("g"), "block").applyInPandas(level, _SPARSE_DDL)
        tasks = -(-tasks // FAN)
    return rows.groupBy("block").applyInPandas(level, _SPARSE_DDL)


def packed_rows(rows: np.ndarray) -> bytes:
    """Rows of CLASSES floats as a float16 scale each, then a byte a value (127: the scale)."""
    scale = np.abs(rows).max(axis=1, initial=0).astype(np.float16)
    step = np.maximum(scale.astype(np.float32), 1e-7)[:, None] / 127
    return scale.tobytes() + np.clip(np.rint(rows / step), -127, 127).astype(np.int8).tobytes()


def unpacked_rows(data: bytes) -> np.ndarray:
    """float32 rows of what `packed_rows` made."""
    n = len(data) // (CLASSES + 2)
    scale = np.frombuffer(data, np.float16, n).astype(np.float32)
    return np.frombuffer(data, np.int8, offset=2 * n).reshape(n, CLASSES) * (scale / 127)[:, None]


class PackedTable:
    """Packed blocks of WEIGHT_ROWS rows as one table whose rows are unpacked when they are taken."""

    def __init__(self, blocks: list[bytes]) -> None:
        self.values = np.empty((len(blocks) * WEIGHT_ROWS, CLASSES), np.int8)
        self.scale = np.empty(len(self.values), np.float32)
        for k, b in enumerate(blocks):
            self.put(k, b)

    def put(self, k: int, block: bytes) -> None:
        """Block k anew."""
        rows = slice(k * WEIGHT_ROWS, (k + 1) * WEIGHT_ROWS)
        self.scale[rows] = np.frombuffer(block, np.float16, WEIGHT_ROWS).astype(np.float32) / 127
        self.values[rows] = np.frombuffer(block, np.int8, offset=2 * WEIGHT_ROWS).reshape(WEIGHT_ROWS, CLASSES)

    def take(self, rows: np.ndarray, axis: int = 0) -> np.ndarray:
        out = self.values.take(rows, axis=axis).astype(np.float32)
        out *= self.scale.take(rows)[:, None]
        return out

    def block(self, k: int) -> np.ndarray:
        return self.take(np.arange(k * WEIGHT_ROWS, (k + 1) * WEIGHT_ROWS))

    def unpacked(self) -> np.ndarray:
        """All rows, without a second copy of the table."""
        out = np.empty(self.values.shape, np.float32)
        for k in range(len(out) // WEIGHT_ROWS):
            out[k * WEIGHT_ROWS:(k + 1) * WEIGHT_ROWS] = self.block(k)
        return out


def unpacked_table(blocks: list[bytes]) -> np.ndarray:
    """All rows of packed blocks of WEIGHT_ROWS rows."""
    return PackedTable(blocks).unpacked()


def counts_summed(pdf: pd.DataFrame) -> tuple[bytes, bytes, int]:
    """Sparse counts (places, float32 each) of one block added up."""
    every = np.concatenate([np.frombuffer(x, np.int32) for x in pdf["data"]])
    n = np.concatenate([np.frombuffer(x, np.float32) for x in pdf["n"]])
    at, back = np.unique(every, return_inverse=True)
    return at.tobytes(), np.bincount(back, n).astype(np.float32).tobytes(), 0


def changes_summed(pdf: pd.DataFrame) -> tuple[bytes, bytes, int]:
    """Mean change of one block of weights (places of rows, packed rows), weighted by tokens."""
    total = np.zeros((WEIGHT_ROWS, CLASSES), np.float32)
    tokens = int(pdf["tokens"].sum())
    for at, n, k in zip(pdf["data"], pdf["n"], pdf["tokens"]):
        total[np.frombuffer(at, np.int32)] += unpacked_rows(n) * np.float32(k / tokens)
    at = np.flatnonzero(total.any(axis=1)).astype(np.int32)
    return at.tobytes(), packed_rows(total[at]), tokens


def _id_lists(batches: Iterator[pa.RecordBatch], limit: int = 4 << 20) -> Iterator[list[np.ndarray]]:
    return ([np.frombuffer(x, np.int32) for x in binary_list(b.column("ids"))] for b in slices(batches, "ids", limit))


def neighbours(docs: DataFrame, words: int) -> DataFrame:
    """(block, data, n): how often (float32) each word has each of the CONTEXT most frequent words within
    REACH places; data: the places (int32) other than 0 of a written block of ROWS words x 2 CONTEXT."""
    width = 2 * CONTEXT
    edges = np.arange(-(-words // ROWS) + 1) * ROWS * width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        head = np.zeros(min(HEAD * ROWS, words) * width, np.float32)
        gap = np.full(REACH, max(words, CONTEXT), np.int32)        # parts the documents; no neighbour of any word
        for lists in _id_lists(batches):
            every = np.concatenate([gap, *chain.from_iterable((ids, gap) for ids in lists)])
            often, model = np.flatnonzero(every < CONTEXT), every < words
            found = []
            for d in range(1, REACH + 1):
                for side, step in ((0, d), (CONTEXT, -d)):
                    at = often[model[often + step]]
                    found.append(every[at + step].astype(np.int64) * width + side + every[at])
            found = np.concatenate(found)
            low = found < len(head)
            head += np.bincount(found[low], minlength=len(head))
            at, n = np.unique(found[~low], return_counts=True)
            yield _sparse(task, at, n, edges)
        at = np.flatnonzero(head)
        yield _sparse(task, at, head[at], edges)

    found = docs.select("ids").mapInArrow(run, _SPARSE_DDL)
    return written(in_levels(found, docs.rdd.getNumPartitions(), counts_summed).select("block", "data", "n"), "neighbours")


def _directions(data: bytes, n: bytes, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit vectors of a block's neighbourhoods, weights); words without neighbours are 0."""
    table = np.zeros(ROWS * 2 * CONTEXT)
    table[np.frombuffer(data, np.int32)] = np.frombuffer(n, np.float32)
    table = table.reshape(ROWS, 2 * CONTEXT)
    share = table / np.maximum(columns, 1)
    x = np.sqrt(share / np.maximum(share.sum(axis=1, keepdims=True), 1e-300)).astype(np.float32)
    return x, np.sqrt(table.sum(axis=1, keepdims=True)).astype(np.float32)


def _each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes, bytes]]:
    for b in batches:
        for k in range(b.num_rows):
            yield b.column("block")[k].as_py(), b.column("data")[k].as_buffer(), b.column("n")[k].as_buffer()


def cluster(blocks: DataFrame, words: int, k: int, steps: int = 12) -> np.ndarray:
    """A class for each word (blocks of rows by falling frequency): spherical k-means of their
    neighbourhoods. In a step each task adds up the centres of its blocks; the driver adds the tasks'."""
    spark = blocks.sparkSession
    width = 2 * CONTEXT

    def over_tasks(shape: tuple[int, ...], work: Callable[[bytes, bytes], np.ndarray]) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for _, data, n in _each_block(batches):
                total += work(data, n)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["data"])

        return np.sum([np.frombuffer(r["data"]).reshape(shape) for r in blocks.mapInArrow(run, "data binary").collect()]
                      or [np.zeros(shape)], axis=0)

    columns = over_tasks((width,), lambda data, n: np.bincount(
        np.frombuffer(data, np.int32) % width, np.frombuffer(n, np.float32), width))
    heads = {r["block"]: _directions(r["data"], r["n"], columns) for r in blocks.where(F.col("block") < HEAD).collect()}
    blank = np.zeros((ROWS, width), np.float32), np.zeros((ROWS, 1), np.float32)
    parts = [tuple(v[:words - i * ROWS] for v in heads.get(i, blank)) for i in range(min(HEAD, -(-words // ROWS)))]
    x, weight = (np.concatenate(v) for v in zip(*parts))
    k = min(k, len(x))
    centre = x[:1]
    near = x @ centre[0]
    for _ in range(k - 1):          # frequent words that are unlike the centres so far
        pick = int(((1.001 - near) * weight[:, 0]).argmax())
        centre = np.concatenate((centre, x[pick:pick + 1]))
        near = np.maximum(near, x @ x[pick])
    for _ in range(steps):
        shared = spark.sparkContext.broadcast((centre, columns))

        def add(data: bytes, n: bytes, shared=shared) -> np.ndarray:
            centre, columns = shared.value
            x, weight = _directions(data, n, columns)
            own = (x @ centre.T).argmax(axis=1)[:, None] == np.arange(len(centre))
            return own.astype(np.float32).T @ (x * weight)

        total = over_tasks(centre.shape, add)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        centre = np.where(norm > 0, total / np.maximum(norm, 1e-30), centre).astype(np.float32)
    shared = spark.sparkContext.broadcast((centre, columns))

    def labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, columns = shared.value
        for i, data, n in _each_block(batches):
            near = (_directions(data, n, columns)[0] @ centre.T).argmax(axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_pylist([{"block": i, "data": near.tobytes()}],
                                             pa.schema([("block", pa.int32()), ("data", pa.binary())]))

    label = np.zeros(words, np.int64)
    for r in blocks.mapInArrow(labels, "block int, data binary").collect():
        part = label[r["block"] * ROWS:(r["block"] + 1) * ROWS]
        part[:] = np.frombuffer(r["data"], np.uint8)[:len(part)]
    return label


def rows_of_weights(words: int) -> int:
    """BUCKETS, or as many as there are model words, in whole blocks."""
    return max(BUCKETS, -(-words // WEIGHT_ROWS) * WEIGHT_ROWS)


@dataclass
class Words:
    """The model's words in the order of their classes. ids: 0..n-1 words, n rare, n + 1 before the text."""

    order: np.ndarray        # rank in the vocabulary -> id (the last entry: rare)
    classes: np.ndarray      # id -> class; the place before the text has a class of its own
    sizes: np.ndarray        # words of each class but `rare`
    counts: np.ndarray       # id -> training count
    buckets: int             # rows of weights

    @classmethod
    def of(cls, label: np.ndarray, counts: np.ndarray, buckets: int = BUCKETS) -> Words:
        n = len(label)
        by_class = np.argsort(label, kind="stable")
        order = np.empty(n + 1, np.int32)
        order[by_class] = np.arange(n)
        order[n] = n
        return cls(order, np.concatenate((label[by_class], [CLASSES - 1, CLASSES])).astype(np.int32),
                   np.bincount(label, minlength=CLASSES - 1), counts[by_class], buckets)

    @property
    def n(self) -> int:
        return len(self.order) - 1

    def history(self, ranks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, features tokens x 4, class of the previous word) of documents one after the other."""
        gap = np.full(3, self.n + 1, np.int32)
        parts = list(chain.from_iterable((gap, self.order[r]) for r in ranks))
        every = np.concatenate(parts)
        lengths = np.array([len(r) for r in ranks])
        at = np.arange(lengths.sum()) + np.repeat(3 * np.arange(1, len(ranks) + 1), lengths)
        one, two, three = (every[at - d].astype(np.uint64) + np.uint64(1) for d in (1, 2, 3))
        # A column at a time: the 64-bit keys of all four would be several times the result.
        features = np.empty((len(at), 4), np.int32)
        for k, key in enumerate((one, one * np.uint64(0x1000003) + two, two, three)):
            h = key * _SALTS[k] + np.uint64(k)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            features[:, k] = (h >> np.uint64(40)) % np.uint64(self.buckets)
        return every[at], features, self.classes[every[at - 1]]


def class_scores(weights: np.ndarray | PackedTable, bias: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scores, log of the sum of their exponentials), tokens x CLASSES and tokens x 1."""
    columns = np.ascontiguousarray(features.T, np.intp)
    z = np.add(weights.take(columns[0], axis=0), bias, dtype=np.float32)
    for rows in columns[1:]:
        z += weights.take(rows, axis=0)
    z -= np.ascontiguousarray(z.T).max(axis=0)[:, None]       # a row's maximum would be found a row at a time
    return z, np.log(np.exp(z).sum(axis=1, keepdims=True))


def class_log_probs(weights: np.ndarray | PackedTable, bias: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Natural log of P(class | history), tokens x CLASSES."""
    z, log_sum = class_scores(weights, bias, features)
    z -= log_sum
    return z


def sums_of_runs(values: np.ndarray, at: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values[at] from each place of `first` to the next, in double precision. Most runs are of one
    row; short ones are added place by place, long ones a column at a time."""
    out = values.take(at[first], axis=0)
    length = np.diff(first, append=len(at))
    short = np.flatnonzero((length > 1) & (length <= SHORT))
    total = out[short].astype(np.float64)
    for k in range(1, SHORT):
        more = np.flatnonzero(length[short] > k)
        total[more] += values.take(at[first[short[more]] + k], axis=0)
    out[short] = total
    many = np.flatnonzero(length > SHORT)
    if len(many):
        rows = values.take(at[np.repeat(length > SHORT, length)], axis=0)
        ends = np.cumsum(length[many])
        out[many] = np.add.reduceat(np.ascontiguousarray(rows.T, np.float64), ends - length[many], axis=1).T
    return out


def pair_counts(task: int, lists: Iterator[list[np.ndarray]], words: Words) -> Iterator[pa.RecordBatch]:
    """How often each word follows each class; block class * (CLASSES + 1) + previous class, place in the class."""
    sizes, width = words.sizes, CLASSES + 1
    starts = np.concatenate(([0], np.cumsum(sizes)))
    edges = np.concatenate(([0], np.cumsum(np.repeat(sizes, width))))
    for ranks in lists:
        ids = np.concatenate([words.order[r] for r in ranks] or [np.zeros(0, np.int32)])
        if not len(ids):
            continue
        before = words.classes[np.concatenate(([words.n + 1], ids[:-1]))]
        before[np.cumsum([0] + [len(r) for r in ranks[:-1]])] = CLASSES
        own = ids < words.n
        ids, before = ids[own].astype(np.int64), before[own]
        of = words.classes[ids]
        at, n = np.unique(starts[of] * width + before * sizes[of] + ids - starts[of], return_counts=True)
        yield _sparse(task, at, n, edges)


def train_task(task: int, lists: Iterator[list[np.ndarray]], words: Words, start: PackedTable,
               bias: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A trainer's gradient steps: the change of the weights that it touched, in blocks of rows, and its tokens.
    `start`: the common weights."""
    pa.default_memory_pool().release_unused()
    weights = start.unpacked()
    scale = np.full(len(weights), 1.0, np.float32)
    n = 0
    for ranks in lists:
        if not ranks:
            continue
        ids, features, _ = words.history(ranks)
        target = words.classes[ids]
        n += len(ids)
        for a in range(0, len(ids), BATCH):
            f, y = features[a:a + BATCH], target[a:a + BATCH]
            wrong = np.exp(class_log_probs(weights, bias, f))
            wrong[np.arange(len(y)), y] -= 1
            flat = f.ravel()
            order = np.argsort(flat.astype(np.uint16), kind="stable")      # 16-bit keys sort by radix
            if len(weights) > 1 << 16:
                order = order[np.argsort((flat >> 16).astype(np.uint16)[order], kind="stable")]
            flat = flat[order]
            first = np.flatnonzero(np.diff(flat, prepend=-1))
            rows = flat[first].astype(np.intp)
            slope = sums_of_runs(wrong, order // f.shape[1], first)
            total = scale.take(rows) + np.einsum("ij,ij->i", slope, slope)
            scale[rows] = total
            slope *= (RATE / np.sqrt(total))[:, None]
            weights[rows] = np.subtract(weights.take(rows, axis=0), slope, out=slope)
    touched = np.flatnonzero(scale != 1)
    for k, rows in enumerate(np.split(touched, np.searchsorted(touched, np.arange(WEIGHT_ROWS, len(weights), WEIGHT_ROWS)))):
        if len(rows):
            inside = rows - k * WEIGHT_ROWS
            change = packed_rows(weights[rows] - start.take(rows))
            yield pa.RecordBatch.from_pylist(
                [{"task": task, "block": k, "data": inside.astype(np.int32).tobytes(), "n": change, "tokens": n}], _SPARSE)


def fit_column(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """(weights, log of the sum of their exponentials) of one class's words after one previous class, by
    gradient steps on the weights around the words' own, log(counts). The weights are rounded to float16."""
    own = np.log(np.maximum(counts, 1e-9))
    weights = np.zeros(len(pairs))
    total = pairs.sum()

    def log_sum() -> float:
        z = own + weights
        return float(z.max() + np.log(np.exp(z - z.max()).sum()))

    for _ in range(WORD_STEPS):
        expected = total * np.exp(own + weights - log_sum())
        weights += np.clip((pairs - expected - PRIOR * weights) / (np.maximum(expected, pairs) + PRIOR), -1, 1) * 0.7
    rounded = weights.astype(np.float16)
    weights = rounded.astype(np.float64)
    return rounded, log_sum()


@dataclass
class Model:
    """Training statistics and the model; the words' counts stay in the written table `counts`."""

    counts: DataFrame
    total: int                   # N: training tokens
    distinct: int                # V
    joined: bytes                # model words by falling count, parted by blanks
    words: Words
    table: PackedTable           # weights
    bias: np.ndarray
    after: np.ndarray            # weight of (word, previous class), id x (CLASSES + 1), float16
    log_sums: np.ndarray         # class x previous class: what makes them probabilities
    rare_mass: float             # of rare words, c + 1 each, and 1 for the unknown word

    @property
    def vocabulary(self) -> list[bytes]:
        return split_words(self.joined)

    @property
    def weights(self) -> np.ndarray:
        return self.table.unpacked()

    @property
    def in_class(self) -> np.ndarray:
        """log10 P(word | class, previous class), id x (CLASSES + 1)."""
        own = np.log(np.maximum(self.words.counts, 1e-9))[:, None]
        return (own + self.after - self.log_sums[self.words.classes[:self.words.n]]) / math.log(10)


def learn(docs: DataFrame, model_words: int | None = None) -> tuple[Model, DataFrame]:
    """The model of the documents (doc_id, text, held_out) that are not held out, and all documents indexed.

    Model words are all words seen LEAST_COUNT times, or the `model_words` most frequent of them.
    """
    spark = docs.sparkSession
    counts = written(word_counts(docs.where(~F.col("held_out"))), "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    frequent = counts.where(F.col("n") >= LEAST_COUNT).orderBy(F.desc("n"), "word")
    top = (frequent if model_words is None else frequent.limit(model_words)).toArrow()
    size, n = top.num_rows, top.column("n").to_numpy().astype(np.float64)
    # In Arrow: an object a word would stay in pieces in the driver's memory.
    every = pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), pa.concat_arrays(
        [pa.array([], pa.binary()), *(c.cast(pa.binary()) for c in top.column("word").chunks)]))
    joined = pc.binary_join(every, b" ")[0].as_py()
    del top, every
    rare_mass = float(total - n.sum()) + (distinct - size) + 1
    rows = indexed(docs, joined)
    own = rows.where(~F.col("held_out"))

    label = cluster(neighbours(own, size), size, CLASSES - 1) if size else np.zeros(0, int)
    buckets = rows_of_weights(size)
    words = Words.of(label, n, buckets)
    share = np.bincount(words.classes[:size], n, minlength=CLASSES)
    share[CLASSES - 1] += max(total - n.sum(), 0)
    bias = np.log((share + 1) / (share + 1).sum()).astype(np.float32)
    table = PackedTable([packed_rows(np.zeros((WEIGHT_ROWS, CLASSES), np.float32))] * (buckets // WEIGHT_ROWS))
    trainers = spark.sparkContext.defaultParallelism
    for k in range(ROUNDS):
        start = spark.sparkContext.broadcast((replace(words, counts=n[:0]), table, bias))    # training needs no counts
        part = own.where(F.pmod(F.xxhash64("row"), F.lit(ROUNDS)) == k)

        def train(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            yield from train_task(TaskContext.get().partitionId(), _id_lists(batches, 1 << 20), *start.value)

        trained = max(part.agg(F.sum("n_tokens")).first()[0] or 0, 1)
        changes = in_levels(part.select("ids").coalesce(trainers).mapInArrow(train, _SPARSE_DDL), trainers, changes_summed)
        # Blocks come to the driver one file at a time, beside the table that they are added to.
        for r in written(changes, "changes").toLocalIterator():
            block = table.block(r["block"])
            block[np.frombuffer(r["data"], np.int32)] += unpacked_rows(r["n"]) * np.float32(r["tokens"] / trained)
            table.put(r["block"], packed_rows(block))
        start.destroy()

    shared = spark.sparkContext.broadcast(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from pair_counts(TaskContext.get().partitionId(), _id_lists(batches), shared.value)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, counts = shared.value.sizes, shared.value.counts
        ends = np.cumsum(sizes)
        for k, data, n in _each_block(batches):
            c = k // (CLASSES + 1)
            pairs = np.zeros(sizes[c])
            pairs[np.frombuffer(data, np.int32)] = np.frombuffer(n, np.float32)
            found, log_sum = fit_column(pairs, counts[ends[c] - sizes[c]:ends[c]])
            yield pa.RecordBatch.from_pylist([{"block": k, "data": found.tobytes(), "log_sum": log_sum}], pa.schema(
                [("block", pa.int32()), ("data", pa.binary()), ("log_sum", pa.float64())]))

    pairs = in_levels(own.select("ids").mapInArrow(count, _SPARSE_DDL), own.rdd.getNumPartitions(), counts_summed)
    # Written first: a task that sums and fits would have two Python workers.
    pairs = written(pairs.select("block", "data", "n"), "pairs")
    after = np.zeros((size, CLASSES + 1), np.float16)
    # Without pairs a column has no weights but the words' own.
    sums = np.bincount(words.classes[:size], np.maximum(words.counts, 1e-9), CLASSES)
    log_sums = np.repeat(np.log(np.maximum(sums, 1e-9))[:, None], CLASSES + 1, axis=1)
    ends = np.cumsum(words.sizes)
    fitted = written(pairs.mapInArrow(fit, "block int, data binary, log_sum double"), "fitted")
    for r in fitted.toLocalIterator():
        c, before = divmod(r["block"], CLASSES + 1)
        after[ends[c] - words.sizes[c]:ends[c], before] = np.frombuffer(r["data"], np.float16)
        log_sums[c, before] = r["log_sum"]
    shared.destroy()
    return Model(counts, total, distinct, joined, words, table, bias, after, log_sums, rare_mass), rows


def score(docs: DataFrame, model_words: int | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document row.

    base_score is the add-one unigram log10 probability, score the model's.
    Null and empty texts are the end token alone. Repeated rows stay and count
    in training; null doc_ids are not held out; without any training document
    every word is unknown. Other columns are ignored.
    """
    docs = doc_texts(docs).withColumn("held_out", split_train(HELD_OUT, MODULUS))
    model, rows = learn(docs, model_words)
    denominator = math.log10(model.total + model.distinct + 1)
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.words, model.table, model.bias, model.after, model.log_sums))
    rare_log = math.log10(model.rare_mass)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weights, bias, after, log_sums = shared.value
        for b in slices(batches, "ids", 1 << 20):
            ranks = [np.frombuffer(x, np.int32) for x in binary_list(b.column("ids"))]
            ids, features, before = words.history(ranks)
            known = ids < words.n
            value, base = np.where(known, 0.0, -rare_log), np.zeros(len(ids))
            target = words.classes[ids]
            i, p = ids[known], before[known]
            n = words.counts[i]
            base[known] = np.log10(n + 1)
            value[known] += (np.log(np.maximum(n, 1e-9)) + after[i, p] - log_sums[target[known], p]) / math.log(10)
            for a in range(0, len(ids), BATCH):
                y = target[a:a + BATCH]
                z, log_sum = class_scores(weights, bias, features[a:a + BATCH])
                value[a:a + BATCH] += (z[np.arange(len(y)), y] - log_sum[:, 0]).astype(np.float64) / math.log(10)
            starts = np.concatenate(([0], np.cumsum([len(r) for r in ranks])[:-1]))
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("doc_id"), b.column("held_out"), b.column("n_tokens"),
                 pa.array(np.add.reduceat(known, starts, dtype=np.int64)),
                 pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(value, starts))],
                ["row", "doc_id", "held_out", "n_tokens", "n_top", "base_top", "score_top"])

    scored = rows.select("row", "doc_id", "held_out", "n_tokens", "ids").mapInArrow(
        run, "row long, doc_id long, held_out boolean, n_tokens long, n_top long, base_top double, score_top double")
    # Counts of rare words, joined by word; unknown words add log10(1) = 0.
    rare = (rows.select("row", F.explode("rare").alias("word")).join(model.counts, "word")
            .groupBy("row").agg(F.count("*").alias("n_rare"), F.sum(F.log10(F.col("n") + 1.0)).alias("logs")))
    logs, n_rare = F.coalesce("logs", F.lit(0.0)), F.coalesce("n_rare", F.lit(0))
    return scored.join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_top") + n_rare).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base_top") + logs - F.col("n_tokens") * denominator).alias("base_score"),
        (F.col("score_top") + logs).alias("score"))
