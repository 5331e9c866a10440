"""Exact inner-product search with a ball tree per shard (branch and bound).

1. Vectors become integers, so scores are exact. Rows are cut into shards of
   SHARD_ROWS rows, whatever their keys, and each shard's ball tree is built once
   and written: one row a shard, of bounded size.
2. Queries, a stated set, are answered in blocks of a bounded number of bytes;
   a block is broadcast and every task searches its shards with it. No row is
   copied per query, and no query per row.
3. In a tree no row of a ball scores more than q.c + |q| r (c centre, r radius).
   Nodes that can't beat the query's k-th best are cut off, level by level, and the
   leaves left are searched from the highest bound down, cutting again in between.
4. The k-th best is shared: a task carries it from shard to shard, and a first round
   over one shard in SEED_SHARDS gives every other task a lower bound to start with.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewatch.llm.common import numbered, written
from tradewatch.session import scratch_path

#: Fixed value of the contract: a component x becomes floor(SCALE * x).
SCALE = 1024
K = 10
#: Rows of a shard and of a leaf; shards in a file.
SHARD_ROWS, LEAF_ROWS, FILE_SHARDS = 4096, 64, 64
#: Bytes of a block of queries.
BLOCK_BYTES = 8 << 20
#: One shard in so many is searched first, for the others' lower bounds.
SEED_SHARDS = 8
#: Inner products of 64-bit floats are exact below this.
EXACT = 1 << 53
LOWEST = -(1 << 63)

SHARD = ("shard long, ids binary, rows binary, centres binary, radii binary, first binary, last binary, least binary")
FOUND = "query_id long, vec_id long, score long"
RESULT = "query_id long, rank int, vec_id long, score long"


def largest(dimension: int) -> int:
    """The components' bound: scores of vectors within it fit a long (and they fit an int)."""
    return min((1 << 31) - 1, isqrt(((1 << 63) - 1) // max(dimension, 1)))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, x array<long>) of the vectors that take part, of any length but 0."""
    c = F.transform("embedding", lambda v: v.cast("double"))
    odd = F.exists("c", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) >= float(1 << 31)))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), c.alias("c"))
            .where(F.col("vec_id").isNotNull() & F.col("c").isNotNull() & (F.size("c") > 0) & ~F.coalesce(odd, F.lit(True)))
            .select("vec_id", F.transform("c", lambda v: F.floor(v * SCALE)).alias("x")))


@dataclass
class Tree:
    """A complete binary tree over `rows` (in tree order): node i has children 2i + 1 and 2i + 2 and
    the rows first[i] to last[i]."""

    ids: np.ndarray
    rows: np.ndarray
    centres: np.ndarray
    radii: np.ndarray
    first: np.ndarray
    last: np.ndarray
    least: np.ndarray       # the smallest vec_id of a node, which decides ties

    @staticmethod
    def build(ids: np.ndarray, rows: np.ndarray) -> Tree:
        n, levels = len(ids), 0
        while n > LEAF_ROWS << levels:
            levels += 1
        nodes = (2 << levels) - 1
        order = np.lexsort((ids,))
        x = rows.astype(np.float64)
        first, last = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        centres, radii, least = np.zeros((nodes, x.shape[1])), np.zeros(nodes), np.zeros(nodes, np.int64)
        last[0] = n
        for i in range(nodes):
            at = order[first[i]:last[i]]
            centres[i] = x[at].mean(axis=0)
            away = x[at] - centres[i]
            far = np.sqrt((away * away).sum(axis=1))
            radii[i], least[i] = far.max(), ids[at].min()
            if 2 * i + 1 >= nodes:
                continue
            # Halved by the rows' places along the line to the farthest of them. Equal rows keep the order
            # of their ids, so that a cluster of copies is told apart by `least`.
            along = away @ away[far.argmax()]
            at = order[first[i]:last[i]] = at[np.lexsort((ids[at], along))]
            middle = (first[i] + last[i]) // 2
            first[2 * i + 1], last[2 * i + 1], first[2 * i + 2], last[2 * i + 2] = first[i], middle, middle, last[i]
        return Tree(ids[order], rows[order], centres, radii, first, last, least)

    def bounds(self, nodes: np.ndarray, query: np.ndarray, norm: float) -> np.ndarray:
        """No row of a node scores more: rounded up past the floats' error, which is relative to the
        sizes of the vectors and not to the sum."""
        size = norm * (np.sqrt((self.centres[nodes] ** 2).sum(axis=1)) + self.radii[nodes])
        return np.floor(self.centres[nodes] @ query + norm * self.radii[nodes] + 1e-9 * size + 1e-6)


class Best:
    """The k best (score, vec_id) of each query so far, best first, ties to the smaller id; `at_least`
    holds scores that k rows elsewhere reach."""

    def __init__(self, at_least: np.ndarray, k: int):
        n = len(at_least)
        self.k, self.at_least = k, at_least
        self.score, self.id = np.full((n, k), LOWEST, np.int64), np.full((n, k), (1 << 63) - 1, np.int64)
        self.n = np.zeros(n, np.int64)

    def beaten(self, i: int, bound: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Which nodes (or rows) may still hold one of query i's k best."""
        kth = self.score[i, -1] if self.n[i] == self.k else LOWEST
        if kth < self.at_least[i]:
            return bound >= self.at_least[i]
        if self.n[i] < self.k:
            return np.ones(len(bound), bool)
        return (bound > kth) | ((bound == kth) & (least < self.id[i, -1]))

    def add(self, i: int, score: np.ndarray, ids: np.ndarray) -> None:
        s, v = np.concatenate((self.score[i, :self.n[i]], score)), np.concatenate((self.id[i, :self.n[i]], ids))
        top = np.lexsort((v, -s))[:self.k]
        self.n[i] = len(top)
        self.score[i, :len(top)], self.id[i, :len(top)] = s[top], v[top]


def search_tree(tree: Tree, wide: np.ndarray, i: int, own: int, query: np.ndarray, norm: float, best: Best) -> int:
    """Add a tree's rows to query i's best; the number of rows scored. `wide` and `query` are of a type in
    which the products are exact."""
    nodes = np.zeros(1, np.int64)
    fine = query.astype(np.float64)
    bound = tree.bounds(nodes, fine, norm)
    while True:
        keep = best.beaten(i, bound, tree.least[nodes])
        nodes, bound = nodes[keep], bound[keep]
        if not len(nodes) or 2 * nodes[0] + 1 >= len(tree.radii):
            break
        parents = np.repeat(bound, 2)
        nodes = np.stack((2 * nodes + 1, 2 * nodes + 2), axis=1).ravel()
        bound = np.minimum(tree.bounds(nodes, fine, norm), parents)
    order = np.lexsort((tree.least[nodes], -bound))
    nodes, bound = nodes[order], bound[order]
    start, step, seen = 0, 1, 0
    while start < len(nodes):
        some = nodes[start:start + step][best.beaten(i, bound[start:start + step], tree.least[nodes[start:start + step]])]
        start, step = start + step, step * 2
        if not len(some):
            continue
        at = np.concatenate([np.arange(tree.first[j], tree.last[j]) for j in some])
        score, ids = (wide[at] @ query).astype(np.int64), tree.ids[at]
        seen += len(at)
        keep = best.beaten(i, score, ids) & (ids != own)
        if keep.any():
            best.add(i, score[keep], ids[keep])
    return seen


def _shard(batch: pa.RecordBatch, i: int) -> Tree:
    def of(name: str, kind: str) -> np.ndarray:
        return np.frombuffer(batch.column(name)[i].as_py(), kind)
    ids, radii = of("ids", "<i8"), of("radii", "<f8")
    return Tree(ids, of("rows", "<i4").reshape(len(ids), -1), of("centres", "<f8").reshape(len(radii), -1), radii,
                of("first", "<i8"), of("last", "<i8"), of("least", "<i8"))


def build_index(rows: DataFrame) -> DataFrame:
    """One row a shard of SHARD_ROWS rows (vec_id, x, row), with its ball tree."""
    def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        tree = Tree.build(part["vec_id"].to_numpy(np.int64), np.stack(part["x"].to_numpy()).astype(np.int64))
        return pd.DataFrame({"shard": [key[0]], "ids": [tree.ids.astype("<i8").tobytes()], "rows": [tree.rows.astype("<i4").tobytes()],
                             "centres": [tree.centres.tobytes()], "radii": [tree.radii.tobytes()], "first": [tree.first.tobytes()],
                             "last": [tree.last.tobytes()], "least": [tree.least.tobytes()]})

    made = rows.withColumn("shard", F.expr(f"row div {SHARD_ROWS}")).groupBy("shard").applyInPandas(build, SHARD)
    path = scratch_path(rows.sparkSession, "llm/ball_trees")
    made.write.option("maxRecordsPerFile", FILE_SHARDS).parquet(path)
    return rows.sparkSession.read.schema(SHARD).parquet(path)


def _search_shards(shards: DataFrame, ids: np.ndarray, queries: np.ndarray, at_least: np.ndarray, widest: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): what each task has found among its shards."""
    block = shards.sparkSession.sparkContext.broadcast((ids, queries, at_least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries, at_least = block.value
        best = Best(at_least, k)
        exact = queries.shape[1] * widest * int(np.abs(queries).max()) < EXACT
        typed = queries.astype(np.float64 if exact else np.int64)
        norms = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
        for batch in batches:
            for j in range(batch.num_rows):
                tree = _shard(batch, j)
                wide = tree.rows.astype(typed.dtype)
                for i in range(len(ids)):
                    search_tree(tree, wide, i, ids[i], typed[i], norms[i], best)
        for i in range(0, len(ids), 4096):
            some = np.arange(best.k) < best.n[i:i + 4096, None]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids[i:i + 4096], best.n[i:i + 4096])), pa.array(best.id[i:i + 4096][some]),
                 pa.array(best.score[i:i + 4096][some])], ["query_id", "vec_id", "score"])

    return shards.mapInArrow(run, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (found.select("query_id", rank.cast("int").alias("rank"), "vec_id", "score").where(F.col("rank") <= k))


def search(vectors: DataFrame, is_query, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest integer inner products, exactly.

    `is_query` is a condition on vec_id. Rows with a null id, and vectors that are null, empty, of a length
    other than the most common one (ties: the shorter), hold null or non-finite components, or components so
    large that a score might not fit a long (`largest`) take no part; zero vectors do. Rows that repeat an id
    are one candidate each time, and no candidates of their own id; of the vectors of a repeated query id the
    least counts. Ties go to the smaller vec_id. Other columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = numbered(usable(vectors), "vectors")
    length = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if length is None:
        return spark.createDataFrame([], RESULT)
    d = length["d"]
    size = F.array_max(F.transform("x", lambda v: F.abs(v)))
    fits = (F.size("x") == d) & (size <= largest(d))
    if rows.where(~fits).limit(1).count():
        rows = numbered(rows.where(fits).select("vec_id", "x"), "vectors")
    widest = rows.agg(F.max(size)).first()[0]
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min("x").alias("x"))
    n_queries = queries.count()
    if not n_queries:
        return spark.createDataFrame([], RESULT)
    blocks = -(-n_queries * d * 8 // BLOCK_BYTES)
    queries = written(queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))), "queries")
    index = build_index(rows)
    path = scratch_path(spark, "llm/ball_found")
    for b in range(blocks):
        part = queries.where(F.col("block") == b).orderBy("vec_id").toArrow()
        if not part.num_rows:
            continue
        ids = part.column("vec_id").to_numpy()
        q = part.column("x").combine_chunks().flatten().to_numpy().reshape(len(ids), d)
        at_least = np.full(len(ids), LOWEST, np.int64)
        # Seeds first. One row of a seeded query's k-th score comes back, a block of queries at most.
        seeds = written(_ranked(_search_shards(index.where(F.col("shard") % SEED_SHARDS == 0), ids, q, at_least, widest, k), k), "seeds")
        kth = seeds.where(F.col("rank") == k).select("query_id", "score").toArrow()
        at_least[np.searchsorted(ids, kth.column("query_id").to_numpy())] = kth.column("score").to_numpy()
        rest = _search_shards(index.where(F.col("shard") % SEED_SHARDS != 0), ids, q, at_least, widest, k)
        seeds.select("query_id", "vec_id", "score").union(rest).write.mode("append").parquet(path)
    return _ranked(spark.read.schema(FOUND).parquet(path), k)
