"""Nearest neighbours by inner product with multi-index hashing.

1. Vectors get one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm,
   and queries a zero there: the order by inner product is then the order by
   angle. Binary codes are the signs after learned rotations (iterative
   quantization, several starts), fitted on a bounded sample.
2. A code of BITS bits is cut into substrings of WIDTH bits. Every block of
   rows keeps a table for each substring, addressed by its value.
3. Pigeonhole: codes at most r bits apart agree, in at least one substring t,
   up to its share tau_t, where the shares add up to r + 1 - tables. Probing all
   values within tau_t bits in every table retrieves every code in the radius;
   full codes are verified, and the floats of those within it reranked in
   double precision. Where a block has fewer than k codes within r, the
   radius grows to its k-th nearest code.
4. r comes from up to CALIBRATION queries that are compared with all rows: the
   distance that holds SHARE of their true neighbours' codes.

Queries are a stated set; blocks of queries meet blocks of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewatch.llm.common import written

K = 20
WIDTH, TABLES = 12, 21
BITS = WIDTH * TABLES
#: Rows that the rotations are fitted on, on average, and steps of the fit.
FIT_ROWS, FIT_STEPS = 10_000, 25
#: Queries compared with all rows to choose the radius, and the neighbours' codes it must hold.
CALIBRATION, SHARE = 64, 0.97
#: Rows and queries of a block.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 4096


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, x array<double>) of the vectors that take part: an id, no null or non-finite part, not zero."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
            .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & ~F.coalesce(bad, F.lit(True))
                   & F.exists("x", lambda v: v != 0)))


@dataclass
class Codes:
    """The learned hash functions."""

    directions: np.ndarray      # (dimension + 1) x BITS
    longest: float              # M

    def _coded(self, x: np.ndarray, extra: np.ndarray) -> np.ndarray:
        bits = np.concatenate((x, extra[:, None]), axis=1) @ self.directions > 0
        return np.packbits(bits.reshape(len(x), TABLES, WIDTH), axis=2, bitorder="little").view("<u2")[:, :, 0]

    def of_rows(self, x: np.ndarray) -> np.ndarray:
        """Substrings (rows x TABLES, 16-bit numbers) of the rows' codes."""
        return self._coded(x, np.sqrt(np.maximum(self.longest ** 2 - (x * x).sum(axis=1), 0)))

    def of_queries(self, x: np.ndarray) -> np.ndarray:
        return self._coded(x, np.zeros(len(x)))


def fit(sample: np.ndarray, longest: float) -> Codes:
    """Rotations that bring the sample close to its signs, from enough random starts for BITS bits."""
    y = np.concatenate((sample, np.sqrt(np.maximum(longest ** 2 - (sample * sample).sum(axis=1), 0))[:, None]), axis=1)
    y = y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-300)
    d = y.shape[1]
    rng, found = np.random.default_rng(7), []
    for _ in range(-(-BITS // d)):
        r = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for _ in range(FIT_STEPS if len(y) > d else 0):
            u, _, v = np.linalg.svd(np.sign(y @ r).T @ y)
            r = (u @ v).T
        found.append(r)
    return Codes(np.concatenate(found, axis=1)[:, :BITS], longest)


def wide(substrings: np.ndarray) -> np.ndarray:
    """Codes as 64-bit words, for counting differing bits."""
    n, words = len(substrings), -(-TABLES // 4)
    out = np.zeros((n, words * 4), "<u2")
    out[:, :TABLES] = substrings
    return out.view("<u8")


def differing(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes ^ code).sum(axis=1, dtype=np.int64)


def shares(radius: int) -> list[int]:
    """tau of each table: they and one each add up to radius + 1 (-1: the table isn't needed)."""
    return [(radius + 1) // TABLES + (t < (radius + 1) % TABLES) - 1 for t in range(TABLES)]


@lru_cache(maxsize=16)
def masks(tau: int) -> np.ndarray:
    """All values of WIDTH bits with at most tau bits set."""
    v = np.arange(1 << WIDTH)
    return v[np.bitwise_count(v) <= tau]


class Tables:
    """The substring tables of a block of rows."""

    def __init__(self, substrings: np.ndarray):
        self.n = len(substrings)
        self.order = np.argsort(substrings, axis=0, kind="stable")
        self.starts = np.stack([np.concatenate(([0], np.cumsum(np.bincount(substrings[:, t], minlength=1 << WIDTH))))
                                for t in range(TABLES)])

    def probe(self, substrings: np.ndarray, radius: int) -> np.ndarray:
        """Rows that share a substring with the query up to its tau: all within the radius are among them."""
        hit = np.zeros(self.n, bool)
        for t, tau in enumerate(shares(radius)):
            if tau < 0:
                continue
            at = int(substrings[t]) ^ masks(min(tau, WIDTH))
            first, n = self.starts[t][at], self.starts[t][at + 1] - self.starts[t][at]
            some = n > 0
            first, n = first[some], n[some]
            if len(n):
                ends = np.cumsum(n)
                hit[self.order[np.arange(ends[-1]) + np.repeat(first - ends + n, n), t]] = True
        return np.flatnonzero(hit)


def nearest(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, codes: Codes, radius: int,
            k: int = K) -> pd.DataFrame:
    """(query_id, vec_id, score): each query's k best rows of a block."""
    sub, q_sub = codes.of_rows(rows), codes.of_queries(queries)
    tables, full, q_full = Tables(sub), wide(sub), wide(q_sub)
    out_q, out_v, out_s = [], [], []
    for i, q in enumerate(query_ids):
        found = tables.probe(q_sub[i], radius)
        found = found[(differing(full[found], q_full[i]) <= radius) & (ids[found] != q)]
        if len(found) < k:
            found = np.flatnonzero(ids != q)
            if len(found) > k:
                d = differing(full[found], q_full[i])
                found = found[d <= np.partition(d, k - 1)[k - 1]]
        # Not a matrix product: every score is the same sum whatever block its row is in.
        score = np.einsum("ij,j->i", rows[found], queries[i])
        best = np.lexsort((ids[found], -score))[:k]
        out_q.append(np.full(len(best), q))
        out_v.append(ids[found][best])
        out_s.append(score[best])
    if not out_q:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    return pd.DataFrame({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_v),
                         "score": np.concatenate(out_s)})


def matrix(column) -> np.ndarray:
    """Vectors of one length as a matrix."""
    return np.array([np.asarray(v, np.float64) for v in column]) if len(column) else np.zeros((0, 0))


def chosen_radius(vectors: DataFrame, calibration: list[tuple[int, list[float]]], codes: Codes, k: int = K) -> int:
    """The radius that holds SHARE of the codes of the calibration queries' true neighbours."""
    q_ids, q = np.array([i for i, _ in calibration], np.int64), matrix([x for _, x in calibration])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = wide(codes.of_queries(q))
        for b in batches:
            ids, x = np.array(b.column("vec_id").to_pylist(), np.int64), matrix(b.column("x").to_pylist())
            if not len(ids):
                continue
            score, own = q @ x.T, wide(codes.of_rows(x))
            score[q_ids[:, None] == ids[None, :]] = -np.inf
            top = np.argsort(-score, axis=1)[:, :k]
            far = np.stack([differing(own[t], full[i]) for i, t in enumerate(top)])
            keep = np.take_along_axis(score, top, axis=1)
            where = np.isfinite(keep)
            rows = np.nonzero(where)[0]
            yield pa.RecordBatch.from_arrays([pa.array(q_ids[rows]), pa.array(keep[where]), pa.array(far[where])],
                                             ["query_id", "score", "bits"])

    close = vectors.mapInArrow(run, "query_id long, score double, bits long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))
    got = (close.withColumn("rank", rank).where(F.col("rank") <= k)
           .agg(F.percentile("bits", SHARE).alias("r")).first()["r"])
    return int(np.ceil(got)) if got is not None else 0


def search(vectors: DataFrame, is_query, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest rows found, by inner product.

    `is_query` is a condition on vec_id. Rows with a null id, and vectors
    that are null, empty, zero, of a length other than the most common one, or hold null or
    non-finite parts, take no part. A query's own id is no candidate; other
    rows with equal vectors are; rows that repeat an id are one candidate each time.
    Ties go to the smaller vec_id. Other columns are ignored; an empty table
    gives an empty result.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = written(usable(vectors), "vectors")
    length = (rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first() or [0])[0]
    rows = rows.where(F.size("x") == length)
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v))
    total, longest = rows.agg(F.count("*"), F.max(norm)).first()
    queries = rows.where(is_query)
    n_queries = queries.count()
    if not n_queries:
        return spark.createDataFrame([], schema)
    chance = F.xxhash64("vec_id").bitwiseAND(0xFFFFFF) / float(1 << 24)
    sample = rows.where(chance * total < FIT_ROWS).select("x").orderBy(F.xxhash64("x")).limit(2 * FIT_ROWS).collect()
    codes = fit(matrix([r["x"] for r in sample]) if sample else np.zeros((0, length)), longest)
    picked = queries.distinct().orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION).collect()
    radius = chosen_radius(rows, [(r["vec_id"], r["x"]) for r in picked], codes, k)

    row_blocks, query_blocks = -(-total // BLOCK_ROWS), -(-n_queries // BLOCK_QUERIES)

    def dealt(df: DataFrame, blocks: int, seed: int):
        return F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(blocks)).cast("int")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    a = rows.select("vec_id", "x", dealt(rows, row_blocks, 1).alias("i"), every(query_blocks).alias("j"))
    b = queries.distinct().select("vec_id", "x", every(row_blocks).alias("i"), dealt(queries, query_blocks, 2).alias("j"))
    shared = spark.sparkContext.broadcast((codes, radius))

    def block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        codes, radius = shared.value
        return nearest(right["vec_id"].to_numpy(), matrix(right["x"]), left["vec_id"].to_numpy(), matrix(left["x"]),
                       codes, radius, k)

    found = a.groupBy("i", "j").cogroup(b.groupBy("i", "j")).applyInPandas(block, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.cast("int").alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
