import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewatch.llm import ball_tree


def brute(ids, x, modulus, k):
    """{query: [(vec_id, score)]} by comparing every pair, in Python's own integers."""
    ints = [[int(np.floor(1024 * float(a))) for a in v] for v in np.asarray(x, np.float32).astype(np.float64)]
    out = {}
    for q, v in zip(ids, ints):
        if q % modulus == 0:
            scored = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in zip(ids, ints) if i != q]
            out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def answers(df, modulus, k=10):
    got = {}
    for r in ball_tree.search(df, F.col("vec_id") % modulus == 0, k).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    return {q: [found[i] for i in range(1, len(found) + 1)] for q, found in got.items()}


def check(spark, ids, x, modulus=20, k=10):
    df = spark.createDataFrame([(int(i), [float(a) for a in v]) for i, v in zip(ids, x)],
                               "vec_id long, embedding array<float>").repartition(4)
    assert answers(df, modulus, k) == brute([int(i) for i in ids], x, modulus, k)


@pytest.fixture
def small_shards(monkeypatch):
    """Several shards, levels and blocks of queries on few rows."""
    monkeypatch.setattr(ball_tree, "SHARD_ROWS", 150)
    monkeypatch.setattr(ball_tree, "LEAF_ROWS", 8)
    monkeypatch.setattr(ball_tree, "BLOCK_BYTES", 4096)


def test_norms_of_every_size(spark, small_shards):
    rng = np.random.default_rng(1)
    check(spark, np.arange(900), rng.normal(size=(900, 24)) * rng.gamma(2.0, 1.0, (900, 1)))


def test_a_third_of_rows_alike_and_ties(spark, small_shards):
    rng = np.random.default_rng(2)
    x = rng.integers(-2, 3, size=(900, 3)) / 1024.0                     # few values: many tied scores
    x[200:500] = x[0]
    check(spark, rng.permutation(900), x)


def test_clusters(spark, small_shards):
    rng = np.random.default_rng(3)
    check(spark, np.arange(600), rng.normal(size=(12, 16))[rng.integers(0, 12, 600)] * 4 + rng.normal(size=(600, 16)) * 0.1)


def test_few_rows_and_one_dimension(spark):
    check(spark, [0, 20, 7], [[1.0, 2.0], [0.0, 0.0], [-1.0, 0.5]])
    check(spark, range(50), np.linspace(-3, 3, 50)[:, None])


def test_large_components_stay_exact(spark, small_shards):
    rng = np.random.default_rng(4)
    big = rng.normal(size=(300, 2)) * 3e5                               # products beyond what floats hold exactly
    check(spark, np.arange(300), big)


def test_the_embeddings(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    check(spark, [r.vec_id for r in rows], [r.embedding for r in rows], modulus=100)


def test_bounds_cut_clustered_rows():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(32, 16)) * 2000
    rows = np.floor(centres[rng.integers(0, 32, 4096)] + rng.normal(size=(4096, 16)) * 20).astype(np.int64)
    tree = ball_tree.Tree.build(np.arange(4096), rows)
    for i in range(0, 4096, 512):
        q = rows[i].astype(float)
        best = ball_tree.Best(np.full(1, ball_tree.LOWEST), 10)
        seen = ball_tree.search_tree(tree, tree.rows.astype(float), 0, i, q, float(np.sqrt(q @ q)), best)
        scores = rows @ rows[i]
        want = [j for j in np.lexsort((np.arange(4096), -scores)) if j != i][:10]
        assert best.id[0].tolist() == want and seen < 2048
        assert all(tree.bounds(np.array([j]), q, float(np.sqrt(q @ q)))[0] >= (tree.rows[a:b] @ rows[i]).max()
                   for j, (a, b) in enumerate(zip(tree.first, tree.last)))


def test_a_shared_bound_loses_no_row():
    rng = np.random.default_rng(6)
    rows = rng.integers(-50, 50, size=(500, 4))
    tree, q = ball_tree.Tree.build(np.arange(500), rows), rng.integers(-50, 50, 4).astype(float)
    scores = rows @ q.astype(int)
    want = np.lexsort((np.arange(500), -scores))[:10]
    best = ball_tree.Best(np.array([scores[want[-1]]]), 10)             # a bound that other shards reached, ties included
    ball_tree.search_tree(tree, tree.rows.astype(float), 0, -1, q, float(np.sqrt(q @ q)), best)
    assert best.id[0].tolist() == want.tolist()


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], "a"), (20, None, "b"), (40, [0.0, 0.0], "c"), (60, [nan, 1.0], "d"), (1, [None, 1.0], "e"),
            (2, [inf, 1.0], "f"), (None, [1.0, 1.0], "g"), (3, [0.5, 0.5], "h"), (3, [0.5, 0.5], "h"), (4, [1.0], "i"),
            (80, [], "j"), (5, [2.0, 0.0], "k"), (0, [1.0, 0.0], "again"), (0, [9.0, 0.0], "other"), (6, [1e30, 0.0], "l")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string").selectExpr("*", "1 AS row", "2 AS shard")
    m = 1024 * 1024
    # The least of query 0's vectors counts; none of its own rows is a candidate.
    assert answers(df, 20) == {0: [(5, 2 * m), (3, m // 2), (3, m // 2), (40, 0)],
                               40: [(0, 0), (0, 0), (0, 0), (3, 0), (3, 0), (5, 0)]}
    assert ball_tree.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert ball_tree.search(df, F.col("vec_id") == -1).count() == 0
