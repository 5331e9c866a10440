import numpy as np
from pyspark.sql import functions as F

from tradewatch.llm import mih


def test_shares_follow_the_pigeonhole():
    for r in range(0, mih.BITS):
        s = mih.shares(r)
        assert sum(t + 1 for t in s) == r + 1 and min(s) >= -1


def test_probing_retrieves_the_whole_radius():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 1 << mih.WIDTH, (400, mih.TABLES)).astype(np.uint16)
    tables, full = mih.Tables(rows), mih.wide(rows)
    for i in range(0, 400, 40):
        q = rows[i].copy()
        for t in rng.integers(0, mih.TABLES, 30):
            q[t] ^= np.uint16(1 << rng.integers(0, mih.WIDTH))
        d = mih.differing(full, mih.wide(q[None])[0])
        for r in (0, 3, 20, 40, 110):
            assert set(np.flatnonzero(d <= r)) <= set(tables.probe(q, r))


def check(spark, vectors, least=0.9):
    ids, x = np.array([i for i, _ in vectors]), np.array([v for _, v in vectors], np.float32).astype(np.float64)
    df = spark.createDataFrame([(int(i), [float(a) for a in v]) for i, v in zip(ids, x)],
                               "vec_id long, embedding array<float>").repartition(4)
    got = {}
    for r in mih.search(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    hit = total = 0
    for k in np.flatnonzero(ids % 20 == 0):
        s = x @ x[k]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[k]][:20]
        mine = [got[ids[k]][r] for r in range(1, len(order) + 1)]
        hit += len(set(ids[order]) & {v for v, _ in mine})
        total += len(order)
        own = dict(zip(ids.tolist(), s.tolist()))
        assert all(abs(own[v] - sc) < 1e-9 for v, sc in mine)
        assert all((-a[1], a[0]) < (-b[1], b[0]) for a, b in zip(mine, mine[1:]))
    assert set(got) == set(ids[ids % 20 == 0].tolist()) and hit >= least * total


def test_recall_with_norms_of_every_size(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 24)) * rng.gamma(2.0, 1.0, (1500, 1))
    check(spark, list(enumerate(x)))


def test_hot_vectors_and_few_rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 8))
    x[100:300] = x[0]                                              # a third of all rows alike: ties go to the id
    check(spark, list(enumerate(x)))
    check(spark, list(enumerate(x[:3])))


def test_recall_on_the_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    check(spark, [(r.vec_id, r.embedding) for r in df.collect()])


def test_edge_cases(spark):
    rows = [(0, [1.0, 0.0], "a"), (20, None, "b"), (40, [0.0, 0.0], "c"), (60, [float("nan"), 1.0], "d"), (1, [None, 1.0], "e"),
            (2, [float("inf"), 1.0], "f"), (None, [1.0, 1.0], "g"), (3, [0.5, 0.5], "h"), (3, [0.5, 0.5], "h"), (4, [1.0], "i"),
            (80, [], "j"), (5, [2.0, 0.0], "k")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in mih.search(df, F.col("vec_id") % 20 == 0).collect()]
    assert sorted(got) == [(0, 1, 5, 2.0), (0, 2, 3, 0.5), (0, 3, 3, 0.5)]
    assert mih.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
