from collections import Counter

import numpy as np
import pytest

from tradewatch.llm import whitening


def expected(ids, vectors, k):
    """The contract's numbers by plain numpy."""
    c = np.array(vectors, np.float32).astype(np.float64)
    x = np.floor(64 * c).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    apart = [[n * int(a) - int(b) for a, b in zip(row, s)] for row in x]
    deviation = [sum(a * a for a in row) for row in apart]
    centred = np.array(apart, dtype=np.float64) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    return n, deviation, centred @ v / np.sqrt(e), e / np.trace(centred.T @ centred / n)


def check(spark, ids, vectors, k=32, partitions=5):
    df = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in zip(ids, vectors)],
                               "vec_id long, embedding array<float>").repartition(partitions)
    got = whitening.digest(whitening.whiten(df)).toPandas()
    n, deviation, white, share = expected(ids, vectors, k)
    assert len(got) == n * k and set(got["component"]) == set(range(1, k + 1)) and set(got["n"]) == {n}
    assert len(set(got["identity_error"])) == 1 and got["identity_error"][0] < 1e-9
    per = got.drop_duplicates(["vec_id", "component"])
    wide = per.pivot(index="vec_id", columns="component", values="whitened").loc[list(ids)].to_numpy()
    assert np.abs(wide * np.sign((wide * white).sum(axis=0)) - white).max() < 1e-8
    assert per.groupby("vec_id")["deviation"].first().loc[list(ids)].tolist() == deviation
    shares = per.groupby("component")["explained"].first().to_numpy()
    assert np.abs(shares / share - 1).max() < 1e-9


def test_many_blocks_match_numpy(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, 40)) * np.linspace(3, 0.5, 40)
    # Three blocks of rows a group and several blocks of columns, so that groups and column blocks add up.
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 64)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 16)
    monkeypatch.setattr(whitening, "GROUP_BLOCKS", 3)
    check(spark, range(700), x)


def test_a_third_of_rows_alike(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8))
    x[:100] = x[0]
    check(spark, range(300), x, k=8)


def test_the_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    check(spark, [r.vec_id for r in df], [r.embedding for r in df])


def test_rank_of_the_rows(spark):
    rng = np.random.default_rng(3)
    flat = np.repeat(rng.integers(-3, 4, size=(60, 3)), 2, axis=1).astype(float)       # six columns, rank three
    check(spark, range(60), flat, k=3)


@pytest.fixture(scope="module")
def odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], "a"), (1, None, "b"), (2, [0.0, 0.0], "c"), (3, [nan, 1.0], "d"), (4, [None, 1.0], None), (5, [inf, 1.0], "f"),
            (None, [1.0, 1.0], "g"), (6, [0.5, -0.5], "h"), (6, [0.5, -0.5], "h"), (7, [1.0], "i"), (8, [], "j"), (9, [4e7, 1.0], "k")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, component string").selectExpr("*", "'x' AS row", "1 AS n")


def test_edge_cases(spark, odd_vectors):
    got = whitening.whiten(odd_vectors).collect()
    assert Counter(r.vec_id for r in got) == {0: 2, 2: 2, None: 2, 6: 4}
    n, deviation, _, _ = expected(None, [[1, 0], [0, 0], [1, 1], [0.5, -0.5], [0.5, -0.5]], 2)
    assert {r.vec_id: int(r.deviation) for r in got} == dict(zip([0, 2, None, 6], deviation)) and {r.n for r in got} == {n}
    assert whitening.whiten(odd_vectors.limit(0)).count() == 0
    alike = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert whitening.whiten(alike).count() == 0 and whitening.whiten(alike.limit(1)).count() == 0


def test_whitened_covariance_is_the_identity(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 6)) @ rng.normal(size=(6, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    w = whitening.whiten(df, 4).toPandas().pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert w.shape == (400, 4) and np.abs(np.cov(w.T, bias=True) - np.eye(4)).max() < 1e-9
