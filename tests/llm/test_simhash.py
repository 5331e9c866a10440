import random

import numpy as np
import xxhash

from tradewatch.llm import simhash


def plain_fingerprint(text: str) -> int:
    w = bytes(text, "utf-8").lower().split()
    if not w:
        return 0
    parts = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def plain_components(rows):
    """(doc_id, fingerprint) -> least id reachable over 3 bits or fewer, by search."""
    out, seen = {}, set()
    for i in sorted(range(len(rows)), key=lambda i: rows[i][0]):
        if i in seen:
            continue
        todo = [i]
        seen.add(i)
        while todo:
            a = todo.pop()
            out[a] = rows[i][0]
            for b in range(len(rows)):
                if b not in seen and (rows[a][1] ^ rows[b][1]).bit_count() <= 3:
                    seen.add(b)
                    todo.append(b)
    return out


def test_golay_code_is_perfect():
    low, high, error, other = simhash.golay_tables()
    weights = np.bitwise_count(error)
    assert np.bincount(weights).tolist() == [1, 23, 253, 1771]
    assert ((np.bitwise_count(other) == 4).all(axis=1) == (weights == 3)).all()


def test_segment_keys_meet_at_one_bit():
    rng = np.random.default_rng(0)
    v = rng.integers(0, 1 << 23, 5000)
    w = v ^ (1 << rng.integers(0, 23, 5000))
    for a, b in ((v, w), (v, v)):
        index, _ = simhash.segment_keys(a)
        _, probe = simhash.segment_keys(b)
        assert (probe == index[:, None]).any(axis=1).all()


def test_keys_meet_within_three_bits():
    rng = np.random.default_rng(1)
    u = rng.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 3000, dtype=np.uint64)
    w = u.copy()
    for _ in range(3):
        w ^= np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)
    index, _, _ = simhash.golay_keys(u.view(np.int64))
    _, probes, rows = simhash.golay_keys(w.view(np.int64))
    met = np.zeros(3000, bool)
    for k in range(3):
        hit = probes == index[rows, k]
        met[rows[hit]] = True
    assert met.all()


def test_components_match_search(spark):
    random.seed(3)
    words = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(40):
        base = [random.choice(words) for _ in range(random.randint(0, 60))]
        texts.append(" ".join(base))
        for _ in range(random.randint(0, 3)):
            copy = list(base)
            if copy and random.random() < 0.7:
                copy[random.randrange(len(copy))] = random.choice(words)
            texts.append("  ".join(copy).upper() if random.random() < 0.3 else "\n".join(copy))
    ids = random.sample(range(1000), len(texts))
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(4)
    rows = [(i, plain_fingerprint(t)) for i, t in zip(ids, texts)]
    want = plain_components(rows)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_components(docs).collect()}
    assert got == {i: (f"{f:016x}", want[k]) for k, (i, f) in enumerate(rows)}
    kept = {r.doc_id for r in simhash.near_dedup(docs).collect()}
    assert kept == set(want.values())


def test_links_find_every_pair(spark):
    rng = np.random.default_rng(5)
    centre = rng.integers(-2**62, 2**62, 6)
    fps = {int(c ^ sum(1 << int(b) for b in rng.choice(62, rng.integers(0, 4), replace=False))) for c in centre for _ in range(30)}
    fps = sorted(fps | {0, -1, 1, 3, 7, 15})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {(r.u, r.v) for r in simhash.links(df).collect()}
    near = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 3
    assert got == {(a, b) for a in fps for b in fps if a < b and near(a, b)}


def test_edge_cases(spark, odd_docs, no_docs):
    got = simhash.simhash_components(odd_docs).collect()
    assert len(got) == odd_docs.count()
    blank = [r for r in got if r.fingerprint == "0" * 16]
    assert len(blank) == 4 and {r.component_id for r in blank} == {2}
    kept = simhash.near_dedup(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()).count((False, 1)) == 1
    assert simhash.simhash_components(no_docs).count() == 0 and simhash.near_dedup(no_docs).count() == 0


def test_near_dedup_keeps_columns_of_any_name(spark):
    from pyspark.sql import functions as F
    rows = [(1, "one text of some words", "a"), (1, "one text of some words", "b"), (2, "one text of some words", "c"), (3, "quite another", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _text_hash string").withColumn("_Text_Hash_", F.lit("X")).withColumn("_dedup_hash", F.lit("Y"))
    got = simhash.near_dedup(df).collect()
    assert {r.doc_id for r in got} == {1, 3} and {r._dedup_hash for r in got} == {"Y"} and {r["_Text_Hash_"] for r in got} == {"X"}
    assert {r._text_hash for r in got} <= {"a", "b", "d"} and len(got) == 2
