import math
import pickle
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tradewatch.llm import maxent as m


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    return docs.collect(), m.score(docs, model_words=2000).collect()


def test_counts_and_base_score(scored):
    docs, got = scored
    texts = {r.doc_id: m.tokens(r.text.encode()) for r in docs}
    n = Counter(w for i, ws in texts.items() if not held(i) for w in ws)
    total, distinct = sum(n.values()), len(n)
    assert len(got) == len(docs)
    for r in got:
        ws = texts[r.doc_id]
        base = sum(math.log10((n[w] + 1) / (total + distinct + 1)) for w in ws)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(ws), sum(w in n for w in ws), total)
        assert r.base_score == pytest.approx(base, rel=1e-9)


def test_model_beats_the_unigram_on_held_out_texts(scored):
    _, got = scored
    for kind in (True, False):
        rows = [r for r in got if r.held_out is kind]
        assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_probabilities_sum_to_one(spark):
    texts = ["a b c a b d a b", "a c a d b a", "b a b a c e f g", "x y a b"] * 5
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts) if not held(i)], "doc_id long, text string")
    docs = docs.withColumn("held_out", m.split_train(m.HELD_OUT, m.MODULUS))
    model, _ = m.learn(docs, 4)
    counts = {bytes(r.word): r.n for r in model.counts.collect()}
    assert len(model.vocabulary) == 4 < model.distinct == len(counts)
    rank = {w: i for i, w in enumerate(model.vocabulary)}
    for past in ([], [0], [1, 2], [4, 0, 3], [2, 4, 4, 1]):
        total = 0.0
        for w in [*counts, b"never seen"]:
            r = rank.get(w, len(rank))
            ids, features, before = model.words.history([np.array([*past, r], np.int32)])
            p = m.class_log_probs(model.weights, model.bias, features[-1:])[0, model.words.classes[ids[-1]]]
            if r < len(rank):
                total += math.exp(p) * 10 ** float(model.in_class[ids[-1], before[-1]])
            else:
                total += math.exp(p) * (counts.get(w, 0) + 1) / model.rare_mass
        # Classes without a word keep a little mass.
        used = {int(c) for c in model.words.classes[:len(rank)]} | {m.CLASSES - 1}
        z = np.exp(m.class_log_probs(model.weights, model.bias, features[-1:]))[0]
        assert total == pytest.approx(z[sorted(used)].sum(), abs=1e-5) and total <= 1 + 1e-6


def test_history_features_look_back_within_a_document_only():
    words = m.Words.of(np.array([0, 1, 1, 2]), np.array([9.0, 5, 4, 2]))
    a, b = np.array([0, 1, 2], np.int32), np.array([3, 0], np.int32)
    ids, features, before = words.history([a, b])
    for part, at in ((a, 0), (b, 3)):
        own = words.history([part])
        for x, y in zip((ids, features, before), own):
            assert x[at:at + len(part)].tolist() == y.tolist()


def test_edge_cases(spark, odd_docs, no_docs):
    got = m.score(odd_docs, model_words=50).collect()
    assert len(got) == odd_docs.count()
    blank = [r for r in got if r.n_tokens == 1]
    assert len(blank) == 4 and all(r.score < 0 and r.base_score < 0 for r in got)
    assert all(math.isfinite(r.score) for r in got)
    assert m.score(no_docs).count() == 0
    only = spark.createDataFrame([(i, "a b") for i in range(30) if held(i)], "doc_id long, text string")
    for r in m.score(only).collect():
        assert (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0) and math.isfinite(r.score)


def test_words_and_weights_grow_with_the_vocabulary(spark):
    words = [f"w{i}" for i in range(66_000)]
    texts = [" ".join(words[a:a + 1000]) for a in range(0, len(words), 1000) for _ in range(m.LEAST_COUNT)]
    ids = [i for i in range(1000) if not held(i)]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    docs = docs.withColumn("held_out", m.split_train(m.HELD_OUT, m.MODULUS))
    model, _ = m.learn(docs)
    assert len(model.vocabulary) == model.distinct == 66_001 and model.rare_mass == 1
    assert len(model.weights) >= 66_000 and model.in_class.shape == (66_001, m.CLASSES + 1)
    edges = np.cumsum(model.words.sizes)[:-1]
    for part in np.split(10.0 ** model.in_class.astype(float), edges):
        assert not len(part) or part.sum(axis=0) == pytest.approx(np.ones(m.CLASSES + 1), abs=1e-3)


def test_neighbourhoods_match_plain_counting(spark, monkeypatch):
    monkeypatch.setattr(m, "HEAD", 0)
    rng = np.random.default_rng(3)
    lists = [(rng.integers(0, 9001, 200) % rng.integers(1, 9001)).astype(np.int32) for _ in range(40)]
    docs = spark.createDataFrame([(bytearray(x.tobytes()),) for x in lists], "ids binary").repartition(5)
    blocks = -(-9000 // m.ROWS)
    plain = np.zeros((blocks * m.ROWS, 2 * m.CONTEXT))
    for ids in lists:
        for i, w in enumerate(ids):
            for d in range(1, m.REACH + 1):
                if w < 9000 and i >= d and ids[i - d] < m.CONTEXT:
                    plain[w, ids[i - d]] += 1
                if w < 9000 and i + d < len(ids) and ids[i + d] < m.CONTEXT:
                    plain[w, m.CONTEXT + ids[i + d]] += 1
    rows = m.neighbours(docs, 9000).collect()
    assert len({r.block for r in rows}) == len(rows)
    got = np.zeros(plain.shape)
    for r in rows:
        got[r.block * m.ROWS:(r.block + 1) * m.ROWS].ravel()[np.frombuffer(r.data, np.int32)] = np.frombuffer(r.n, np.float32)
    assert (got == plain).all()


def test_pair_counts_match_plain_counting():
    rng = np.random.default_rng(5)
    words = m.Words.of(rng.integers(0, m.CLASSES - 1, 300), rng.integers(3, 90, 300).astype(float))
    lists = [rng.integers(0, 301, k).astype(np.int32) for k in (1, 50, 7, 200)]
    plain = Counter()
    for ranks in lists:
        ids, _, before = words.history([ranks])
        plain.update((int(i), int(b)) for i, b in zip(ids, before) if i < words.n)
    starts, got = np.cumsum(words.sizes) - words.sizes, Counter()
    for b in m.pair_counts(0, iter([lists[:2], [], lists[2:]]), words):
        for r in b.to_pylist():
            c, before = divmod(r["block"], m.CLASSES + 1)
            for at, n in zip(np.frombuffer(r["data"], np.int32), np.frombuffer(r["n"], np.float32)):
                got[int(starts[c] + at), before] += int(n)
    assert got == plain


def test_each_block_ends_in_one_row_whatever_the_tasks(spark, monkeypatch):
    monkeypatch.setattr(m, "FAN", 3)
    one = np.ones(2, np.float32).tobytes()
    rows = [(t, b, bytearray(np.array([b, b + 1 + t % 2], np.int32).tobytes()), bytearray(one), 0) for t in range(40) for b in range(4)]
    df = spark.createDataFrame(rows, m._SPARSE_DDL)
    for tasks in (1, 7, 40, 500):
        got = {r.block: dict(zip(np.frombuffer(r.data, np.int32).tolist(), np.frombuffer(r.n, np.float32).tolist()))
               for r in m.in_levels(df, tasks, m.counts_summed).collect()}
        assert got == {b: {b: 40.0, b + 1: 20.0, b + 2: 20.0} for b in range(4)}


def test_packed_rows_keep_their_values():
    rng = np.random.default_rng(6)
    rows = rng.normal(size=(50, m.CLASSES)).astype(np.float32) * rng.choice([1e-4, 1, 30], (50, 1)).astype(np.float32)
    rows[3] = 0
    got = m.unpacked_rows(m.packed_rows(rows))
    assert (np.abs(got - rows) <= np.abs(rows).max(axis=1, keepdims=True) / 200 + 1e-8).all() and not got[3].any()
    assert m.unpacked_rows(m.packed_rows(rows[:0])).shape == (0, m.CLASSES)
    rows = rng.normal(size=(2 * m.WEIGHT_ROWS, m.CLASSES)).astype(np.float32)
    blocks = [m.packed_rows(rows[:m.WEIGHT_ROWS]), m.packed_rows(rows[m.WEIGHT_ROWS:])]
    at = rng.integers(0, len(rows), 100)
    assert (m.PackedTable(blocks).take(at) == m.unpacked_table(blocks)[at]).all()


def test_rows_of_weights_grow_with_the_words():
    for n in (0, 1, m.BUCKETS, m.BUCKETS + 1, 1_060_000, 3_000_000):
        rows = m.rows_of_weights(n)
        assert n <= rows <= max(m.BUCKETS, n + m.WEIGHT_ROWS - 1) and rows % m.WEIGHT_ROWS == 0


def test_history_needs_a_few_numbers_a_token():
    words = m.Words.of(np.zeros(10, np.int64), np.ones(10), m.BUCKETS)
    ranks = [np.zeros(100_000, np.int32)]
    tracemalloc.start()
    words.history(ranks)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 * len(ranks[0])


def test_encoded_words_are_the_tokens_of_the_texts():
    texts = ["", " \t\n ", "a b A", "\x0bc\x0cÉ É\r\n", "x\x1cy \x85\xa0 z\x00", "b", "a  b"]
    words, places, n = m.encoded_words(pa.array(["cut off", None, *texts[1:]]).slice(1))
    got = np.split(np.array(words.to_pylist(), object)[places], np.cumsum(n)[:-1])
    assert [list(g) for g in got] == [m.tokens(t.encode()) for t in texts]


def test_indexed_ranks_and_rare_words(spark):
    texts = ["b a", "", " c  A\tzz b zz", "é", "b" * 3000]
    docs = spark.createDataFrame([(i, t, False) for i, t in enumerate(texts)], "doc_id long, text string, held_out boolean")
    for vocabulary in (b"", b"a", b"b \n a nowhere", "é c".encode()):
        rank = {w: i for i, w in enumerate(m.split_words(vocabulary))}
        got = {r.doc_id: r for r in m.indexed(docs, vocabulary).collect()}
        for i, t in enumerate(texts):
            ws = m.tokens(t.encode())
            assert np.frombuffer(got[i].ids, np.int32).tolist() == [rank.get(w, len(rank)) for w in ws]
            assert [bytes(w) for w in got[i].rare] == [w for w in ws if w not in rank] and got[i].n_tokens == len(ws)


def test_sums_of_runs_match_plain_adding():
    rng = np.random.default_rng(8)
    values = rng.normal(size=(500, m.CLASSES)).astype(np.float32)
    for lengths in ([1] * 40, [1, 2, 300, 1, 7, 8, 9], [20], [m.SHORT] * 3, rng.integers(1, 15, 60)):
        first = np.cumsum(lengths) - lengths
        at = rng.integers(0, len(values), sum(lengths))
        plain = [values[at[a:a + n]].astype(float).sum(axis=0) for a, n in zip(first, lengths)]
        got = m.sums_of_runs(values, at, first)
        assert got.dtype == np.float32 and got == pytest.approx(np.array(plain), rel=1e-5, abs=1e-5)


def test_a_task_has_one_python_worker(spark, monkeypatch):
    """Two Python steps in one stage would leave each executor with twice the workers and their tables."""
    plans, written = {}, m.written

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return written(df, name)

    monkeypatch.setattr(m, "written", noted)
    docs = spark.createDataFrame([(i, "a b c a b") for i in range(30)], "doc_id long, text string")
    m.score(docs).collect()
    for name, plan in plans.items():
        for stage in re.split(r"Exchange|Scan", plan):
            assert len(re.findall(r"MapInArrow|FlatMapGroupsInPandas|MapInPandas", stage)) < 2, name


def test_a_block_is_put_in_its_place():
    blocks = [m.packed_rows(np.full((m.WEIGHT_ROWS, m.CLASSES), x, np.float32)) for x in (0, 1, 2)]
    table = m.PackedTable(blocks)
    sent = pickle.loads(pickle.dumps(table, 5))
    table.put(1, blocks[2])
    assert [float(table.block(k).mean()) for k in range(3)] == pytest.approx([0, 2, 2])
    assert (table.unpacked() == m.unpacked_table([blocks[0], blocks[2], blocks[2]])).all()
    assert (sent.unpacked() == m.unpacked_table(blocks)).all()
