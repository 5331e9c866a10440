import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewatch.llm import elias_fano as ef
from tradewatch.llm import packing, tokens


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokens.vocabulary_path())


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def test_word_wise_ids_are_the_tokenizers(tokenizer):
    random.seed(1)
    e = tokens.Encoder(tokens.vocabulary_path())
    letters = [*"abcEFGéÉßİΣσςǅ.,'!?-0159<|>́̈ \t\n\x0b\x0c\x1c\x1f\x85  　中文。", "'s", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>",
               "don't.", "x.,y ", "Word. ", "ﬁ"]
    for _ in range(4000):
        t = "".join(random.choice(letters) for _ in range(random.randint(0, 25)))
        assert np.frombuffer(e.encode([t.encode()])[0], "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_words_in_use_outlive_a_full_table(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "MAX_WORDS", 40)
    random.seed(2)
    e = tokens.Encoder(tokens.vocabulary_path())
    for _ in range(60):
        t = "always kept " + " ".join("".join(random.choice("abcdeéß") for _ in range(6)) for _ in range(15))
        assert np.frombuffer(e.encode([t.encode()])[0], "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids
        assert len(e.young) <= 20 and len(e.old) <= 20 and b"kept" in e.young | e.old


def test_equal_rows_spread_over_partitions(spark):
    df = spark.createDataFrame([(7, "the same text")] * 2000 + [(i, f"text {i}") for i in range(4000)], "doc_id long, text string")
    sizes = [r["count"] for r in tokens.in_order(df.repartition(6)).groupBy(F.spark_partition_id()).count().collect()]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(sizes) == 6000 and max(sizes) < 2.2 * 6000 / n
    null = spark.createDataFrame([(None, None)] * 2000, "doc_id long, text string").repartition(6)
    assert max(r["count"] for r in tokens.in_order(null).groupBy(F.spark_partition_id()).count().collect()) < 2.2 * 2000 / n


def test_whole_texts_for_other_tokenizers():
    import public_tokenizers
    e = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not e.word_wise
    t = "two  words\n and more"
    assert np.frombuffer(e.encode([t.encode()])[0], "<u4").tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (1, 10**6), (700, 5), (700, 700), (2000, 10**12)])
def test_elias_fano_round_trip(n, top):
    v = np.sort(np.random.default_rng(n).integers(0, top, n))
    data = b"xx" + ef.EliasFano.of(v).to_bytes()
    e, end = ef.EliasFano.from_bytes(memoryview(data), 2)
    assert end == len(data) and e.all().tolist() == v.tolist()
    for i in ([*range(0, n, 97), n - 1] if n else []):
        assert e.select(i) == v[i]
    if n >= 700:
        assert len(data) * 8 <= n * (2.2 + max(1, np.log2(top / n) + 1)) + 400      # near the optimum, no 64-bit table
    with pytest.raises(IndexError):
        e.select(n)


def test_segment_select():
    ids = [np.arange(k, dtype="<u4").tobytes() for k in (1, 5, 1, 400, 2)]
    s = ef.Segment(ef.segment([None, -9, -9, 4, 2**62], ids, 77, 2))
    assert s.before == 77 and [s.doc_id(i) for i in range(5)] == [None, -9, -9, 4, 2**62] == s.documents()[0]
    assert [s.span(i) for i in range(5)] == [(0, 1), (1, 6), (6, 7), (7, 407), (407, 409)]
    assert s.ids[slice(*s.span(3))].tolist() == list(range(400))


def test_files_round_trip(spark, odd_docs, no_docs, tokenizer):
    folder = ef.token_folder(spark)
    ef.write_tokens(odd_docs, folder, segment_ids=50)
    got = ef.read_tokens(spark, folder).orderBy("start").collect()
    rows = odd_docs.select("doc_id", "text").collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, bytes(r.ids)) for r in got) == sorted(
        (r.doc_id is not None, r.doc_id or 0, ids_of(tokenizer, r.text).tobytes()) for r in rows)
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    ids = [r.doc_id for r in got]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])
    empty = ef.token_folder(spark)
    ef.write_tokens(no_docs, empty)
    assert ef.read_tokens(spark, empty).count() == 0


def plain_best(cuts, penalty, size):
    """Least cost by trying every window."""
    pos, cost = [0, *cuts], {0: 0.0}
    for j, p in zip(cuts, penalty):
        cost[j] = min(cost[i] + (0 if (j - i) & (j - i - 1) == 0 and j - i >= packing.LEAST_EXACT else size - (j - i))
                      for i in pos if i < j and j - i <= size) + p + packing.PER_WINDOW
    return cost[cuts[-1]]


def test_best_cuts_are_optimal():
    rng = np.random.default_rng(0)
    for _ in range(30):
        n, size = int(rng.integers(50, 1500)), 256
        cuts = np.unique(np.concatenate((rng.integers(1, n, n // 6), np.arange(200, n, 200), [n])))
        penalty = rng.integers(0, 7, len(cuts)).astype(float)
        ends = packing.best_cuts(cuts, penalty, size).tolist()
        at, cost = 0, 0.0
        pen = dict(zip(cuts.tolist(), penalty.tolist()))
        for e in ends:
            k = e - at
            assert 0 < k <= size
            cost += (0 if k & (k - 1) == 0 and k >= packing.LEAST_EXACT else size - k) + pen[e] + packing.PER_WINDOW
            at = e
        assert at == n and abs(cost - plain_best(cuts.tolist(), penalty.tolist(), size)) < 1e-6


def check_pieces(pieces, docs, tokenizer, size=2048):
    by_doc, by_sequence = {}, {}
    for r in pieces:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, rows in by_doc.items():
        want = sorted(ids_of(tokenizer, t).tobytes() for t in docs[i])
        # Documents that share an id are told apart by the runs of their pieces.
        total = b"".join(bytes(r.ids) for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)))
        assert len(total) == sum(map(len, want)) and all(w in total for w in want)
        assert all(len(r.ids) == 4 * r.length and r.start + r.length <= r.doc_tokens for r in rows)
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return by_sequence


def test_packing_edge_cases(odd_docs, no_docs, tokenizer):
    docs = {}
    for r in odd_docs.select("doc_id", "text").collect():
        docs.setdefault(r.doc_id, []).append(r.text)
    check_pieces(packing.pack_documents(odd_docs).collect(), docs, tokenizer)
    assert packing.pack_documents(no_docs).count() == 0


def test_packing_keeps_padding_low(spark, tokenizer):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pieces = packing.pack_documents(table).collect()
    docs = {r.doc_id: [r.text] for r in table.collect()}
    sequences = check_pieces(pieces, docs, tokenizer)
    lengths = [sum(r.length for r in rows) for rows in sequences.values()]
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in lengths)
    assert padding < 0.02 * sum(lengths)
    one = packing.digest(packing.pack_documents(table)).where(F.col("start") == 0).first()
    assert one.ids_crc32 == zlib.crc32(ids_of(tokenizer, docs[one.doc_id][0])[:one.length].tobytes())


def test_new_words_of_lower_letters_go_straight_to_the_model(monkeypatch):
    enc = tokens.Encoder(tokens.vocabulary_path())
    words = [w.encode() for w in "wanderlusting \u00fcberqueren na\u00efvely zzyzxes".split()]
    known = enc._known
    want = [known(w) for w in words]
    enc.young.clear()
    monkeypatch.setattr(enc, "_known", lambda word: pytest.fail("looked for capitals and full stops"))
    assert enc.word_ids(words) == want == [enc._encode(w) for w in words]
    assert list(enc.young) == words
