import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tradewatch.llm import spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(docs):
    """Word counts by the contract, in plain Python."""
    c = Counter()
    for ident, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if ident is None else ident}:{w}".encode())
            c[w if h % 31 else w[:h % len(w)] + w[h % len(w) + 1:]] += 1
    return {w: n for w, n in c.items() if len(w) >= 7 and n >= 2}


def edits(w, alphabet):
    out = {w[:i] + w[i + 1:] for i in range(len(w))} | {w[:i] + a + w[i + 1:] for i in range(len(w)) for a in alphabet}
    return (out | {w[:i] + a + w[i:] for i in range(len(w) + 1) for a in alphabet}) - {w}


def plain_groups(count, factor=10):
    alphabet, out = set("".join(count)), {}
    for w, n in count.items():
        near = [v for v in edits(w, alphabet) if v in count]
        best = min(near, key=lambda v: (-count[v], v), default=None)
        out[w] = [best if best is not None and count[best] >= factor * n else None, None, n, len(near), None]
        out[w][4] = count[out[w][0]] if out[w][0] is not None else None
    for w, row in out.items():
        at = w
        while out[at][0] is not None:
            at = out[at][0]
        row[1] = at
    return {w: tuple(row) for w, row in out.items()}


def rows(df):
    got = df.collect()
    assert len({r.word for r in got}) == len(got)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}


@pytest.fixture
def small_cells(monkeypatch):
    """Several cells a length, parts of cells and levels on few words."""
    monkeypatch.setattr(spelling, "CELL_WORDS", 60)
    monkeypatch.setattr(spelling, "QUERY_WORDS", 90)
    monkeypatch.setattr(spelling, "LEAF_WORDS", 4)


def family(seed, n=1500, letters="abcdé", least=5, most=9):
    """Words of few letters, so that nearly every word has near words, with counts over several powers of ten."""
    rng = np.random.default_rng(seed)
    return {"".join(rng.choice(list(letters), rng.integers(least, most))): int(10 ** rng.uniform(0.4, 5)) for _ in range(n)}


def test_crowded_words_match_brute_force(spark, small_cells):
    count = family(1)
    df = spark.createDataFrame(list(count.items()), "word string, n long").repartition(4)
    want = plain_groups(count)
    assert rows(spelling.group_variants(df)) == want
    assert sum(w != r[1] and want[w][0] != r[1] for w, r in want.items()) > 5       # roots beyond the first form


def test_anagrams_share_a_cell(spark, small_cells):
    # No plane parts them: the cell is cut into parts instead.
    rng = np.random.default_rng(2)
    count = {"".join(rng.permutation(list("aabbccdd"))): int(rng.integers(2, 500)) for _ in range(700)}
    df = spark.createDataFrame(list(count.items()), "word string, n long")
    assert rows(spelling.group_variants(df)) == plain_groups(count)


def test_any_letters(spark):
    count = {"日本語日本語": 50, "日本語日本誤": 3, "日本語日本": 700, "z": 4, "": 9, "zz": 40}
    df = spark.createDataFrame(list(count.items()) + [(None, 5)], "word string, n long")
    want = plain_groups({w: n for w, n in count.items() if w})
    assert rows(spelling.group_variants(df)) == want and want["日本語日本誤"][:2] == ("日本語日本", "日本語日本")


def test_documents_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CELL_WORDS", 1000)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = plain_groups(plain_words([tuple(r) for r in docs.collect()]))
    got = rows(spelling.spelling_variants(docs))
    assert got == want and sum(r[0] is not None for r in want.values()) > 100


def test_letter_order_is_verified():
    def codes(*w):
        return spelling.letters(list(w), len(w[0]))
    q, r = spelling.near_pairs(codes("abcdefg", "gfedcba", "abcdefh"), codes("abcdefg"))
    assert list(zip(q, r)) == [(0, 2)]
    q, r = spelling.near_pairs(codes("abcdefgh", "habcdefg", "gfedcbah"), codes("abcdefg"))
    assert sorted(zip(q, r)) == [(0, 0), (0, 1)]


def test_search_reaches_every_word_within_one_edit():
    rng = np.random.default_rng(4)
    points = rng.integers(0, 3, size=(500, spelling.DIMENSIONS))
    tree = spelling.Tree.build(points, 3)
    where = tree.cell(points)
    for down in (True, False):
        q, leaf = tree.search(points, down)
        found = set(zip(q.tolist(), leaf.tolist()))
        assert len(found) == len(q)
        for i in range(0, 500, 7):
            other = points[i].copy()
            other[rng.integers(0, spelling.DIMENSIONS)] += 1
            if down:
                other[rng.choice(np.flatnonzero(other))] -= 1
            assert (i, int(tree.cell(other[None])[0])) in found and (i, int(where[i])) in found


def test_odd_documents(spark, odd_docs, no_docs):
    want = plain_groups(plain_words([(r.doc_id, r.text) for r in odd_docs.collect()]))
    assert want and rows(spelling.spelling_variants(odd_docs)) == want
    assert spelling.spelling_variants(no_docs).count() == 0


def test_very_long_words(spark):
    long = "abcdefghij" * 30_000
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([long, long, long[:-1] + "k", long[:-1] + "k", long + "l", long + "l",
                                                               (long + "m ") * 40])], "doc_id long, text string")
    want = plain_words([tuple(r) for r in docs.collect()])
    got = rows(spelling.spelling_variants(docs))
    assert {w: r[2] for w, r in got.items()} == want and got[long][3] == 3
    assert got[long][0] == long + "m" == got[long][1] == got[long + "l"][0] and got[long + "m"][0] is None
