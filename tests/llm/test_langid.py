import zlib
from collections import Counter

from pyspark.sql import functions as F

from tradewatch.llm import langid as g


def plain_grams(text):
    """Counts of 1- to 3-grams, one string at a time."""
    import unicodedata
    clean = " ".join("".join(c if unicodedata.category(c)[0] in "LM" else " " for c in text.lower()).split())
    if not clean:
        return Counter()
    t = f" {clean} "
    n = Counter(c for c in t if c != " ")
    n.update(t[i:i + 2] for i in range(len(t) - 1))
    n.update(t[i:i + 3] for i in range(len(t) - 2) if t[i + 1] != " ")
    return n


def name(code):
    out = []
    while code:
        s = code & 0x1FFFFF
        out.append(" " if s == 1 else chr(s - 2))
        code >>= 21
    return "".join(reversed(out))


def test_ngrams_match_plain_counts():
    for t in ("Hello, wörld! 12 ok", "", "7 8", "a", "ÀÉ é́x  ß\n\nİI", "x" * 50, "́", "中文 字"):
        assert Counter(map(name, g.ngram_codes(t).tolist())) == plain_grams(t), t


def test_out_of_place_distance():
    code = {c: g.ngram_codes(c)[0] for c in "abcd"}
    rows = [("x", int(code["a"]), 0), ("x", int(code["b"]), 1), ("y", int(code["b"]), 0), ("y", int(code["c"]), 1)]
    p = g.Profiles(rows, top=10)
    import numpy as np
    order = np.argsort([code[c] for c in "abd"])
    d = p.distances(np.array([code[c] for c in "abd"])[order], np.array([1.0, 0.0, 2.0])[order])
    assert d.tolist() == [1 + 1 + 10, 10 + 0 + 10]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = g.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) > 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_no_learning_from_held_out_rows(spark):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 == 2]
    docs = spark.createDataFrame([(i, "only here", "zz") for i in ids], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in g.identify(docs).collect()} == {"und"}


def test_edge_cases(odd_docs, no_docs):
    got = g.identify(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert sum(r.lang_pred == "und" for r in got) == 5          # two nulls, empty, blank, digits
    kept = g.keep_identified(odd_docs)
    assert kept.schema == odd_docs.schema and kept.count() == odd_docs.count() - 5
    assert kept.where(F.col("doc_id").isNull()).count() == 1
    assert g.identify(no_docs).count() == 0 and g.keep_identified(no_docs).count() == 0
