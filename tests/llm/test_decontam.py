import random

import numpy as np

from tradewatch.llm import decontam as d


def plain_align(a, sa, b, sb):
    h, best = np.zeros((len(a) + 1, len(b) + 1)), 0.0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            m = d.MATCH if a[i - 1] == b[j - 1] else d.STEM if sa[i - 1] == sb[j - 1] != 0 else d.MISMATCH
            h[i, j] = max(0, h[i - 1, j - 1] + m, h[i - 1, j] + d.GAP, h[i, j - 1] + d.GAP)
            best = max(best, h[i, j])
    return best


def test_alignment_matches_the_full_table():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = rng.integers(1, 8, rng.integers(1, 15)).astype(np.uint32)
        b = rng.integers(1, 8, rng.integers(0, 30)).astype(np.uint32)
        score, start, end = d.align(a, a // 3, b, b // 3)
        assert abs(score - plain_align(a, a // 3, b, b // 3)) < 1e-9
        assert abs(d.align(a, a // 3, b[start:end], b[start:end] // 3)[0] - score) < 1e-9


def test_exact_and_edited_copies_are_found(spark):
    random.seed(0)
    vocabulary = [f"{a}{b}{c}" for a in "bdfglmnprst" for b in "aeiou" for c in ("n", "rk", "st", "lo", "mi")]
    say = lambda n: [random.choice(vocabulary) for _ in range(n)]
    items = [(i, say(random.randint(15, 60))) for i in range(30)]
    rows, want = [], set()
    for i, words in items:
        for k, rate in enumerate((0.0, 0.1, 0.2)):
            copy = []
            for w in words:
                u = random.random()
                copy += say(1) if u < rate * 0.6 else [] if u < rate * 0.8 else [w, *say(1)] if u < rate else [w]
            doc = 1000 * (k + 1) + i
            rows.append((doc, " ".join(say(200) + copy + say(100)).capitalize().replace(" ", ",\n", 5)))
            want.add((doc, i))
    rows += [(i, " ".join(say(random.randint(1, 400)))) for i in range(300)]
    hot = items[0][1]                                    # one item copied into a third of all rows
    rows += [(9000 + k, " ".join(say(50) + hot + say(50))) for k in range(150)]
    want |= {(9000 + k, 0) for k in range(150)}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in d.contamination(docs, bench).collect()}
    assert not got - want and len(want - got) <= 2, (got - want, want - got)
    kept = {r.doc_id for r in d.decontaminate(docs, bench).collect()}
    assert kept == {r[0] for r in rows} - {x for x, _ in got}


def test_edge_cases(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "The quick, brown fox jumps over the lazy dog!", 0), (None, "words without any id here", 0),
                                   (2, None, 0), (3, "", 0), (4, "the dog", 0), (1, "lorem ipsum dolor sit amet consectetur", 0)],
                                  "item_id long, text string, doc_id long")
    got = sorted((str(r.doc_id), str(r.item_id)) for r in d.contamination(odd_docs, bench).collect())
    assert got == [("1", "1"), ("5", "1"), ("None", "None")]
    kept = d.decontaminate(odd_docs, bench)
    assert kept.schema == odd_docs.schema and kept.count() == odd_docs.count() - 4
    assert d.contamination(no_docs, bench).count() == 0
    assert d.contamination(odd_docs, bench.limit(0)).count() == 0


def test_clean_documents_stay_beside_short_items(spark):
    short = ["What is the boiling point of osmium", "Name the capital of Chad now",
             "Which of the following is the best answer to it", "How many of the people in the room are left handed today"]
    clean = ["I do not know what is the matter with a garden that is dry", "they name the capital of a company in the report",
             "which of the following is true was asked of him", "how many of the people in the village saw it is unknown"]
    copies = [f"question {t.upper()} and so on" for t in short]
    bench = spark.createDataFrame(list(enumerate(short)), "item_id long, text string")
    rows = list(enumerate(clean)) + [(100 + i, t) for i, t in enumerate(copies)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in d.contamination(docs, bench).collect()} == {(100 + i, i) for i in range(4)}
    assert {r.doc_id for r in d.decontaminate(docs, bench).collect()} == set(range(4))
    assert [round(d.least_score(n) / n, 6) for n in (5, 9, 15, 60)] == [0.9, 0.9, 0.4, 0.4]
    assert all(d.least_score(n) > 6 for n in range(7, 15)) and d.least_score(100) == 25
