"""Spelling variants: words one edit apart, found with k-d trees over letter counts.

1. A word is the vector of its letters' counts. A replaced letter takes 1 from one count
   and adds 1 to another (an L1 distance of at most 2); an added letter adds 1 to one. So per
   pair of lengths, (L, L) and (L, L + 1), near words are a range search about each word.
2. Lengths with many words are cut into cells by the top of a k-d tree, fitted on a bounded
   sample of words. A word lies in one cell and is looked for in every cell that its range meets:
   a split plane is crossed at most once upwards and once downwards.
3. A cell (or part of one, if it has many words) is a task's group: a k-d tree of the cell's words
   prunes by the same planes, leaves compare counts, and the order of the letters is verified.
4. Each group reports, for each word, how many near words it has there and the best of them; forms
   are followed to the last by pointer jumping.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import slices, written

#: Fixed values of the contract.
RUN = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT, DROP_ONE_IN, FORM_FACTOR = 7, 2, 31, 10
#: Words of a cell that a group holds, words that are looked for in it, words of a leaf.
CELL_WORDS, QUERY_WORDS, LEAF_WORDS = 16_384, 65_536, 64
#: Words, on average, that the cells of all large lengths are fitted on.
FIT_WORDS = 200_000
#: Letters that count as a group's unit of CELL_WORDS (longer words make smaller groups).
UNIT_LETTERS = 64
#: Dimensions: a to z, the upper half of Latin-1, and the rest by remainder.
OTHERS = 16
DIMENSIONS = 26 + 64 + OTHERS

#: What a word is in a cell: one of its words, or looked for there as a word of the same length or a letter shorter.
OWN, SAME, SHORTER = 0, 1, 2
ROUTED = "length int, cell int, kind int, word string, n long"
FOUND = "word string, n_near long, best_n long, best string"


def words(docs: DataFrame) -> DataFrame:
    """(word, n): the distinct words of all texts and how often they occur.

    A run of letters loses one letter where the hash of its document and itself says so. A null text has no
    words; a null id is empty in that hash. Repeated rows count each time.
    """
    runs = F.explode(F.regexp_extract_all("text", F.lit(f"({RUN})"), F.lit(1)))
    low = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    ident = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    placed = (docs.select(ident.alias("id"), "text").where("text IS NOT NULL").select("id", runs.alias("run"))
              .where(F.char_length("run") >= LEAST_LENGTH).select("id", low.alias("run"))
              .select("run", F.char_length("run").alias("length"), F.crc32(F.concat_ws(":", "id", "run")).alias("h")))
    word = F.expr(f"CASE WHEN h % {DROP_ONE_IN} = 0 THEN concat(substring(run, 1, int(h % length)), substring(run, int(h % length) + 2)) "
                  "ELSE run END")
    return (placed.select(word.alias("word")).where(F.char_length("word") >= LEAST_LENGTH)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT))


def letters(found: list[str], length: int) -> np.ndarray:
    """Code points of words of one length."""
    return np.frombuffer("".join(found).encode("utf-32-le"), "<u4").reshape(len(found), length)


def counts(codes: np.ndarray) -> np.ndarray:
    """Letter counts (words x DIMENSIONS)."""
    n, length = codes.shape
    at = np.where((codes >= 97) & (codes < 123), codes - 97,
                  np.where((codes >= 0xC0) & (codes < 0x100), codes - 0xC0 + 26, 90 + codes % OTHERS)).astype(np.int64)
    flat = np.bincount((at + np.arange(n)[:, None] * DIMENSIONS).ravel(), minlength=n * DIMENSIONS)
    return flat.reshape(n, DIMENSIONS).astype(np.int32)


@dataclass
class Tree:
    """A k-d tree: node i splits `axis[i]` between split[i] and split[i] + 1 (axis -1: a leaf, of the
    rows order[first[i]:last[i]])."""

    axis: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    first: np.ndarray
    last: np.ndarray
    order: np.ndarray

    @staticmethod
    def build(points: np.ndarray, leaf: int) -> Tree:
        order, nodes, todo = np.arange(len(points)), [], [(0, len(points), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            at, me = order[a:b], len(nodes)
            if parent >= 0:
                nodes[parent][2 + side] = me
            nodes.append([-1, 0, -1, -1, a, b])
            if b - a <= leaf:
                continue
            some = points[at]
            axis = int(some.var(axis=0).argmax())
            values = np.sort(some[:, axis])
            if values[0] == values[-1]:
                continue                                # anagrams: no plane tells them apart
            split = int(values[(len(values) - 1) // 2])
            if split == values[-1]:
                split = int(values[np.searchsorted(values, split) - 1])
            below = some[:, axis] <= split
            order[a:b] = np.concatenate((at[below], at[~below]))
            middle = a + int(below.sum())
            nodes[me][:2] = axis, split
            todo += [(a, middle, me, 0), (middle, b, me, 1)]
        return Tree(*np.array(nodes, np.int64).T, order)

    def search(self, points: np.ndarray, down: bool) -> tuple[np.ndarray, np.ndarray]:
        """(point, leaf): the leaves that may hold a row with one count of a point more, and, with `down`,
        another one less."""
        q, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        up_left, down_left = np.ones(len(q), bool), np.full(len(q), down)
        out_q, out_leaf = [], []
        while len(q):
            leaf = self.axis[node] < 0
            out_q.append(q[leaf])
            out_leaf.append(node[leaf])
            q, node, up_left, down_left = (v[~leaf] for v in (q, node, up_left, down_left))
            value, split = points[q, self.axis[node]], self.split[node]
            low = value <= split
            over, under = low & (value == split) & up_left, ~low & (value == split + 1) & down_left
            lower, upper = low | under, ~low | over
            q, node, up_left, down_left = (
                np.concatenate((q[lower], q[upper])), np.concatenate((self.left[node[lower]], self.right[node[upper]])),
                np.concatenate((up_left[lower], (up_left & ~over)[upper])),
                np.concatenate(((down_left & ~under)[lower], down_left[upper])))
        return np.concatenate(out_q), np.concatenate(out_leaf)

    def cell(self, points: np.ndarray) -> np.ndarray:
        """The leaf that each point lies in."""
        node = np.zeros(len(points), np.int64)
        while (inner := np.flatnonzero(self.axis[node] >= 0)).size:
            at = node[inner]
            node[inner] = np.where(points[inner, self.axis[at]] <= self.split[at], self.left[at], self.right[at])
        return node


def near_pairs(rows: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) of words exactly one edit apart: rows of one length, queries of the same or one letter less."""
    same = rows.shape[1] == queries.shape[1]
    points, asked = counts(rows), counts(queries)
    tree = Tree.build(points, LEAF_WORDS)
    q, leaf = tree.search(asked, same)
    order = np.argsort(leaf, kind="stable")
    q, leaf = q[order], leaf[order]
    # Squared distances by a matrix product: exact in float32 while counts are small.
    kind = np.float32 if rows.shape[1] < 2000 else np.float64
    points, asked = points.astype(kind), asked.astype(kind)
    size, asked_size = (points * points).sum(axis=1), (asked * asked).sum(axis=1)
    starts = np.flatnonzero(np.r_[True, leaf[1:] != leaf[:-1]]) if len(leaf) else np.zeros(0, int)
    out_q, out_r = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a, b in zip(starts, np.r_[starts[1:], len(leaf)]):
        at = tree.order[tree.first[leaf[a]]:tree.last[leaf[a]]]
        for c in range(a, b, 4096):
            some = q[c:min(c + 4096, b)]
            for e in range(0, len(at), 4096):
                part = at[e:e + 4096]
                apart = asked_size[some][:, None] + size[part] - 2 * (asked[some] @ points[part].T)
                i, j = np.nonzero(apart <= (2 if same else 1))
                i, j = some[i], part[j]
                keep = one_replaced(rows[j], queries[i]) if same else one_added(rows[j], queries[i])
                out_q.append(i[keep])
                out_r.append(j[keep])
    return np.concatenate(out_q), np.concatenate(out_r)


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_added(longer: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """The equal head and the equal tail cover the shorter word."""
    head = np.logical_and.accumulate(longer[:, :-1] == shorter, axis=1).sum(axis=1)
    tail = np.logical_and.accumulate((longer[:, 1:] == shorter)[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= shorter.shape[1]


def _best(of: np.ndarray, near: np.ndarray, of_words: np.ndarray, near_words: np.ndarray, near_n: np.ndarray) -> pd.DataFrame:
    """For each word `of` the number of its near words and the one of largest n (ties: smallest)."""
    rank = np.empty(len(near_words), np.int64)
    order = np.array(sorted(range(len(near_words)), key=lambda i: (-near_n[i], near_words[i])), np.int64)
    rank[order] = np.arange(len(order))
    at = np.lexsort((rank[near], of))
    of, near = of[at], near[at]
    start = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, int)
    return pd.DataFrame({"word": of_words[of[start]], "n_near": np.diff(np.r_[start, len(of)]),
                         "best_n": near_n[near[start]], "best": near_words[near[start]]})


def _search_group(part: pd.DataFrame) -> pd.DataFrame:
    """Near words of a group's own words and the words looked for among them."""
    out = []
    own = part[part["kind"] == OWN]
    for kind in (SAME, SHORTER):
        asked = part[part["kind"] == kind]
        if not len(own) or not len(asked):
            continue
        length = int(part["length"].iloc[0])
        rows, queries = letters(own["word"].tolist(), length), letters(asked["word"].tolist(), length - (kind == SHORTER))
        q, r = near_pairs(rows, queries)
        mine, theirs = own["word"].to_numpy(object), asked["word"].to_numpy(object)
        out.append(_best(q, r, theirs, mine, own["n"].to_numpy()))
        if kind == SHORTER:
            out.append(_best(r, q, mine, theirs, asked["n"].to_numpy()))
    return pd.concat(out) if out else pd.DataFrame({"word": [], "n_near": [], "best_n": [], "best": []})


def _cells(found: DataFrame) -> dict[int, Tree]:
    """The trees that cut the lengths with more words than a group holds; as many leaves as groups."""
    many = found.groupBy(F.char_length("word").alias("length")).count().where(F.col("count") > CELL_WORDS).collect()
    if not many:
        return {}
    share = min(1.0, FIT_WORDS / sum(r["count"] for r in many))
    chance = F.xxhash64("word").bitwiseAND(0xFFFFFF) / float(1 << 24)
    sample = (found.where(F.char_length("word").isin([r["length"] for r in many]) & (chance < share)).select("word")
              .orderBy("word").toArrow().column("word").to_pylist())
    by_length: dict[int, list[str]] = {}
    for w in sample:
        by_length.setdefault(len(w), []).append(w)
    trees = {}
    for length, some in by_length.items():
        tree = Tree.build(counts(letters(some, length)), max(1, int(CELL_WORDS * share)))
        tree.order = np.zeros(0, np.int64)
        trees[length] = tree
    return trees


def _route(found: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """The cells of each word: where it lies, and where its near words may."""
    shared = found.sparkSession.sparkContext.broadcast(trees)

    def places(length: int, points: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray]:
        tree = shared.value.get(length)
        if tree is None:
            return np.arange(len(points)), np.zeros(len(points), np.int64)
        return (np.arange(len(points)), tree.cell(points)) if kind == OWN else tree.search(points, kind == SAME)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "word", 1 << 20):
            every, n = batch.column("word").to_pylist(), np.asarray(batch.column("n"))
            size = np.array([len(w) for w in every])
            for length in np.unique(size):
                at = np.flatnonzero(size == length)
                points = counts(letters([every[i] for i in at], int(length)))
                for kind in (OWN, SAME, SHORTER):
                    target = int(length) + (kind == SHORTER)
                    i, cell = places(target, points, kind)
                    i = at[i]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(i), target, np.int32)), pa.array(cell.astype(np.int32)),
                         pa.array(np.full(len(i), kind, np.int32)), pa.array([every[k] for k in i], pa.string()), pa.array(n[i])],
                        ["length", "cell", "kind", "word", "n"])

    return found.select("word", "n").mapInArrow(run, ROUTED)


def near_words(found: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n) that have a near word: how many, and the one of
    largest n (ties: the smallest word). No group holds more than CELL_WORDS and QUERY_WORDS words."""
    routed = written(_route(found, _cells(found)), "routed")
    weight = F.greatest(F.lit(1), F.expr(f"length div {UNIT_LETTERS}"))
    sizes = (routed.groupBy("length", "cell").agg(
                F.count(F.when(F.col("kind") == OWN, 1)).alias("own"), F.count(F.when(F.col("kind") != OWN, 1)).alias("asked"))
             .where("own > 0 AND asked > 0")
             .select("length", "cell", F.ceil(F.col("own") * weight / CELL_WORDS).cast("int").alias("parts"),
                     F.ceil(F.col("asked") * weight / QUERY_WORDS).cast("int").alias("shares")))
    spread = F.xxhash64("word")
    def every(n):
        return F.sequence(F.lit(0), F.col(n) - 1)
    is_own = F.col("kind") == OWN
    dealt = (routed.join(sizes, ["length", "cell"])
             .withColumn("part", F.when(is_own, F.array(F.pmod(spread, F.col("parts")).cast("int"))).otherwise(every("parts")))
             .withColumn("share", F.when(is_own, every("shares")).otherwise(F.array(F.pmod(spread, F.col("shares")).cast("int"))))
             .withColumn("part", F.explode("part")).withColumn("share", F.explode("share")))
    got = (dealt.select("length", "cell", "part", "share", "kind", "word", "n")
           .groupBy("length", "cell", "part", "share").applyInPandas(_search_group, FOUND))
    first = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return (got.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("b"))
            .select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last form reached. A form occurs FORM_FACTOR times as often as its
    word, so chains are short and the rounds few."""
    chain = written(forms.select("word", F.col("form").alias("root")), "chain")
    while True:
        ahead = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(chain.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                F.col("next").isNotNull().alias("moved")), "chain")
        chain = step.select("word", "root")
        if not step.where("moved").limit(1).count():
            return chain


def group_variants(found: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of (word, n), a table of distinct words.

    A word's form is its near word of largest n (ties: the smallest in code-point order) if that occurs
    `factor` times as often, at least; its root the last form reached from it, or itself. Words of any
    letters and length may be given; null or empty words are left out.
    """
    if factor < 2:
        raise ValueError("forms must occur more often than their words")
    found = written(found.where("word <> ''").select("word", F.col("n").cast("long").alias("n")), "words")
    enough = F.col("best_n") >= F.col("n") * factor
    near = written(found.join(near_words(found), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("best")).alias("form"),
        F.when(enough, F.col("best_n")).alias("form_n")), "near")
    roots = _roots(near.where("form IS NOT NULL"))
    return near.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """`group_variants` over the words of documents; an empty table gives no rows, other columns are ignored."""
    return group_variants(words(docs))
