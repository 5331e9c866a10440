"""Language identification by rank-order profiles.

A language's profile is the list of its most frequent character n-grams
(1 to 3 letters, with word boundaries), by rank. A document is compared with
each profile by the out-of-place distance: the sum, over the document's own
most frequent n-grams, of how far each one's rank is from its rank in the
profile; an n-gram that the profile lacks counts PROFILE places. N-grams of
equal count in the document share the mean of their ranks, so that short
texts, where most counts are one, are not ranked by chance.

Profiles are learned from a bounded sample of labelled rows (FIT_ROWS rows a
language, on average, by a hash of the doc_id); prediction reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewatch.llm.common import slices, split_train

#: n-grams kept of a language and of a document.
PROFILE = 400
#: Labelled rows of each language that the profiles are learned from, on average.
FIT_ROWS = 3000
#: Rows whose crc32(doc_id as text) leaves this remainder are never learned from.
HELD_OUT, MODULUS = 2, 4
UNKNOWN = "und"
_SHIFT = 21           # a code point and the boundary fit in 21 bits


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter or a mark of one."""
    import unicodedata

    return np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)])


def ngram_codes(text: str) -> np.ndarray:
    """Codes of all 1- to 3-grams of a text, lower-cased; everything but letters is a boundary.

    A code holds up to three symbols of 21 bits; n-grams with a boundary in
    the middle and the boundary alone are left out. Empty without letters.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    symbols = np.where(_letters()[points], points + 2, 1)
    symbols = np.concatenate(([1], symbols, [1]))
    edge = symbols == 1
    symbols = symbols[~(edge & np.concatenate(([False], edge[:-1])))]
    if len(symbols) < 3:
        return np.zeros(0, np.int64)
    edge = symbols == 1
    two = symbols[:-1] << _SHIFT | symbols[1:]
    three = two[:-1] << _SHIFT | symbols[2:]
    return np.concatenate((symbols[~edge], two, three[~edge[1:-1]]))


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def ranked(codes: np.ndarray, top: int = PROFILE) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, ranks from 0) of the most frequent n-grams; ties at the end go to the smaller code."""
    grams, counts = np.unique(codes, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    counts = counts[order]
    first = np.searchsorted(-counts, -counts, "left")
    last = np.searchsorted(-counts, -counts, "right")
    return grams[order[:top]], ((first + last - 1) / 2)[:top]


class Profiles:
    """The ranks of all profiles' n-grams, one column a language."""

    def __init__(self, rows: list[tuple[str, int, int]], top: int = PROFILE):
        """rows: (language, n-gram, rank from 0)."""
        self.top = top
        self.languages = sorted({r[0] for r in rows})
        column = {x: i for i, x in enumerate(self.languages)}
        self.grams = np.array(sorted({r[1] for r in rows}), np.int64)
        self.ranks = np.full((len(self.grams) + 1, len(self.languages)), np.nan)     # the last row: in no profile
        for lang, gram, rank in rows:
            self.ranks[np.searchsorted(self.grams, gram), column[lang]] = rank

    def distances(self, grams: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        """Out-of-place distance to each language."""
        at = np.searchsorted(self.grams, grams)
        at[at == len(self.grams)] = 0
        at[self.grams[at] != grams] = len(self.grams)
        apart = np.minimum(np.abs(self.ranks[at] - ranks[:, None]), self.top)
        return np.nan_to_num(apart, nan=self.top).sum(axis=0)

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score): the nearest profile, ties to the name first in order.

        The score is 1 at distance zero and 0 when no n-gram is in the profile.
        """
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        codes = ngram_codes(text)
        if not len(codes):
            return UNKNOWN, 0.0
        grams, ranks = ranked(codes, self.top)
        d = self.distances(grams, ranks)
        best = int(d.argmin())
        return self.languages[best], float(1 - d[best] / (self.top * len(grams)))


def learn(docs: DataFrame, fit_rows: int = FIT_ROWS, top: int = PROFILE) -> Profiles:
    """Profiles of every language in `lang`, from a sample of the rows that are not held out.

    Null texts and null languages are left out. What reaches the driver is
    one number and `top` n-grams a language.
    """
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()
                       & ~split_train(HELD_OUT, MODULUS)).select("doc_id", "lang", "text")
    sizes = known.groupBy("lang").count()
    # A number in [0, 1) from the doc_id; a language's rows are few enough below fit_rows / rows.
    chance = (F.xxhash64("doc_id").bitwiseAND(0xFFFFFF) / float(1 << 24))
    picked = (known.join(F.broadcast(sizes), "lang")
              .where(chance * F.col("count") < fit_rows).select("lang", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 2 << 20):
            by: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                by.setdefault(lang, []).append(ngram_codes(text))
            for lang, found in by.items():
                grams, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)], ["lang", "gram", "n"])

    counts = picked.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counts.withColumn("rank", rank).where(F.col("rank") <= top)
    return Profiles([(r["lang"], r["gram"], r["rank"] - 1) for r in best.select("lang", "gram", "rank").collect()], top)


def prediction(text: Column, profiles: Profiles) -> Column:
    """Struct (lang_pred, score) of a text column."""
    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([profiles.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict(text)


def identify(docs: DataFrame, fit_rows: int = FIT_ROWS, profiles: Profiles | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document row, whole text.

    `und` with score 0 for texts that are null, empty or without a letter, and
    for all when nothing could be learned. Repeated rows and null doc_ids stay
    (null ids count as not held out); other columns are ignored.
    """
    profiles = profiles or learn(docs, fit_rows)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        split_train(HELD_OUT, MODULUS).alias("held_out"),
                        prediction(F.col("text"), profiles).alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score"))


def keep_identified(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The documents whose language can be told (not `und`), with their columns as they are."""
    return docs.where(prediction(F.col("text"), learn(docs, fit_rows))["lang_pred"] != UNKNOWN)
