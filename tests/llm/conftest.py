import pytest
from pyspark.sql import functions as F

from tradewatch.llm.common import ship

LONG = "lorem ipsum dolor sit amet consectetur " * 20_000


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls in every column, empty, blank and very long texts, repeated rows and an
    extra column named like ones that operators make."""
    rows = [(1, "the quick brown fox jumps over the lazy dog", "en", "s", 43), (1, "the quick brown fox jumps over the lazy dog", "en", "s", 43),
            (2, None, None, None, None), (None, "words without any id here", "en", "s", 25), (None, None, None, None, None),
            (3, "", "en", "s", 0), (4, " \t\n ", "en", "s", 4), (5, LONG, "la", "s", len(LONG)), (6, "12345 67890", "xx", "s", 11),
            (7, "Ünïcödé wörds ÀÉ", "de", "s", 16), (2, "another text with the same id", "en", "s", 29)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumn("fp", F.lit("clash")).withColumn("spans", F.lit(1)).withColumn("score", F.lit(0)).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
