"""Corpus pipeline: the stages that turn `documents` into packed training sequences.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradewatch.llm.common import ship, table, written
from tradewatch.llm.decontam import decontaminate
from tradewatch.llm.langid import keep_identified
from tradewatch.llm.packing import pack_documents
from tradewatch.llm.secret_scan import redact
from tradewatch.llm.simhash import near_dedup

# Contract of the near-dedup operator: 3-word shingles, 3 differing bits.
SHINGLE, MAX_BITS = 3, 3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told (no letter at all) go."""
    ship(spark)
    return keep_identified(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (the least doc_id)."""
    ship(spark)
    return near_dedup(docs, SHINGLE, MAX_BITS)


def benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item, edited or not, go."""
    ship(spark)
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    ship(spark)
    return redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 token ids."""
    ship(spark)
    return pack_documents(docs)


STAGES = [("language_id", language), ("simhash_dedup", near_copies), ("decontamination", benchmark_copies),
          ("secret_scan", secrets), ("packing", packed)]

#: Alignment, hashing and tokenizing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
