"""The registered queries of the operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.llm import ball_tree, html_extract, langid, maxent, mih, packing, secret_scan, spelling, warc, whitening
from tradewatch.llm.common import ship, table, written
from tradewatch.llm.decontam import contamination
from tradewatch.llm.elias_fano import read_tokens, token_folder, write_tokens
from tradewatch.llm.simhash import simhash_components

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold copies, edited ones too, of benchmark items."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "score", "share", "start", "end")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents, with linked multipart credentials."""
    return secret_scan.digest(secret_scan.find_secrets(table(spark, sf_dir, "documents")))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of all documents."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op4_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probabilities of all documents under a unigram and the maximum-entropy model."""
    return maxent.score(table(spark, sf_dir, "documents"))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op6_elias_fano(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as read back from token files with Elias-Fano boundaries."""
    folder = token_folder(spark)
    write_tokens(table(spark, sf_dir, "documents"), folder)
    return read_tokens(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose fingerprints differ in 3 bits or fewer."""
    return simhash_components(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of all pages' responses, written as WARC members and read back."""
    made = warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))
    back = warc.read_members(written(warc.members(made), "warc"))
    return back.select(
        "page_id", warc.header("WARC-Type").alias("warc_type"), "record_id",
        warc.header("WARC-Refers-To").alias("refers_to"), warc.header("WARC-Concurrent-To").alias("concurrent_to"),
        warc.header("WARC-Target-URI").alias("target_uri"), warc.header("WARC-Block-Digest").alias("block_digest"),
        warc.header("WARC-Source-Payload-Digest").alias("source_payload_digest"),
        warc.header("Content-Type").alias("content_type"), F.octet_length("block").cast("long").alias("n_bytes"),
        F.crc32("block").alias("block_crc32"))


def op9_mih(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    return mih.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed in order into sequences of at most 2048 ids."""
    return packing.digest(packing.pack_documents(table(spark, sf_dir, "documents")))


def op11_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest integer inner products of every vector whose id is divisible by 100, exactly."""
    return ball_tree.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, forms and roots."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 32 whitened components of all vectors."""
    return whitening.digest(whitening.whiten(table(spark, sf_dir, "embeddings")))


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)
    return run


def registry() -> dict[str, Query]:
    found = (op1_decontamination, op2_secrets, op3_langid, op4_maxent, op5_html, op6_elias_fano, op7_simhash,
             op8_warc, op9_mih, op10_packing, op11_ball_tree, op12_spelling,
             op13_whitening)
    return {q.__name__: _shipped(q) for q in found}


#: Every query beside every other row; list lengths keep vectors of another dimension apart.
OP11_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT) for c in embedding] AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([c for c in embedding if c IS NULL OR NOT isfinite(c)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([p[1] * p[2] for p in list_zip(q.x, c.x)]) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.x) = len(q.x)
  WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place, vec_id, score FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10
"""


def oracle_sql() -> dict[str, str]:
    """The exact search alone: tokenizers, hashing, alignment, training and eigenvectors are beyond SQL, so the
    tests hold the other queries against brute force, round trips and held-out accuracy."""
    return {"op11_ball_tree": OP11_SQL}
