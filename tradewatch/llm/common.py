"""Helpers shared by the operators: table reads, written intermediate tables, checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewatch.session import scratch_path


def ship(spark: SparkSession) -> None:
    """Send this package to the executors (once a session), so that Python workers can import it
    wherever the driver found it."""
    sc = spark.sparkContext
    if getattr(sc, "_tradewatch_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="tradewatch-"), "tradewatch_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(target)
    sc._tradewatch_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables (a file or a folder of files)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written to a fresh folder below ``spark.checkpoint.dir`` and read back.

    Cuts the lineage: a lost executor re-reads the files. Tasks commit their
    output atomically, so retried tasks leave no rows twice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def doc_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents; a null text counts as empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


def binary_list(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column (null: empty)."""
    a = column.cast(pa.large_binary()) if pa.types.is_large_string(column.type) else column.cast(pa.binary())
    return [b or b"" for b in a.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that a piece holds about `limit` bytes of `column` (or one row).

    Bounds a worker's memory when many long texts meet in one Arrow batch.
    """
    for batch in batches:
        n = batch.num_rows
        if batch.nbytes <= limit or n <= 1:
            if n:
                yield batch
            continue
        start, size = 0, 0
        lens = pa.compute.binary_length(batch.column(column)).to_pylist()
        for i, k in enumerate(lens):
            if size and size + (k or 0) > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += k or 0
        yield batch.slice(start, n - start)


def split_train(remainder: int, modulus: int):
    """Column: crc32 of the doc_id as text leaves `remainder` (the held-out rows); null id: training."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, F.lit(False))


def numbered(df: DataFrame, name: str) -> DataFrame:
    """`df`, written, with a column `row`: 0 to n - 1, each once, whatever keys the rows have.

    A row's place within its partition is written with it; the partitions' starts are added from a
    table of one row a partition.
    """
    flat = written(df.withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftrightunsigned("_at", 33)
    counts = flat.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)
    return (flat.withColumn("_part", part).join(starts, "_part")
            .select(*df.columns, place.alias("row")))
