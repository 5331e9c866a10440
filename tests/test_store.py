"""Written fact tables: written once, read back with the declared schema."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.sources import store
from tradewatch.sources.store import written_table

SCHEMA = T.StructType([T.StructField("loaddate", T.DateType()), T.StructField("v", T.LongType())])


def test_written_once_and_reused(spark):
    calls = []

    def build():
        calls.append(1)
        # one date holds most rows: the range key is spread by a row hash
        return (spark.range(5000)
                .select(F.when(F.col("id") % 10 < 7, F.lit("2024-01-02"))
                        .otherwise(F.date_add(F.lit("2024-01-01"), (F.col("id") % 5).cast("int")))
                        .cast("date").alias("loaddate"), F.col("id").alias("v")))

    name = "t" + uuid.uuid4().hex[:8]
    src = [f"/nonexistent/{uuid.uuid4().hex}.parquet"]
    a = written_table(spark, name, build, src, "loaddate", SCHEMA)
    b = written_table(spark, name, build, src, "loaddate", SCHEMA)
    assert len(calls) == 1
    assert a.count() == b.count() == 5000
    assert a.schema == SCHEMA
    assert a.agg(F.sum("v")).first()[0] == sum(range(5000))


def test_read_input_table_and_path(spark):
    from tradewatch.schemas import FEED_SCHEMA
    from tradewatch.session import scratch_path
    from tradewatch.sources.tables import read_input

    path = scratch_path(spark, "readinput")
    df = spark.createDataFrame([], FEED_SCHEMA)
    df.write.parquet(path)
    assert read_input(spark, path, FEED_SCHEMA).schema == FEED_SCHEMA
    name = "ri_" + path.rsplit("-", 1)[-1]
    spark.catalog.createTable(name, source="parquet", path=path, schema=FEED_SCHEMA)
    assert read_input(spark, name).columns == FEED_SCHEMA.fieldNames()


def test_partial_write_is_rewritten(spark):
    import os

    from tradewatch.session import local_path, shared_dir

    name = "p" + uuid.uuid4().hex[:8]
    src = [f"/nonexistent/{uuid.uuid4().hex}.parquet"]
    build = lambda: spark.range(10).select(F.current_date().alias("loaddate"), F.col("id").alias("v"))
    a = written_table(spark, name, build, src, "loaddate", SCHEMA)
    assert a.count() == 10
    folder = local_path(a.inputFiles()[0]).rsplit("/", 1)[0]
    os.remove(os.path.join(folder, "_SUCCESS"))          # as if the commit never finished
    b = written_table(spark, name, build, src, "loaddate", SCHEMA)
    assert b.count() == 10 and os.path.exists(os.path.join(folder, "_SUCCESS"))
    assert shared_dir(spark)


def test_concurrent_first_use_writes_once(spark):
    import threading

    calls = []

    def build():
        calls.append(1)
        return spark.range(100).select(F.current_date().alias("loaddate"), F.col("id").alias("v"))

    name = "c" + uuid.uuid4().hex[:8]
    src = [f"/nonexistent/{uuid.uuid4().hex}.parquet"]
    out = []
    threads = [threading.Thread(target=lambda: out.append(
        written_table(spark, name, build, src, "loaddate", SCHEMA).count())) for _ in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert out == [100, 100, 100] and len(calls) == 1


def test_replaced_input_is_read_again(spark):
    from tradewatch.session import scratch_path

    source = scratch_path(spark, "source")
    name = "r" + uuid.uuid4().hex[:8]

    def table(n):
        spark.range(n).write.mode("overwrite").parquet(source)
        build = lambda: spark.read.parquet(source).select(F.current_date().alias("loaddate"), F.col("id").alias("v"))
        return written_table(spark, name, build, [source], "loaddate", SCHEMA).count()

    assert [table(10), table(500)] == [10, 500]


def test_schema_is_part_of_the_key(spark):
    name, src = "s" + uuid.uuid4().hex[:8], [f"/nonexistent/{uuid.uuid4().hex}.parquet"]
    build = lambda: spark.range(3).select(F.current_date().alias("loaddate"), F.col("id").alias("v"), F.col("id").alias("w"))
    assert written_table(spark, name, build, src, "loaddate", SCHEMA).columns == ["loaddate", "v"]
    wide = T.StructType([*SCHEMA.fields, T.StructField("w", T.LongType())])
    assert written_table(spark, name, build, src, "loaddate", wide).columns == ["loaddate", "v", "w"]


def test_file_count_follows_the_source_bytes(spark, tmp_path, monkeypatch):
    source = tmp_path / "src.parquet"
    spark.range(100).write.parquet(str(source))
    seen = []
    monkeypatch.setattr(store, "_fingerprint", lambda *a: ("0" * 16, seen[-1]))
    monkeypatch.setattr(store, "_write", lambda spark, build, path, size, *a: size // store.BYTES_PER_FILE)
    for gb in (1, 6):
        seen.append(gb << 30)
        # About 4 times its source is one task's input: 1,500 MB of it at most, with a good margin.
        assert 4 * seen[-1] / written_table(spark, "sized", lambda: None, [str(source)], "loaddate", SCHEMA) <= 256 << 20
