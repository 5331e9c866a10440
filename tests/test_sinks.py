"""Feed sinks: append, cast by position, create, staging round trip, audit."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from tradewatch.operators import feed as FD
from tradewatch.schemas import FEED_SCHEMA
from tradewatch.session import scratch_path

d = dt.date.fromisoformat
ROWS = [(d("2024-01-02"), "s,1", "t~x", "c", 0.1, 1, "tenor breaks"),
        (d("2024-01-03"), None, "", "c", None, 0, "PnS breaks")]


def feed(spark):
    return spark.createDataFrame(ROWS, FEED_SCHEMA)


def _table(spark, name):
    path = scratch_path(spark, name)
    return "t_" + path.rsplit("-", 1)[-1], path


def test_create_then_append_doubles_g38_g39(spark):
    name, path = _table(spark, "append")
    assert not spark.catalog.tableExists(name)
    FD.append_feed(spark, feed(spark), name, path=path)
    assert spark.table(name).count() == 2
    FD.append_feed(spark, feed(spark), name)
    assert spark.table(name).count() == 4


def test_cast_by_position_g37(spark):
    name, path = _table(spark, "cast")
    target = T.StructType([
        T.StructField("a_date", T.DateType()), T.StructField("b_sub", T.VarcharType(3)),
        T.StructField("c_trader", T.StringType()), T.StructField("d_comm", T.StringType()),
        T.StructField("e_value", T.DoubleType()), T.StructField("f_breaks", T.LongType()),
        T.StructField("g_test", T.StringType())])
    spark.catalog.createTable(name, source="parquet", schema=target, path=path)
    FD.append_feed(spark, feed(spark), name, convert=True)
    long = spark.createDataFrame([(d("2024-01-04"), "abcdef", "t", "c", 0.0, 1, "x")], FEED_SCHEMA)
    FD.append_feed(spark, long, name, convert=True)
    got = spark.table(name).orderBy("a_date").collect()
    assert [r.b_sub for r in got] == ["s,1", None, "abc"]
    assert spark.table(name).schema["f_breaks"].dataType == T.LongType()


def test_varchar_cut_like_cast(spark):
    df = spark.createDataFrame([("abcdef",)], "x string")
    out = FD.cast_to_target(df, T.StructType([T.StructField("y", T.VarcharType(3))]))
    assert out.collect()[0].y == "abc"


def test_strict_append_rejects_string_into_int(spark):
    name, path = _table(spark, "strict")
    spark.catalog.createTable(name, source="parquet", path=path,
                              schema=T.StructType([T.StructField("n", T.IntegerType())]))
    bad = spark.createDataFrame([("x",)], "n string")
    with pytest.raises(Exception):
        FD.append_feed(spark, bad, name, convert=False)


def test_delimited_round_trip_g40(spark):
    path = scratch_path(spark, "stage")
    FD.stage_delimited(feed(spark), path)
    back = FD.read_delimited(spark, path, FEED_SCHEMA)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(ROWS, key=str)


def test_run_audit(spark):
    a = FD.run_audit(feed(spark)).orderBy("test").collect()
    assert [(r.test, r.rows, r.breaks, r.success, r.message) for r in a] == [
        ("PnS breaks", 1, 0, 1, ""), ("tenor breaks", 1, 1, 1, "")]
    fail = FD.audit_failure(spark, ValueError("it's \"bad\", x")).collect()[0]
    assert (fail.success, fail.message) == (0, "its bad x")


def test_strict_append_is_by_position(spark):
    name, path = _table(spark, "position")
    spark.catalog.createTable(name, source="parquet", path=path, schema=T.StructType(
        [T.StructField("a", T.StringType()), T.StructField("b", T.StringType())]))
    FD.append_feed(spark, spark.createDataFrame([("B", "A")], "b string, a string"), name, convert=False)
    assert tuple(spark.table(name).first()) == ("B", "A")


def test_replace_keeps_other_tests_and_drops_lost_days(spark):
    name, path = _table(spark, "replace")
    FD.replace_days(spark, feed(spark), name, path)
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    new = spark.createDataFrame([(d("2024-01-04"), "s", "t", "c", 1.0, 1, "tenor breaks")], FEED_SCHEMA)
    FD.replace_days(spark, new, name)
    assert spark.table(name).count() == 3 and spark.conf.get(key) == before
    FD.replace_days(spark, new, name)
    assert spark.table(name).count() == 3
    FD.replace_days(spark, new, name, since=d("2024-01-02"))
    got = sorted((str(r.loaddate), r.test) for r in spark.table(name).collect())
    assert got == [("2024-01-02", "tenor breaks"), ("2024-01-04", "tenor breaks")]
