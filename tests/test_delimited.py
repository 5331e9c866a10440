"""Bulk loads: good lines are kept, the others reported with a reason."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from tradewatch.operators import feed as FD
from tradewatch.schemas import FEED_SCHEMA
from tradewatch.session import scratch_path
from tradewatch.sources.delimited import TooManyRejects, load_delimited

GOOD = ["2024-01-02~s~t~c~1.5~1~x", "2024-01-03~\\N~\"\"~\"a~b\"~\\N~0~\"say \\\"hi\\\"~\"", "   ", ""]
BAD = [("2024-01-02~s~t", "fields", None), ("2024-01-02~s~t~c~1.5~1~x~more", "fields", None), ("2024-01-02~s~t~c~much~1~x", "type", "dailyValue"),
       ("someday~s~t~c~1.5~1~x", "type", "loaddate"), ("2024-01-02~s~t~c~1.5~1.5.1~x", "type", "breaks"),
       ("2024-02-30~s~t~c~1.5~99999999999~x", "type", "loaddate"), ("~~~~~~~~", "fields", None)]


def staged(spark, lines):
    path = scratch_path(spark, "delimited")
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(3).write.text(path)
    return path


def test_rejects_have_their_reason(spark):
    load = load_delimited(spark, staged(spark, GOOD + [b[0] for b in BAD]), FEED_SCHEMA)
    got = sorted((r.line, r.reason, r.field) for r in load.rejects.collect())
    assert got == sorted(BAD) and all(r.file.startswith("part-") for r in load.rejects.collect())
    rows = sorted(map(tuple, load.rows.collect()), key=str)
    assert rows == sorted([(dt.date(2024, 1, 2), "s", "t", "c", 1.5, 1, "x"),
                           (dt.date(2024, 1, 3), None, "", "a~b", None, 0, 'say "hi"~')], key=str)
    assert load.rows.schema.simpleString() == FEED_SCHEMA.simpleString()


def test_a_bound_on_rejects(spark):
    path = staged(spark, GOOD + [b[0] for b in BAD])
    load = load_delimited(spark, path, FEED_SCHEMA)
    assert load.within(len(BAD)).count() == 2
    with pytest.raises(TooManyRejects, match="more than 6 lines"):
        load.within(len(BAD) - 1)
    assert load_delimited(spark, staged(spark, GOOD), FEED_SCHEMA).within(0).count() == 2


def test_bounded_texts(spark):
    schema = T.StructType([T.StructField("a", T.VarcharType(3)), T.StructField("b", T.DecimalType(6, 2))])
    load = load_delimited(spark, staged(spark, ["abc~1.25", "abcd~1.25", "äöü~12345678", "\\N~\\N"]), schema)
    assert sorted((r.line, r.reason, r.field) for r in load.rejects.collect()) == [("abcd~1.25", "length", "a"), ("äöü~12345678", "type", "b")]
    assert sorted(((r.a, r.b and str(r.b)) for r in load.rows.collect()), key=str) == [("abc", "1.25"), (None, None)]


def test_other_separators_and_no_lines(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    load = load_delimited(spark, staged(spark, ["1|x", "2|\"y|z\"", "3"]), schema, sep="|")
    assert sorted(map(tuple, load.rows.collect())) == [(1, "x"), (2, "y|z")] and load.rejects.count() == 1
    none = load_delimited(spark, staged(spark, []), schema)
    assert none.rows.count() == none.rejects.count() == 0


def test_reads_what_the_stage_writes(spark):
    odd = [(dt.date(2024, 1, 2), 's~"1"', "back\\slash", "", 0.1, 1, None), (None, None, "ü", "c", None, None, "\"")]
    path = scratch_path(spark, "staged")
    FD.stage_delimited(spark.createDataFrame(odd, FEED_SCHEMA), path)
    load = load_delimited(spark, path, FEED_SCHEMA)
    want = sorted(map(tuple, FD.read_delimited(spark, path).collect()), key=str)
    assert load.rejects.collect() == [] and sorted(map(tuple, load.rows.collect()), key=str) == want == sorted(odd, key=str)
