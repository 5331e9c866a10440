"""The daily run: feed appended once, audit rows per test, failures audited."""

import pytest
from pyspark.sql import types as T

from oracle_harness import SF_SMALL
from tradewatch.plans.inputs import load_inputs
from tradewatch.plans.surveillance import daily_feed, run
from tradewatch.session import scratch_path


def _names(spark, tag):
    p = scratch_path(spark, tag)
    return "t_" + p.rsplit("-", 1)[-1], p


def test_run_writes_feed_and_audit(spark):
    i = load_inputs(spark, SF_SMALL)
    feed_t, feed_p = _names(spark, "runfeed")
    audit_t, audit_p = _names(spark, "runaudit")
    audit = run(spark, i, feed_t, audit_t, feed_path=feed_p, audit_path=audit_p)
    expected = daily_feed(i)
    assert spark.table(feed_t).count() == expected.count() > 0
    rows = {r.test: r for r in spark.table(audit_t).collect()}
    assert set(rows) == {r.test for r in expected.select("test").distinct().collect()}
    assert all(r.success == 1 for r in rows.values())
    assert sum(r.rows for r in rows.values()) == expected.count()
    assert audit.count() == len(rows)


def test_run_failure_is_audited(spark):
    i = load_inputs(spark, SF_SMALL)
    feed_t, feed_p = _names(spark, "badfeed")
    audit_t, audit_p = _names(spark, "badaudit")
    # an existing target with the wrong number of columns makes the append fail
    spark.catalog.createTable(feed_t, source="parquet", path=feed_p,
                              schema=T.StructType([T.StructField("x", T.IntegerType())]))
    with pytest.raises(ValueError):
        run(spark, i, feed_t, audit_t, audit_path=audit_p)
    (row,) = spark.table(audit_t).collect()
    assert row.success == 0 and row.step == "Writing feed" and "," not in row.message


def test_run_replace_twice_keeps_one_copy(spark):
    i = load_inputs(spark, SF_SMALL)
    feed_t, feed_p = _names(spark, "replfeed")
    run(spark, i, feed_t, feed_path=feed_p, replace=True)
    n = spark.table(feed_t).count()
    run(spark, i, feed_t, feed_path=feed_p, replace=True)
    assert spark.table(feed_t).count() == n == daily_feed(i).count()
