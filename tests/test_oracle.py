"""Every registered query against its DuckDB oracle at sf0.01."""

import pytest

from __spark_entry__ import entry
from oracle_harness import SF_ORACLE, compare, duck
from tradewatch.plans.oracle import oracle_sql
from tradewatch.plans.queries import registry as queries

KEYS = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_oracle():
    assert set(oracle_sql()) == set(queries())


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    r = compare(spark, SF_ORACLE, key, queries()[key], oracle_sql()[key], con)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["loaddate", "subdivision", "trader", "poscommodity", "dailyValue",
                          "breaks", "test"]
    assert df.count() > 0


@pytest.mark.parametrize("key", ["tenor_breaks", "day_trade_breaks", "account_date_skeleton"])
def test_session_time_zone_does_not_matter(spark, con, key):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        r = compare(spark, SF_ORACLE, key, queries()[key], oracle_sql()[key], con)
        assert r["values_match"] and r["spark_rows"] == r["oracle_rows"], r
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Kolkata"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
