"""A database query as an input: ranges of days, pruning, the column contract."""

import datetime as dt
import sqlite3
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oracle_harness import SF_SMALL
from tradewatch.operators import positions as P
from tradewatch.plans.inputs import load_inputs
from tradewatch.schemas import POSITIONS_SCHEMA
from tradewatch.sources import database as B
from tradewatch.sources.tables import read_input

COLUMNS = POSITIONS_SCHEMA.fieldNames()


@pytest.fixture(scope="module")
def extract(spark):
    """A database file with the position fact, a row without a day, and a log of what is asked of it."""
    path = tempfile.mkdtemp(prefix="tw-db-") + "/extract.db"
    rows = [tuple(v.isoformat() if isinstance(v, dt.date) else v for v in r) for r in load_inputs(spark, SF_SMALL).positions.select(COLUMNS).collect()]
    con = sqlite3.connect(path)
    con.execute(f"CREATE TABLE positions ({', '.join(c.upper() if c == 'delta' else c for c in COLUMNS)}, more)")
    con.executemany(f"INSERT INTO positions VALUES ({', '.join('?' * len(COLUMNS))}, 'x')", rows + [(None, *rows[0][1:])])
    con.commit()
    con.close()
    return B.Query("sqlite3", (path,), "SELECT * FROM positions", ranges=5)


def test_scoped_positions_through_the_query(spark, extract):
    i = load_inputs(spark, SF_SMALL)
    r = i.rules
    read = i.with_positions(read_input(spark, extract, POSITIONS_SCHEMA, since=r.since))

    def scoped(x):
        df = P.scoped_positions(x.positions, x.position_dims, r.positions.tenor_scopes, r.since, r.positions.desk_sources)
        return sorted(tuple(map(str, t)) for t in df.select("scope", "desk", *COLUMNS).collect())
    assert scoped(read) == scoped(i) and len(scoped(i)) > 0


def test_ranges_cover_each_day_once(spark, extract):
    every = B.read_query(spark, extract, POSITIONS_SCHEMA)
    i = load_inputs(spark, SF_SMALL)
    assert every.count() == i.positions.count() + 1 and every.where("loaddate IS NULL").count() == 1
    key = lambda t: tuple(map(str, t))
    got = sorted((tuple(x) for x in every.where("loaddate IS NOT NULL").select(COLUMNS).collect()), key=key)
    assert got == sorted((tuple(x) for x in i.positions.select(COLUMNS).collect()), key=key)


def reader(extract, since=None):
    return B.PushedQueryReader(POSITIONS_SCHEMA, extract, since)


def test_since_moves_the_first_range(extract):
    days = [p.first for p in reader(extract).partitions()]
    assert days[0] is None and len(days) == 6
    later = reader(extract, dt.date(1997, 1, 1)).partitions()
    assert later[0].first == "1997-01-02" and all(p.first for p in later) and len(later) == 5
    assert reader(extract, dt.date(2100, 1, 1)).partitions() == []


def test_filters_narrow_the_ranges(extract):
    r = reader(extract)
    at = ("loaddate",)
    filters = [B.GreaterThan(at, dt.date(1996, 5, 1)), B.LessThanOrEqual(at, dt.date(1996, 5, 4)), B.EqualTo(("commodity",), "x")]
    assert list(r.pushFilters(filters)) == filters                       # Spark applies them again
    parts = r.partitions()
    assert [p.first for p in parts] == ["1996-05-02", "1996-05-03", "1996-05-04"] and parts[-1].end == "1996-05-05"


def test_pushed_down_by_spark(spark, extract):
    key = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        df = B.read_query(spark, extract, POSITIONS_SCHEMA).where(F.col("loaddate") > F.lit(dt.date(1998, 6, 1)))
        assert df.count() == load_inputs(spark, SF_SMALL).positions.where(F.col("loaddate") > F.lit(dt.date(1998, 6, 1))).count() > 0
    finally:
        spark.conf.set(key, before)


def test_the_contract_names_what_is_wrong(spark, extract):
    more = T.StructType([*POSITIONS_SCHEMA.fields, T.StructField("nowhere", T.StringType())])
    with pytest.raises(Exception, match="no column nowhere"):
        B.read_query(spark, extract, more).collect()
    wrong = T.StructType([T.StructField("loaddate", T.DateType()), T.StructField("commodity", T.LongType())])
    with pytest.raises(Exception, match="column commodity holds a value that is no bigint"):
        B.read_query(spark, extract, wrong).collect()
    few = T.StructType([T.StructField("delta", T.DecimalType(12, 2)), T.StructField("loaddate", T.DateType())])
    assert B.read_query(spark, extract, few, dt.date(1998, 1, 1)).schema == few


def test_no_rows(spark, extract):
    none = B.Query(extract.module, extract.arguments, "SELECT * FROM positions WHERE 1 = 0")
    assert B.read_query(spark, none, POSITIONS_SCHEMA).count() == 0
