"""Positions, fills and dimensions derived from the driver's test tables.

The surveillance job reads a position fact, a futures-fill fact and a few
small dimensions. The driver ships TPC-H-like tables instead; this module
maps them (and only this module knows the mapping):

positions = lineitem JOIN orders JOIN part, one row per line item
    loaddate        date(o_orderdate)     contract_month  date(l_shipdate)
    commodity       p_type                sub_location    p_name
    delta           l_quantity, negative when l_linestatus = 'O'
    source          o_orderstatus         trader_raw      o_orderpriority, null or blank by o_orderkey % 11, % 13
    location_code   l_suppkey             contract_number 'C' || o_orderkey
    side            l_returnflag A/R/N -> Purchase/Sale/NA
    position_type   line 7 -> 'ALT', line 6 -> null, else 'STD'
locations (by code) = supplier, subdivisions = nation, divisions = region
workdays = distinct non-weekend order dates

fills = events, k = props.k
    trade_date date(ts)          load_date  date(ts + 2 hours)
    account    'AC' || user_id % 40 (2 digits)   account_name 'HOLDER ' || user_id % 40 % 9
    subdivision 'SUB_' || user_id % 5            location 'LOC_' || event_id % 3
    commodity  p_type of part k                  source by event_id % 6
    position_month month of trade + k % 3        fin_type F/O by k parity
    strike_price null when k % 10 = 9, else (k % 2) * 5
    side       B (purchase, click) / S (view, signup), null for 'error' events
    gross_qty  value, mtm  value signed by k parity (both decimal(12,2): exact sums)
    broker_num / card_number / comment_code flagged by k % 17 / k % 19 / k % 11
account_map   = nation x source ids {3, 67, 0}; account 'AC' || n_nationkey
locations by id = nation (subdivision id = region), subdivisions by id = region
commodity     = distinct part (p_type, subgroup length(p_type)), inactive when p_size = 50
commodity_subgroup = distinct part (p_size, group p_size % 4), inactive when p_size = 8
commodity_group    = region: (r_regionkey, capitalised r_name || ' Group')
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.functions import is_weekday
from tradewatch.schemas import FillDims, PositionDims

_TYPES = {"int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
          "string": T.StringType(), "timestamp_ntz": T.TimestampNTZType()}


def _schema(cols: str) -> T.StructType:
    fields = [c.split() for c in cols.split(",")]
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in fields])


# Columns this adapter reads, with the files' physical types. An explicit
# schema skips the footer-inference job Spark otherwise runs per read.
SCHEMAS = {
    "region": _schema("r_regionkey int, r_name string"),
    "nation": _schema("n_nationkey int, n_name string, n_regionkey int"),
    "supplier": _schema("s_suppkey bigint, s_name string, s_nationkey int"),
    "part": _schema("p_partkey bigint, p_name string, p_type string, p_size int"),
    "orders": _schema("o_orderkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
                      "o_orderpriority string"),
    "lineitem": _schema("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, "
                        "l_linenumber int, l_quantity double, l_returnflag string, "
                        "l_linestatus string, l_shipdate timestamp_ntz"),
    "events": _schema("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                      "value double, props string"),
}
TABLES = tuple(SCHEMAS)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table with its declared schema (the same plan every call,
    so Spark reuses scans and exchanges across the branches of a query)."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders")
    p = read_table(spark, sf_dir, "part")
    side = (F.when(F.col("l_returnflag") == "A", "Purchase")
            .when(F.col("l_returnflag") == "R", "Sale").otherwise("NA"))
    ptype = (F.when(F.col("l_linenumber") == 7, "ALT")
             .when(F.col("l_linenumber") == 6, F.lit(None).cast("string")).otherwise("STD"))
    trader = (F.when(F.col("o_orderkey") % 11 == 0, F.lit(None).cast("string"))
              .when(F.col("o_orderkey") % 13 == 0, "   ").otherwise(F.col("o_orderpriority")))
    return (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(p, li.l_partkey == p.p_partkey)
        .select(
            F.to_date("o_orderdate").alias("loaddate"),
            F.col("p_type").alias("commodity"),
            F.when(F.col("l_linestatus") == "O", -F.col("l_quantity"))
             .otherwise(F.col("l_quantity")).alias("delta"),
            F.col("o_orderstatus").alias("source"),
            F.col("l_suppkey").alias("location_code"),
            F.col("p_name").alias("sub_location"),
            side.alias("side"),
            trader.alias("trader_raw"),
            F.to_date("l_shipdate").alias("contract_month"),
            F.concat(F.lit("C"), F.col("o_orderkey").cast("string")).alias("contract_number"),
            ptype.alias("position_type"),
        )
    )


def position_dims(spark: SparkSession, sf_dir: str) -> PositionDims:
    s = read_table(spark, sf_dir, "supplier")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    o = read_table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    return PositionDims(
        locations=s.select(F.col("s_suppkey").alias("location_code"),
                           F.col("s_name").alias("location"),
                           F.col("s_nationkey").alias("subdivision_code")),
        subdivisions=n.select(F.col("n_nationkey").alias("subdivision_code"),
                              F.col("n_name").alias("subdivision"),
                              F.col("n_regionkey").alias("division_code")),
        divisions=r.select(F.col("r_regionkey").alias("division_code"),
                           F.col("r_name").alias("division")),
        workdays=o.select(day.alias("workday")).where(is_weekday("workday")).distinct(),
    )


def _k() -> Column:
    return F.regexp_extract("props", r'"k":\s*(\d+)', 1).try_cast("int")


def fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    k = F.col("k")
    trade_date = F.to_date("ts")
    acct = F.col("user_id") % 40
    source = (F.when(F.col("event_id") % 6 < 2, "FMT")
              .when(F.col("event_id") % 6 < 4, "WFC")
              .when(F.col("event_id") % 6 == 4, "SX0").otherwise("ICE"))
    side = (F.when(F.col("event_type").isin("purchase", "click"), "B")
            .when(F.col("event_type").isin("view", "signup"), "S"))
    comment = F.when(k % 11 == 0, "K").when(k % 11 == 1, " I").otherwise("N")
    ev = e.withColumn("k", _k())
    return (
        ev.join(p, ev.k == p.p_partkey, "left")
        .select(
            trade_date.alias("trade_date"),
            F.to_date(F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("load_date"),
            F.concat(F.lit("AC"), F.lpad(acct.cast("string"), 2, "0")).alias("account"),
            F.concat(F.lit("HOLDER "), (acct % 9).cast("string")).alias("account_name"),
            F.concat(F.lit("SUB_"), (F.col("user_id") % 5).cast("string")).alias("subdivision"),
            F.concat(F.lit("LOC_"), (F.col("event_id") % 3).cast("string")).alias("location"),
            F.col("p_type").alias("commodity"),
            source.alias("source"),
            F.add_months(F.trunc(trade_date, "MM"), k % 3).alias("position_month"),
            F.when(k % 2 == 0, "F").otherwise("O").alias("fin_type"),
            F.when(k % 10 == 9, F.lit(None).cast("double"))
             .otherwise((k % 2).cast("double") * 5.0).alias("strike_price"),
            side.alias("side"),
            F.col("value").cast("decimal(12,2)").alias("gross_qty"),
            F.when(k % 2 == 0, F.col("value")).otherwise(-F.col("value"))
             .cast("decimal(12,2)").alias("mtm"),
            F.when(k % 17 == 0, "BR0").otherwise("BRK").alias("broker_num"),
            F.when(k % 19 == 0, "CD0").otherwise("CRD").alias("card_number"),
            comment.alias("comment_code"),
        )
    )


def fill_dims(spark: SparkSession, sf_dir: str) -> FillDims:
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    p = read_table(spark, sf_dir, "part")
    code = F.concat(F.lit("AC"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    return FillDims(
        commodity=p.select(
            F.col("p_type").alias("description"),
            F.length("p_type").alias("subgroup_id"),
            F.when(F.col("p_size") == 50, "0").otherwise("1").alias("status_id")).distinct(),
        commodity_subgroup=p.select(
            F.col("p_size").alias("id"),
            (F.col("p_size") % 4).alias("group_id"),
            F.when(F.col("p_size") == 8, "0").otherwise("1").alias("status_id")).distinct(),
        commodity_group=r.select(
            F.col("r_regionkey").alias("id"),
            F.concat(F.upper(F.substring("r_name", 1, 1)), F.lower(F.substring("r_name", 2, 100)),
                     F.lit(" Group")).alias("description"),
            F.lit("1").alias("status_id")),
        account_map=n.select(
            code.alias("source_report_code"),
            F.explode(F.array(F.lit("3"), F.lit("67"), F.lit("0"))).alias("source_id"),
            F.col("n_nationkey").alias("location_id")),
        locations=n.select(F.col("n_nationkey").alias("location_id"),
                           F.col("n_name").alias("location"),
                           F.col("n_regionkey").alias("subdivision_id")),
        subdivisions=r.select(F.col("r_regionkey").alias("subdivision_id"),
                              F.col("r_name").alias("subdivision")),
    )
