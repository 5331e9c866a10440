"""Input bundles and output schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass
class PositionDims:
    locations: DataFrame      # location_code, location
    subdivisions: DataFrame   # subdivision_code, subdivision, division_code
    divisions: DataFrame      # division_code, division
    workdays: DataFrame       # workday


@dataclass
class FillDims:
    commodity: DataFrame           # description, subgroup_id, status_id
    commodity_subgroup: DataFrame  # id, group_id, status_id
    commodity_group: DataFrame     # id, description, status_id
    account_map: DataFrame         # source_report_code, source_id, location_id
    locations: DataFrame           # location_id, location, subdivision_id
    subdivisions: DataFrame        # subdivision_id, subdivision


def _struct(cols: str) -> T.StructType:
    types = {"date": T.DateType(), "string": T.StringType(), "double": T.DoubleType(),
             "bigint": T.LongType(), "decimal": T.DecimalType(12, 2)}
    return T.StructType([T.StructField(n, types[t]) for n, t in
                         (c.split() for c in cols.split(","))])


# Position fact: one row per position line and load day.
POSITIONS_SCHEMA = _struct(
    "loaddate date, commodity string, delta double, source string, location_code bigint, "
    "sub_location string, side string, trader_raw string, contract_month date, "
    "contract_number string, position_type string")

# Workday calendar: one row per working day.
WORKDAYS_SCHEMA = _struct("workday date")

# Futures fills: one row per fill (quantities as decimal(12,2): exact sums).
FILLS_SCHEMA = _struct(
    "trade_date date, load_date date, account string, account_name string, "
    "subdivision string, location string, commodity string, source string, "
    "position_month date, fin_type string, strike_price double, side string, "
    "gross_qty decimal, mtm decimal, broker_num string, card_number string, "
    "comment_code string")


# The break feed: one row per (test, date, subdivision, desk, commodity).
FEED_SCHEMA = T.StructType([
    T.StructField("loaddate", T.DateType()),
    T.StructField("subdivision", T.StringType()),
    T.StructField("trader", T.StringType()),
    T.StructField("poscommodity", T.StringType()),
    T.StructField("dailyValue", T.DoubleType()),
    T.StructField("breaks", T.IntegerType()),
    T.StructField("test", T.StringType()),
])
FEED_COLUMNS = [f.name for f in FEED_SCHEMA.fields]

AUDIT_SCHEMA = T.StructType([
    T.StructField("process", T.StringType()),
    T.StructField("step", T.StringType()),
    T.StructField("test", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("breaks", T.LongType()),
    T.StructField("min_date", T.DateType()),
    T.StructField("max_date", T.DateType()),
    T.StructField("success", T.IntegerType()),
    T.StructField("message", T.StringType()),
    T.StructField("run_user", T.StringType()),
    T.StructField("run_ts", T.TimestampType()),
])
