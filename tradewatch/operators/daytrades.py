"""Day-trade test: quantity bought and sold by one account on one day.

Plan shape
----------
* ``fill_groups`` sums the fills by load date and the 11 group keys as they are spelled, in one hash
  aggregate. Every later step reads these groups, not the fills: sides, accounts and trading days. A kept
  table of them (``sources.fill_view``) is brought up to date by the days that arrive.
* Spellings of a text key that differ in case or trailing blanks are one key. They are collapsed over the
  groups, which are far fewer than the fills.
* Buys are left-joined to sells on six of those keys, so one buy group can
  meet several sell groups -- kept, as in the original.
* Every (account, day) is filled with a zero row so each mapped desk shows a
  value on each trading day: each key expands over the array of trading days (one scalar, bounded by the
  calendar) instead of a cross join, so exactly keys x days rows are made. For the break feed the
  days are applied after accounts are mapped to desks, so the rows grow with desks x days
  rather than accounts x days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.functions import (
    ilike_any,
    in_text,
    norm,
    not_in_text,
    same_text,
)
from tradewatch.params import (
    BUY_CODE,
    DAY_TRADE_QTY_LIMIT,
    EXCLUDED_COMMENT_CODES,
    MAPPED_SOURCE_IDS,
    SELL_CODE,
    SOURCE_IDS,
    TEST_DAY_TRADE,
    UNMAPPED_SOURCE_ID,
    FillRules,
)
from tradewatch.schemas import FEED_COLUMNS, FillDims
from tradewatch.session import scratch_path

GROUP_KEYS = ["trade_date", "account", "subdivision", "location", "commodity", "source",
              "position_month", "fin_type", "pors", "account_name", "strike_price"]
MATCH_KEYS = ["trade_date", "commodity", "account", "position_month", "fin_type", "strike_price"]
# Text keys are equal when they differ in case or trailing blanks only, as in the
# SQL layer; the least spelling of a group stands for it.
TEXT_KEYS = {"account", "subdivision", "location", "commodity", "source", "fin_type", "pors", "account_name"}
MEASURES = ["purchase_qty", "purchase_pnl", "sale_qty", "sale_pnl", "day_trade_qty",
            "day_trade_pnl"]
ROW_COLUMNS = GROUP_KEYS + MEASURES
OUT_COLUMNS = ["trade_date", "account", "subdivision", "location", "commodity",
               "day_trade_qty", "day_trade_pnl"]


GROUP_SCHEMA_KEYS = ["load_date", *GROUP_KEYS, "kept", "counted"]


def _account_filter(rules: FillRules) -> Column:
    """Filters every fill extract shares (account, desk, broker, card, dates,
    source, non-zero quantity), but the since-date."""
    return (not_in_text("account", rules.excluded_accounts)
            & ~ilike_any("account", rules.excluded_account_like)
            & ~ilike_any("subdivision", rules.excluded_subdivision_like)
            & ~same_text("broker_num", rules.excluded_broker)
            & ~same_text("card_number", rules.excluded_card)
            & (F.col("load_date") == F.col("trade_date"))
            & ~same_text("source", rules.excluded_source)
            & (F.col("gross_qty") != 0))


def _grouped(df: DataFrame, keys: list[str], *aggs: Column) -> DataFrame:
    """Group by keys, text keys by their normal form; the result has the least spelling of each."""
    by = [norm(k).alias(f"_{k}") if k in TEXT_KEYS else F.col(k) for k in keys]
    text = [F.min(k).alias(k) for k in keys if k in TEXT_KEYS]
    out = df.groupBy(*by).agg(*text, *aggs) if text or aggs else df.select(*by).distinct()
    return out.select(*keys, *[c for c in out.columns if c not in keys and not c.startswith("_")])


def fill_groups(fills: DataFrame, rules: FillRules) -> DataFrame:
    """Σ quantity and Σ MTM by load date and group keys as spelled, in the columns' own types (decimals stay decimals).

    ``kept``: the fills pass the account filters; ``counted``: they are bought or sold and enter the sums. Fills
    that are not kept count only by their dates (a trading day is one for every account), so they lose their
    other keys."""
    kept = F.coalesce(_account_filter(rules), F.lit(False))
    counted = kept & F.coalesce(not_in_text("comment_code", EXCLUDED_COMMENT_CODES)
                                & in_text("side", [BUY_CODE, SELL_CODE]), F.lit(False))
    marked = fills.select("*", kept.alias("kept"), counted.alias("counted")).withColumnRenamed("side", "pors")
    keys = [c if c == "trade_date" else F.when(F.col("kept"), F.col(c)).alias(c) for c in GROUP_KEYS]
    rows = marked.select("load_date", *keys, "kept", "counted", "gross_qty", "mtm")
    return rows.groupBy(*GROUP_SCHEMA_KEYS).agg(
        F.sum(F.when(F.col("counted"), F.col("gross_qty"))).alias("qty"),
        F.sum(F.when(F.col("counted"), F.col("mtm"))).alias("pnl"))


def group_sides(groups: DataFrame, since: dt.date) -> DataFrame:
    """Σ quantity and Σ MTM per group and side, spellings collapsed."""
    rows = groups.where(F.col("counted") & (F.col("load_date") > F.lit(since)))
    return _grouped(rows, GROUP_KEYS, F.sum("qty").alias("qty"), F.sum("pnl").alias("pnl"))


def fill_sides(fills: DataFrame, rules: FillRules, since: dt.date) -> DataFrame:
    return group_sides(fill_groups(fills, rules), since)


def day_trade_match(sides: DataFrame) -> DataFrame:
    """Buy groups left-joined to sell groups on six keys; matched quantity is
    the smaller side, null when there is no sell (not ``least``, which would
    skip the null)."""
    buys = (sides.where(same_text("pors", BUY_CODE))
            .withColumnRenamed("qty", "purchase_qty").withColumnRenamed("pnl", "purchase_pnl"))
    sells = sides.where(same_text("pors", SELL_CODE)).select(
        *[F.col(k).alias(f"s_{k}") for k in MATCH_KEYS],
        F.col("qty").alias("sale_qty"), F.col("pnl").alias("sale_pnl"))
    on = [norm(buys[k]) == norm(sells[f"s_{k}"]) if k in TEXT_KEYS else buys[k] == sells[f"s_{k}"]
          for k in MATCH_KEYS]
    m = buys.join(sells, on, "left")
    dtq = (F.when(F.col("purchase_qty") < F.col("sale_qty"), F.col("purchase_qty"))
           .otherwise(F.col("sale_qty")))
    return m.select(*GROUP_KEYS, "purchase_qty", "purchase_pnl", "sale_qty", "sale_pnl",
                    dtq.alias("day_trade_qty"))


def day_trade_pnl(match: DataFrame) -> DataFrame:
    """P&L of the matched part: the larger side's P&L pro rata plus the
    smaller side's whole P&L. Division by zero gives null (then 0 downstream)."""
    q, bq, sq, bp, sp = (F.col(c).cast("double") for c in (
        "day_trade_qty", "purchase_qty", "sale_qty", "purchase_pnl", "sale_pnl"))
    pnl = (F.when(bq > q, F.try_divide(q, bq) * bp + sp)
           .otherwise(F.try_divide(q, sq) * sp + bp))
    return match.withColumn("day_trade_pnl", pnl)


def group_accounts(groups: DataFrame, rules: FillRules, since: dt.date) -> DataFrame:
    """Distinct (account, name, commodity, source) of kept fills, spellings collapsed."""
    cond = (F.col("kept") & (F.col("load_date") > F.lit(since))
            & not_in_text("account_name", rules.excluded_account_names))
    return _grouped(groups.where(cond), ["account", "account_name", "commodity", "source"])


def skeleton_accounts(fills: DataFrame, rules: FillRules, since: dt.date) -> DataFrame:
    return group_accounts(fill_groups(fills, rules), rules, since)


def trading_days(groups: DataFrame, since: dt.date) -> DataFrame:
    """Distinct trade dates loaded after `since` (at most one row per
    calendar day, so the set is bounded by the calendar). Fills or their groups."""
    return (groups.where((F.col("load_date") > F.lit(since))
                         & (F.col("trade_date") >= F.col("load_date")))
            .select("trade_date").distinct())


def date_spine(keys: DataFrame, days: DataFrame, after: dt.date | None = None) -> DataFrame:
    """Every key on every day of `days` (after `after`), without a cross join: each key row
    expands over the array of the days that occur (a scalar sub-query)."""
    if after is not None:
        days = days.where(F.col("trade_date") > F.lit(after))
    every = days.select(F.array_sort(F.collect_set("trade_date"))).scalar()
    return keys.withColumn("trade_date", F.explode(every))


def _zero(measure: str) -> Column:
    """0 of a measure: a double for the P&L, else a decimal, which leaves decimal totals decimal."""
    zero = F.lit(0.0) if measure == "day_trade_pnl" else F.lit(0).cast("decimal(12,2)")
    return zero.alias(measure)


def account_date_skeleton(fills: DataFrame, rules: FillRules, since: dt.date) -> DataFrame:
    return group_skeleton(fill_groups(fills, rules), rules, since)


def group_skeleton(groups: DataFrame, rules: FillRules, since: dt.date) -> DataFrame:
    """Zero rows for every (account, name, commodity, source) x trading day,
    shaped like the matched rows."""
    spine = date_spine(group_accounts(groups, rules, since), trading_days(groups, since))
    nulls = {"subdivision": "string", "location": "string", "position_month": "date",
             "fin_type": "string", "pors": "string", "strike_price": "double"}
    cols = []
    for c in ROW_COLUMNS:
        if c in nulls:
            cols.append(F.lit(None).cast(nulls[c]).alias(c))
        elif c in MEASURES:
            cols.append(_zero(c))
        else:
            cols.append(F.col(c))
    return spine.select(*cols)


def buying_accounts(sides: DataFrame) -> DataFrame:
    return sides.where(same_text("pors", BUY_CODE)).select(norm("account").alias("_buyer")).distinct()


def active_accounts(rows: DataFrame, sides: DataFrame, rules: FillRules,
                    since: dt.date) -> DataFrame:
    """Rows of accounts with at least one buy group (semi join), minus the
    excluded account names, traded after `since`."""
    return (rows.join(buying_accounts(sides), norm("account") == F.col("_buyer"), "left_semi")
            .where(not_in_text("account_name", rules.excluded_account_names)
                   & (F.col("trade_date") > F.lit(since))))


def commodity_groups(dims: FillDims, rules: FillRules) -> DataFrame:
    """Active commodity -> group pairs, de-duplicated; the blocked pair is
    dropped, a commodity without a group is kept (null-safe)."""
    com = dims.commodity.where(same_text("status_id", "1")).select("description", "subgroup_id")
    sub = (dims.commodity_subgroup.where(same_text("status_id", "1"))
           .select(F.col("id").alias("sg_id"), "group_id"))
    grp = (dims.commodity_group.where(same_text("status_id", "1"))
           .select(F.col("id").alias("g_id"), F.col("description").alias("commgrp")))
    pairs = (com.join(sub, com.subgroup_id == sub.sg_id, "left")
             .join(grp, F.col("group_id") == F.col("g_id"), "left")
             .select(F.col("description").alias("commoditydescription"), "commgrp"))
    desc, group = rules.blocked_commodity_group
    blocked = same_text("commoditydescription", desc) & same_text("commgrp", group)
    return pairs.where(~F.coalesce(blocked, F.lit(False))).distinct()


def attach_group(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Left join on the commodity description; a commodity in several groups
    yields one row per group."""
    return (rows.join(groups, norm(rows.commodity) == norm(groups.commoditydescription), "left")
            .drop("commoditydescription"))


def source_id(source: Column | str) -> Column:
    out = None
    for src, sid in SOURCE_IDS:
        t = same_text(source, src)
        out = F.when(t, F.lit(sid)) if out is None else out.when(t, F.lit(sid))
    return out.otherwise(F.lit(UNMAPPED_SOURCE_ID))


def account_location(rows: DataFrame, dims: FillDims, rules: FillRules) -> DataFrame:
    """Account + source id -> location -> subdivision (inner joins on the
    account map), blocked locations dropped. Adds ``map_location`` and
    ``map_subdivision``."""
    amap = (dims.account_map.where(in_text("source_id", MAPPED_SOURCE_IDS))
            .select("source_report_code", "source_id", "location_id"))
    loc = dims.locations.select("location_id", F.col("location").alias("map_location"), "subdivision_id")
    sub = dims.subdivisions.select("subdivision_id", F.col("subdivision").alias("map_subdivision"))
    keyed = rows.withColumn("_source_id", source_id("source"))
    on = [(norm(keyed.account) == norm(amap.source_report_code)) & (keyed._source_id == amap.source_id)]
    return (keyed.join(amap, on, "inner")
            .join(loc, "location_id", "inner")
            .join(sub, "subdivision_id", "inner")
            .where(~ilike_any("map_location", [rules.blocked_location_like]))
            .drop("_source_id", "source_report_code", "source_id", "location_id",
                  "subdivision_id"))


def day_trade_rows(fills: DataFrame, dims: FillDims, rules: FillRules,
                   since: dt.date) -> DataFrame:
    """The full extract: matched and zero rows of active accounts, grouped
    commodity, mapped desk (columns ``OUT_COLUMNS``)."""
    return group_rows(fill_groups(fills, rules), dims, rules, since)


def group_rows(groups: DataFrame, dims: FillDims, rules: FillRules, since: dt.date) -> DataFrame:
    sides = group_sides(groups, since)
    matched = day_trade_pnl(day_trade_match(sides))
    rows = matched.select(*ROW_COLUMNS).unionByName(group_skeleton(groups, rules, since))
    rows = active_accounts(rows, sides, rules, since)
    mapped = account_location(attach_group(rows, commodity_groups(dims, rules)), dims, rules)
    return mapped.select("trade_date", "account", F.col("map_subdivision").alias("subdivision"),
                         F.col("map_location").alias("location"),
                         F.col("commgrp").alias("commodity"), "day_trade_qty", "day_trade_pnl")


def day_trade_breaks(rows: DataFrame, rules: FillRules,
                     limit: float = DAY_TRADE_QTY_LIMIT) -> DataFrame:
    """Null quantities to 0, one commodity dropped (exact, nulls kept), Σ
    matched quantity per (day, subdivision, commodity, desk); break above
    `limit`. Rows with a null key are left out, as the grouping did."""
    r = rows
    if rules.excluded_day_trade_subdivisions:
        hit = F.col("subdivision").isin(list(rules.excluded_day_trade_subdivisions))
        r = r.where(~F.coalesce(hit, F.lit(False)))
    r = (r.withColumn("day_trade_qty", F.coalesce("day_trade_qty", _zero("day_trade_qty")))
         .where(~F.col("commodity").eqNullSafe(rules.excluded_day_trade_commodity))
         .dropna(subset=["trade_date", "subdivision", "commodity", "location"]))
    agg = r.groupBy(F.col("trade_date").alias("loaddate"), "subdivision",
                    F.col("commodity").alias("poscommodity"),
                    F.col("location").alias("trader")).agg(
        F.sum("day_trade_qty").cast("double").alias("dailyValue"))
    return (agg.withColumn("breaks", F.when(F.col("dailyValue") > limit, 1).otherwise(0).cast("int"))
            .withColumn("test", F.lit(TEST_DAY_TRADE))
            .select(*FEED_COLUMNS))


SUMMARY_KINDS = ("side", "account", "day")


def group_summary(groups: DataFrame, rules: FillRules, since: dt.date) -> dict[str, DataFrame]:
    """Sides, accounts and trading days after `since` from one read and one aggregate of the groups.

    A group counts once for each of the three that it enters, without the keys that one doesn't have; the collapsed
    rows are written, and each part is a read of its own folder."""
    keys = {"side": set(GROUP_KEYS), "account": {"account", "account_name", "commodity", "source"}, "day": {"trade_date"}}
    enters = {"side": F.col("counted"),
              "account": F.col("kept") & F.coalesce(not_in_text("account_name", rules.excluded_account_names), F.lit(False)),
              "day": F.coalesce(F.col("trade_date") >= F.col("load_date"), F.lit(False))}
    marks = F.array_compact(F.array(*[F.when(enters[k], F.lit(k)) for k in SUMMARY_KINDS]))
    rows = (groups.where(F.col("load_date") > F.lit(since)).withColumn("kind", F.explode(marks)))
    own = [F.when(F.col("kind").isin([k for k in SUMMARY_KINDS if c in keys[k]]), F.col(c)).alias(c) for c in GROUP_KEYS]
    flat = rows.select("kind", *own, *[F.when(F.col("kind") == "side", F.col(c)).alias(c) for c in ("qty", "pnl")])
    one = _grouped(flat, ["kind", *GROUP_KEYS], F.sum("qty").alias("qty"), F.sum("pnl").alias("pnl"))
    spark = groups.sparkSession
    path = scratch_path(spark, "fill_summary")
    one.write.partitionBy("kind").parquet(path)
    table = spark.read.schema(one.schema).parquet(path)
    return {k: table.where(F.col("kind") == k).select(*[c for c in GROUP_KEYS if c in keys[k]],
                                                      *(("qty", "pnl") if k == "side" else ())) for k in SUMMARY_KINDS}


def day_trade_feed(fills: DataFrame, dims: FillDims, rules: FillRules, since: dt.date,
                   limit: float = DAY_TRADE_QTY_LIMIT) -> DataFrame:
    return group_feed(fill_groups(fills, rules), dims, rules, since, limit)


def group_feed(groups: DataFrame, dims: FillDims, rules: FillRules, since: dt.date,
               limit: float = DAY_TRADE_QTY_LIMIT) -> DataFrame:
    """Same result as ``day_trade_breaks(day_trade_rows(...))`` with the zero
    rows made per mapped desk instead of per account: zero rows only add
    presence, and the account -> desk mapping does not depend on the day."""
    parts = group_summary(groups, rules, since)
    sides, commodities = parts["side"], commodity_groups(dims, rules)
    matched = active_accounts(day_trade_pnl(day_trade_match(sides)), sides, rules, since)
    m = account_location(attach_group(matched, commodities), dims, rules).select(
        "trade_date", F.col("map_subdivision").alias("subdivision"),
        F.col("map_location").alias("location"), F.col("commgrp").alias("commodity"),
        "day_trade_qty", "day_trade_pnl")
    keys = parts["account"].join(buying_accounts(sides), norm("account") == F.col("_buyer"), "left_semi")
    desks = (account_location(attach_group(keys, commodities), dims, rules)
             .select(F.col("map_subdivision").alias("subdivision"),
                     F.col("map_location").alias("location"),
                     F.col("commgrp").alias("commodity"))
             .distinct())
    zeros = date_spine(desks, parts["day"], since).select(
        "trade_date", "subdivision", "location", "commodity", _zero("day_trade_qty"), _zero("day_trade_pnl"))
    return day_trade_breaks(m.unionByName(zeros), rules, limit)
