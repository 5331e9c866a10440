"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the whole driver tables of `sf_dir` through
``load_inputs``; none samples, caps or filters rows to stay cheap.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.functions import beyond_horizon, month_start
from tradewatch.operators import daytrades as D
from tradewatch.operators import highs as H
from tradewatch.operators import positions as P
from tradewatch.operators import rules as RU
from tradewatch.operators.series import in_order
from tradewatch.operators.tenor import tenor_breaks
from tradewatch.operators import feed as FD
from tradewatch.params import DATED_RULES, overlapping_rules, testdata_rules
from tradewatch.plans import surveillance as S
from tradewatch.plans.inputs import Inputs, load_inputs, source_inputs
from tradewatch.schemas import AUDIT_SCHEMA, FEED_SCHEMA, POSITIONS_SCHEMA
from tradewatch.session import scratch_path, shared_dir
from tradewatch.sources.delimited import load_delimited
from tradewatch.sources.fill_view import FillView
from tradewatch.sources.versioned import DayTable
from tradewatch.streaming import highs as highs_stream

Query = Callable[[SparkSession, str], DataFrame]


def _tenor_rows(i: Inputs) -> DataFrame:
    r = i.rules
    return P.tenor_rows(i.positions, i.position_dims, r.positions, r.since,
                        r.tenor_horizon_months)


def _high_rows(i: Inputs) -> DataFrame:
    r = i.rules
    return P.high_rows(i.positions, i.position_dims, r.positions, r.high_since)


SCOPED_COLUMNS = ["scope", "loaddate", "commodity", "delta", "source", "location",
                  "subdivision", "division", "sub_location", "side", "trader_raw",
                  "contract_month", "contract_number", "position_type", "desk"]


def q_scoped_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = load_inputs(spark, sf_dir)
    r = i.rules
    tenor = P.scoped_positions(i.positions, i.position_dims, r.positions.tenor_scopes,
                               r.since, r.positions.desk_sources)
    high = P.scoped_positions(i.positions, i.position_dims, r.positions.high_scopes,
                              r.high_since, r.positions.desk_sources)
    return (tenor.select(F.lit("tenor").alias("test"), *SCOPED_COLUMNS)
            .unionByName(high.select(F.lit("high").alias("test"), *SCOPED_COLUMNS)))


def q_scoped_positions_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoped positions of the tenor test, read from landed extracts (two deliveries, one of them corrected) as
    production inputs; files before the since-date are not read."""
    i = load_inputs(spark, sf_dir)
    r = i.rules
    path = scratch_path(spark, "landed")
    landed = DayTable(spark, f"{path}/positions", POSITIONS_SCHEMA, keys=("loaddate",))
    early = F.col("loaddate") <= F.lit(RERUN_SINCE)
    landed.append(i.positions.where(early), "first")
    landed.append(i.positions.where(~early).withColumn("delta", F.lit(0.0)), "second")
    landed.replace(i.positions.where(~early), "second corrected")
    dims = {}
    for name, table in vars(i.position_dims).items():
        table.write.parquet(f"{path}/{name}")
        dims[f"position_dims.{name}"] = f"{path}/{name}"
    s = source_inputs(spark, {"positions": landed, **dims}, r)
    rows = P.scoped_positions(s.positions, s.position_dims, r.positions.tenor_scopes, r.since, r.positions.desk_sources)
    return rows.select(*SCOPED_COLUMNS)


EXCLUDED_COLUMNS = ["scope", "loaddate", "commodity", "desk", "subdivision", "side",
                    "delta", "sub_location", "contract_number"]


def q_exclusion_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = load_inputs(spark, sf_dir)
    return (_tenor_rows(i).select(F.lit("tenor").alias("test"), *EXCLUDED_COLUMNS)
            .unionByName(_high_rows(i).select(F.lit("high").alias("test"), *EXCLUDED_COLUMNS)))


def _dated(i: Inputs) -> DataFrame:
    blank = dict.fromkeys(RU.RULE_SCHEMA.fieldNames())
    rows = [Row(**{**blank, "test": test, "valid_from": a and dt.date.fromisoformat(a), "valid_to": b and dt.date.fromisoformat(b), **parts})
            for test, a, b, parts in DATED_RULES]
    return RU.rule_rows(i.spark, i.rules.positions).union(i.spark.createDataFrame(rows, RU.RULE_SCHEMA))


def q_rule_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of both tests, of overlapping scopes, left by the rules as a dated table with nine more rows."""
    i = load_inputs(spark, sf_dir, overlapping_rules())
    r, rules = i.rules, _dated(i)
    days = i.position_dims.workdays

    def left(test: str, scopes, since: dt.date) -> DataFrame:
        rows = P.scoped_positions(i.positions, i.position_dims, scopes, since, r.positions.desk_sources)
        return RU.exclude_by_rules(rows, rules, test, days).select(F.lit(test).alias("test"), *EXCLUDED_COLUMNS)

    return (left("tenor", r.positions.tenor_scopes, r.since)
            .unionByName(left("high", r.positions.high_scopes, r.high_since)))


def q_net_side_volume_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net volume where rows belong to two scopes: the scopes' side volumes are averaged, not added."""
    return _net(load_inputs(spark, sf_dir, overlapping_rules()))


def q_desk_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Desk of every position row, counted per distinct input combination."""
    i = load_inputs(spark, sf_dir)
    rows = P.attach_dims(i.positions, i.position_dims)
    desk = P.resolve_desk("source", "trader_raw", "location", i.rules.positions.desk_sources)
    return (rows.groupBy("source", "trader_raw", "location", desk.alias("desk"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


def q_tenor_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beyond-horizon flag of every position row, counted per month pair."""
    i = load_inputs(spark, sf_dir)
    flag = beyond_horizon("loaddate", "contract_month", i.rules.tenor_horizon_months)
    return (i.positions.groupBy(month_start("loaddate").alias("load_month"),
                                month_start("contract_month").alias("contract_month"),
                                flag.alias("beyond_twelve_months"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


def q_tenor_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.tenor_exposure(_tenor_rows(load_inputs(spark, sf_dir)))


def q_tenor_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = load_inputs(spark, sf_dir)
    return tenor_breaks(_tenor_rows(i), i.rules.tenor_share_limit)


def _net(i: Inputs) -> DataFrame:
    return H.net_volume(_high_rows(i), [s.name for s in i.rules.positions.high_scopes])


def q_side_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.side_volume(_high_rows(load_inputs(spark, sf_dir)))


def q_net_side_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _net(load_inputs(spark, sf_dir))


def q_new_high_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = load_inputs(spark, sf_dir)
    return H.new_high_breaks(_net(i), i.rules.new_high_window, i.rules.series_chunk_rows)


def q_new_high_breaks_20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same test with a 20-row window: fills at every scale, hits plateaus."""
    i = load_inputs(spark, sf_dir)
    return H.new_high_breaks(_net(i), 20, i.rules.series_chunk_rows)


def q_break_running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = load_inputs(spark, sf_dir)
    r = i.rules
    return H.new_high_running_count(_net(i), r.new_high_window, r.series_chunk_rows).select(
        "loaddate", "subdivision", "trader", "poscommodity", "dailyValue", "maxValue",
        "prevDailyVal", "breaks", "count_breaks")


#: Load days up to which the net volume lands before the rest, as two deliveries.
STREAM_CUT = dt.date(1997, 1, 1)


def q_new_high_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The new-high test as a stateful stream over two deliveries of net volume, resumed from its checkpoint
    between them."""
    path = scratch_path(spark, "high_stream")
    table = highs_stream.flags_table(spark, f"{path}/flags")
    net = _net(load_inputs(spark, sf_dir)).select(*highs_stream.NET_SCHEMA.fieldNames())
    net.write.parquet(f"{path}/net")
    net = spark.read.schema(highs_stream.NET_SCHEMA).parquet(f"{path}/net")
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, highs_stream.PROVIDER)
    try:
        for part in (F.col("loaddate") <= F.lit(STREAM_CUT), F.col("loaddate") > F.lit(STREAM_CUT)):
            net.where(part).write.mode("append").parquet(f"{path}/landing")
            highs_stream.start(spark, f"{path}/landing", table, f"{path}/checkpoint", available_now=True).awaitTermination()
    finally:
        spark.conf.set(key, before)
    return highs_stream.breaks(table)


def q_series_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every net-volume row's place in the order of all series."""
    return in_order(_net(load_inputs(spark, sf_dir))).select(
        "poscommodity", "trader", "loaddate", "subdivision", "dailyValue", F.col("_g").alias("place"))


def q_band_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = load_inputs(spark, sf_dir)
    r = i.rules
    return H.band_breaks(_net(i), r.band_window, r.band_k, chunk_rows=r.series_chunk_rows).select(
        "loaddate", "subdivision", "trader", "poscommodity", "dailyValue", "moving_avg",
        "moving_std", "upper_bound", "breaks", "test")


def _sides(i: Inputs) -> DataFrame:
    return D.group_sides(i.fill_groups, i.rules.since)


def _doubles(df: DataFrame) -> DataFrame:
    """Decimal measures as doubles, as the original's frames held them."""
    return df.withColumns({f.name: F.col(f.name).cast("double") for f in df.schema
                           if f.dataType.typeName() == "decimal"})


def q_fill_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(_sides(load_inputs(spark, sf_dir)))


def q_day_trade_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(D.day_trade_match(_sides(load_inputs(spark, sf_dir))))


def q_day_trade_pnl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(D.day_trade_pnl(D.day_trade_match(_sides(load_inputs(spark, sf_dir)))))


def q_account_date_skeleton(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = load_inputs(spark, sf_dir)
    return _doubles(D.group_skeleton(i.fill_groups, i.rules.fills, i.rules.since))


def q_active_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = load_inputs(spark, sf_dir)
    r = i.rules
    sides = _sides(i)
    rows = (D.day_trade_pnl(D.day_trade_match(sides)).select(*D.ROW_COLUMNS)
            .unionByName(D.group_skeleton(i.fill_groups, r.fills, r.since)))
    return _doubles(D.active_accounts(rows, sides, r.fills, r.since))


def q_commodity_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = load_inputs(spark, sf_dir)
    return D.commodity_groups(i.fill_dims, i.rules.fills)


def q_account_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = load_inputs(spark, sf_dir)
    return _doubles(D.group_rows(i.fill_groups, i.fill_dims, i.rules.fills, i.rules.since))


def q_day_trade_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = load_inputs(spark, sf_dir)
    r = i.rules
    return D.group_feed(i.fill_groups, i.fill_dims, r.fills, r.since, r.day_trade_limit)


def q_fill_view_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day-trade test from a view that was built over the fills' first days and brought up to date by the rest,
    with a day delivered twice."""
    i = load_inputs(spark, sf_dir)
    r = i.rules
    view = FillView(spark, scratch_path(spark, "fill_view"), r.fills)
    days = [d["load_date"] for d in i.fills.select("load_date").distinct().orderBy("load_date").collect()]
    early, late = days[:len(days) * 3 // 4], days[len(days) * 3 // 4:]
    view.build(i.fills.where(F.col("load_date").isin(early)), "history")
    view.refresh(i.fills, late + early[-1:], "arrival")
    return D.group_feed(view.groups(r.since), i.fill_dims, r.fills, r.since, r.day_trade_limit)


def q_combined_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.daily_feed(load_inputs(spark, sf_dir))


#: The rerun query rebuilds the feed from this day on.
RERUN_SINCE = dt.date(1997, 6, 1)


#: End of the feed that stops before the last day.
UNTIL = dt.date(1997, 12, 31)


def q_combined_until(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed up to an end date."""
    return S.daily_feed(load_inputs(spark, sf_dir, testdata_rules().with_(until=UNTIL)))


def q_feed_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed after a later day, rebuilt from the written net volume of the full run."""
    i = load_inputs(spark, sf_dir)
    path = scratch_path(spark, "net")
    S.net_volume(i).write.parquet(path)
    return S.rerun_feed(i, RERUN_SINCE, spark.read.parquet(path))


def q_feed_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append the feed to a fresh table under the shared folder (created from
    the feed's types because it is absent) and read the table back."""
    feed = S.daily_feed(load_inputs(spark, sf_dir))
    path = scratch_path(spark, "feed")
    table = "tw_feed_" + path.rsplit("-", 1)[-1]
    FD.append_feed(spark, feed, table, convert=True, path=path)
    return spark.table(table)


def _existing(spark: SparkSession, name: str, schema: T.StructType) -> str:
    path = scratch_path(spark, name)
    table = f"tw_{name}_" + path.rsplit("-", 1)[-1]
    spark.catalog.createTable(table, source="parquet", schema=schema, path=path)
    return table


#: A target table of other names, a bounded string and a wider integer.
CAST_TARGET = T.StructType([
    T.StructField("day", T.DateType()), T.StructField("area", T.VarcharType(6)), T.StructField("desk", T.StringType()),
    T.StructField("commodity", T.StringType()), T.StructField("value", T.DoubleType()),
    T.StructField("broken", T.LongType()), T.StructField("kind", T.VarcharType(5))])


def q_feed_append_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append the feed to an existing table, cast by position to its types."""
    table = _existing(spark, "feed_cast", CAST_TARGET)
    FD.append_feed(spark, S.daily_feed(load_inputs(spark, sf_dir)), table, convert=True)
    return spark.table(table)


def q_feed_append_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append the feed twice to an existing table as it is: two runs add the days twice."""
    feed = S.daily_feed(load_inputs(spark, sf_dir))
    table = _existing(spark, "feed_strict", feed.schema)
    shared_dir(spark)
    feed = feed.checkpoint(eager=True)          # computed once for both
    FD.append_feed(spark, feed, table, convert=False)
    FD.append_feed(spark, feed, table, convert=False)
    return spark.table(table)


def q_feed_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed in a versioned table, replaced by a rerun over the same days, which is then retried: every test and
    day is there once."""
    feed = S.daily_feed(load_inputs(spark, sf_dir))
    table = DayTable(spark, scratch_path(spark, "replace"), FEED_SCHEMA)
    table.replace(feed, "first run")
    table.replace(table.read(), "second run")
    table.replace(feed, "second run")           # committed before: computes nothing
    return table.read()


def q_feed_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A versioned feed whose later days a run replaced by nothing: the version before still has all rows."""
    table = DayTable(spark, scratch_path(spark, "rollback"), FEED_SCHEMA)
    table.append(S.daily_feed(load_inputs(spark, sf_dir)), "first run")
    table.replace(table.read().limit(0), "bad run", since=RERUN_SINCE)
    return (table.read(1).select(*FEED_SCHEMA.fieldNames(), F.lit(1).alias("version"))
            .union(table.read().select(*FEED_SCHEMA.fieldNames(), F.lit(2).alias("version"))))


def q_delimited_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage the feed as '~'-separated files and read it back typed."""
    feed = S.daily_feed(load_inputs(spark, sf_dir))
    path = scratch_path(spark, "stage")
    FD.stage_delimited(feed, path)
    return FD.read_delimited(spark, path, FEED_SCHEMA)


def _damaged_stage(spark: SparkSession, sf_dir: str):
    """The staged feed with a short, a long and a mistyped line beside each break, loaded back."""
    path = scratch_path(spark, "damaged")
    FD.stage_delimited(S.daily_feed(load_inputs(spark, sf_dir)), path)
    broken = FD.read_delimited(spark, path).where("breaks = 1")
    lines = F.array(F.concat_ws("~", "loaddate", "subdivision", "trader"),
                    F.concat_ws("~", "loaddate", "subdivision", "trader", "poscommodity", F.lit("1.5"), "breaks", "test", F.lit("more")),
                    F.concat_ws("~", "loaddate", "subdivision", "trader", "poscommodity", F.lit("much"), "breaks", "test"))
    broken.select(F.explode(lines)).write.mode("append").text(path)
    return load_delimited(spark, path, FEED_SCHEMA)


def q_delimited_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a damaged staging folder that fit the feed."""
    return _damaged_stage(spark, sf_dir).rows


def q_delimited_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a damaged staging folder that don't, with the reason."""
    return _damaged_stage(spark, sf_dir).rejects.drop("file")


def q_run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows of a run (user and time columns left out: they vary)."""
    audit = FD.run_audit(S.daily_feed(load_inputs(spark, sf_dir)))
    return audit.drop("run_user", "run_ts")


def q_audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit table after a run that wrote its feed, the same run retried (nothing written), and a run whose
    target doesn't fit (user and time columns left out: they vary)."""
    i = load_inputs(spark, sf_dir)
    audit = _existing(spark, "audit", AUDIT_SCHEMA)
    feed = DayTable(spark, scratch_path(spark, "audited"), FEED_SCHEMA)
    S.run(spark, i, feed, audit, run_id="monday")
    S.run(spark, i, feed, audit, run_id="monday")
    narrow = _existing(spark, "narrow", T.StructType([T.StructField("it's", T.DateType()), T.StructField("value", T.DoubleType())]))
    try:
        S.run(spark, i, narrow, audit)
    except ValueError:
        pass                                    # audited and raised again
    return spark.table(audit).drop("run_user", "run_ts")


def registry() -> dict[str, Query]:
    return {
        "scoped_positions": q_scoped_positions,
        "scoped_positions_landed": q_scoped_positions_landed,
        "exclusion_rules": q_exclusion_rules,
        "rule_table": q_rule_table,
        "net_side_volume_overlap": q_net_side_volume_overlap,
        "desk_resolution": q_desk_resolution,
        "tenor_flag": q_tenor_flag,
        "tenor_exposure": q_tenor_exposure,
        "tenor_breaks": q_tenor_breaks,
        "side_volume": q_side_volume,
        "net_side_volume": q_net_side_volume,
        "new_high_breaks": q_new_high_breaks,
        "new_high_breaks_20": q_new_high_breaks_20,
        "new_high_stream": q_new_high_stream,
        "series_order": q_series_order,
        "break_running_count": q_break_running_count,
        "band_breaks": q_band_breaks,
        "fill_sides": q_fill_sides,
        "day_trade_match": q_day_trade_match,
        "day_trade_pnl": q_day_trade_pnl,
        "account_date_skeleton": q_account_date_skeleton,
        "active_accounts": q_active_accounts,
        "commodity_groups": q_commodity_groups,
        "account_location": q_account_location,
        "day_trade_breaks": q_day_trade_breaks,
        "fill_view_refresh": q_fill_view_refresh,
        "combined_breaks": q_combined_breaks,
        "combined_until": q_combined_until,
        "feed_append": q_feed_append,
        "feed_append_cast": q_feed_append_cast,
        "feed_append_strict": q_feed_append_strict,
        "feed_replace": q_feed_replace,
        "feed_rollback": q_feed_rollback,
        "feed_rerun": q_feed_rerun,
        "delimited_stage": q_delimited_stage,
        "delimited_good": q_delimited_good,
        "delimited_rejects": q_delimited_rejects,
        "run_audit": q_run_audit,
        "audit_log": q_audit_log,
    }
