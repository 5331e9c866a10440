"""The daily surveillance run: three lazy test plans, one feed, one write.

Each test is an independent lazy plan; nothing runs until the feed is
written, so Spark schedules the three branches in one job graph and an
error in one test no longer hides the others' plans.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewatch.operators import daytrades as D
from tradewatch.operators import feed as FD
from tradewatch.operators import highs as H
from tradewatch.operators import positions as P
from tradewatch.operators.tenor import tenor_breaks
from tradewatch.plans.inputs import Inputs
from tradewatch.session import shared_dir
from tradewatch.sources.versioned import DayTable


def tenor_test(i: Inputs) -> DataFrame:
    r = i.rules
    rows = P.tenor_rows(i.positions, i.position_dims, r.positions, r.since,
                        r.tenor_horizon_months)
    return tenor_breaks(rows, r.tenor_share_limit)


def day_trade_test(i: Inputs) -> DataFrame:
    r = i.rules
    return D.group_feed(i.fill_groups, i.fill_dims, r.fills, r.since, r.day_trade_limit)


def net_volume(i: Inputs) -> DataFrame:
    r = i.rules
    rows = P.high_rows(i.positions, i.position_dims, r.positions, r.high_since)
    return H.net_volume(rows, [s.name for s in r.positions.high_scopes])


def new_high_test(i: Inputs) -> DataFrame:
    return H.new_high_breaks(net_volume(i), i.rules.new_high_window, i.rules.series_chunk_rows)


def rerun_net_volume(i: Inputs, since: dt.date, history: DataFrame) -> DataFrame:
    """Net volume after `since` from the positions, before it each series' last
    ``window - 1`` rows of `history` (net volume written by an earlier run).

    By rows, not days: a window of 252 rows may reach back years."""
    r = i.rules
    fresh = net_volume(i.with_rules(r.with_(since=since, lookback_days=0)))
    back = F.row_number().over(Window.partitionBy(*H.SERIES).orderBy(*[F.desc(c) for c in H.ORDER]))
    last = (history.where(F.col("loaddate") <= F.lit(since)).select(*fresh.columns)
            .withColumn("_back", back).where(F.col("_back") < max(r.new_high_window, 2)).drop("_back"))
    return last.unionByName(fresh)


def rerun_feed(i: Inputs, since: dt.date, history: DataFrame) -> DataFrame:
    """The feed's rows after `since`, equal to the full run's.

    Exposure after `since` needs no earlier day. New highs take their look-back
    from `history`. The day-trade test is computed over the full run's days and
    cut, because which accounts are active depends on all of them."""
    later = i.with_rules(i.rules.with_(since=since))
    highs = H.new_high_breaks(rerun_net_volume(i, since, history), i.rules.new_high_window,
                              i.rules.series_chunk_rows)
    return FD.combined_breaks([tenor_test(later), day_trade_test(i), highs], since, i.rules.until)


def daily_feed(i: Inputs) -> DataFrame:
    return FD.combined_breaks([tenor_test(i), day_trade_test(i), new_high_test(i)], i.rules.since,
                              i.rules.until)


def run(spark: SparkSession, i: Inputs, feed_table: str | DayTable, audit_table: str | None = None,
        feed_path: str | None = None, audit_path: str | None = None,
        replace: bool = False, run_id: str | None = None) -> DataFrame:
    """Write the day's feed and its audit rows; on failure write one failed
    audit row and re-raise. Returns the audit rows.

    The three plans are computed once, by the write; the audit's figures are
    observed on the rows as they are written.

    replace=False appends (a rerun adds the days again, as the original job
    did); replace=True replaces the days it recomputes. With a versioned table
    (``DayTable``) all days after the rules' since-date are replaced in one commit, and a
    `run_id` that has been committed writes nothing.
    """
    shared_dir(spark)
    step = "Building feed"
    audit = FD.WriteAudit()
    if isinstance(feed_table, DayTable) and run_id in feed_table.commit().runs:
        return audit.rows(spark)
    try:
        feed = daily_feed(i)
        step = "Writing feed"
        if isinstance(feed_table, DayTable):
            name = run_id or uuid.uuid4().hex
            if replace:
                feed_table.replace(feed, name, since=i.rules.since, watch=audit.watch)
            else:
                feed_table.append(feed, name, watch=audit.watch)
        elif replace:
            FD.replace_days(spark, feed, feed_table, path=feed_path, audit=audit)
        else:
            FD.append_feed(spark, feed, feed_table, convert=True, path=feed_path, audit=audit)
        step = FD.STEP_DONE
        rows = audit.rows(spark)
        if audit_table:
            FD.append_feed(spark, rows, audit_table, path=audit_path)
        return rows
    except Exception as e:  # noqa: BLE001 - audited, then re-raised
        if audit_table:
            FD.append_feed(spark, FD.audit_failure(spark, e, step=step), audit_table,
                           path=audit_path)
        raise
