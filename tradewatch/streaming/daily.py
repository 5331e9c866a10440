"""Incremental daily runs with Structured Streaming.

The batch job recomputes every test from a since-date and appends the
result. Run continuously, the same job becomes: watch the folder where the
position fact lands (file source, new files only), and for each micro-batch

1. take the earliest load date among the newly landed rows (one scalar),
2. rerun the three tests for the days from it on; the new-high test takes the
   rows before it from a table of daily net volume that the job keeps, by row
   count, so the result equals a full run's,
3. replace the feed's and the net volume's partitions of these days (dynamic
   partition overwrite).

Step 3 makes a retried micro-batch harmless: it rewrites the same days with
the same rows, so the feed holds each day once (no duplicate appends). The
feed is written before the net volume: a retry reads what the first try read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradewatch.operators.feed import replace_days
from tradewatch.plans.inputs import Inputs
from tradewatch.plans.surveillance import daily_feed, net_volume, rerun_feed
from tradewatch.schemas import POSITIONS_SCHEMA
from tradewatch.session import shared_dir
from tradewatch.sources.versioned import DayTable

def _first_day(batch: DataFrame) -> dt.date | None:
    return batch.agg(F.min("loaddate")).first()[0]


def batch_handler(spark: SparkSession, inputs: Callable[[], Inputs], table: str,
                  path: str | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: rerun the tests from the batch's first day; the
    net volume is kept in `table` + "_net" (below `path` + "_net")."""
    net_table, net_path = f"{table}_net", f"{path}_net" if path else None

    def handle(batch: DataFrame, epoch_id: int) -> None:
        first = _first_day(batch)
        if first is None:
            return
        known = spark.catalog.tableExists(net_table)
        back, since, feed, fresh = _rerun(inputs(), first, spark.table(net_table) if known else None)
        replace_days(spark, feed, table, path, since)
        replace_days(spark, fresh, net_table, net_path, back, ["loaddate"])

    return handle


def _rerun(i: Inputs, first: dt.date, net: DataFrame | None):
    """(day before the net volume's first, day before the feed's first, feed, net volume) after `first` has landed."""
    r, back = i.rules, first - dt.timedelta(days=1)
    if back < r.high_since or net is None:
        back = r.high_since                     # all days that any test reads
    fresh = net_volume(i.with_rules(r.with_(since=back, lookback_days=0))).checkpoint(eager=True)
    if back < r.since:
        return back, r.since, daily_feed(i), fresh
    return back, back, rerun_feed(i, back, net), fresh


def versioned_handler(spark: SparkSession, inputs: Callable[[], Inputs], feed_table: DayTable,
                      net_table: DayTable, query: str = "daily") -> Callable[[DataFrame, int], None]:
    """The same over versioned tables. A micro-batch's number is its run id: a batch that is replayed after its
    commit writes nothing, and one that failed between the two tables goes on with the second, from the net volume
    that the feed's own commit was made with."""
    def handle(batch: DataFrame, epoch_id: int) -> None:
        run = f"{query}-{epoch_id}"
        if run in net_table.commit().runs:
            return
        first = _first_day(batch)
        if first is None:
            return
        known = net_table.versions()
        back, since, feed, fresh = _rerun(inputs(), first, net_table.read() if known else None)
        feed_table.replace(feed, run, since=since)
        net_table.replace(fresh, run, since=back)

    return handle


def start(spark: SparkSession, landing: str, inputs: Callable[[], Inputs], table: str,
          checkpoint: str, path: str | None = None, available_now: bool = False,
          max_files: int | None = None, handler: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Watch `landing` (parquet files of the position fact) and keep `table`
    current, or what `handler` keeps (``versioned_handler``). `inputs()` must read the position fact
    from `landing` as a table (all days), plus the other inputs."""
    shared_dir(spark)
    reader = spark.readStream.schema(POSITIONS_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    w = (reader.parquet(landing).select("loaddate").writeStream
         .option("checkpointLocation", checkpoint)
         .foreachBatch(handler or batch_handler(spark, inputs, table, path)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
