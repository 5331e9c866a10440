"""Incremental runs: each micro-batch replaces the feed days it touches."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from oracle_harness import SF_SMALL
from tradewatch.plans.inputs import load_inputs
from tradewatch.plans.surveillance import daily_feed
from tradewatch.schemas import POSITIONS_SCHEMA
from tradewatch.session import scratch_path
from tradewatch.streaming import start


def test_stream_matches_batch_rerun(spark):
    base = load_inputs(spark, SF_SMALL)
    landing = scratch_path(spark, "landing")
    cut = dt.date(1998, 1, 1)
    pos = base.positions
    # day 1: history up to the cut lands; day 2: the rest lands
    pos.where(F.col("loaddate") < F.lit(cut)).write.parquet(landing + "/part=1")
    table_path = scratch_path(spark, "feedtbl")
    table = "tw_stream_" + table_path.rsplit("-", 1)[-1]
    ckpt = scratch_path(spark, "stream-ckpt")

    def inputs():
        landed = spark.read.schema(POSITIONS_SCHEMA).parquet(landing)
        return base.with_positions(landed)

    q = start(spark, landing, inputs, table, ckpt, path=table_path, available_now=True)
    q.awaitTermination()
    first = spark.table(table)
    assert first.count() > 0
    pos.where(F.col("loaddate") >= F.lit(cut)).write.parquet(landing + "/part=2")
    q = start(spark, landing, inputs, table, ckpt, path=table_path, available_now=True)
    q.awaitTermination()

    # the two batches give what one run over everything gives
    cols = ["loaddate", "subdivision", "trader", "poscommodity", "dailyValue", "breaks", "test"]
    got = sorted(map(tuple, spark.table(table).select(*cols).collect()), key=str)
    want = sorted(map(tuple, daily_feed(base).select(*cols).collect()), key=str)
    assert got == want


def test_failed_batch_is_replayed_without_duplicates(spark):
    from pyspark.errors import StreamingQueryException

    from tradewatch.streaming import daily

    base = load_inputs(spark, SF_SMALL)
    landing = scratch_path(spark, "landing-retry")
    base.positions.write.parquet(landing + "/part=1")
    table_path = scratch_path(spark, "feed-retry")
    table = "tw_retry_" + table_path.rsplit("-", 1)[-1]
    ckpt = scratch_path(spark, "ckpt-retry")

    def inputs():
        return base.with_positions(spark.read.schema(POSITIONS_SCHEMA).parquet(landing))

    real = daily.replace_days
    calls = []

    def flaky(spark_, feed, table_, *more):
        real(spark_, feed, table_, *more)         # the write lands ...
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("executor lost")   # ... but the batch is not committed

    daily.replace_days = flaky
    try:
        q = start(spark, landing, inputs, table, ckpt, path=table_path, available_now=True)
        with pytest.raises(StreamingQueryException):
            q.awaitTermination()
        q = start(spark, landing, inputs, table, ckpt, path=table_path, available_now=True)
        q.awaitTermination()
    finally:
        daily.replace_days = real
    assert len(calls) == 3                        # feed; the batch again: feed, net volume
    assert spark.table(table).count() == daily_feed(base).count()


def test_versioned_stream_replays_and_resumes(spark):
    from pyspark.errors import StreamingQueryException

    from tradewatch.operators.highs import SERIES
    from tradewatch.plans.surveillance import net_volume
    from tradewatch.schemas import FEED_SCHEMA
    from tradewatch.sources.versioned import DayTable
    from tradewatch.streaming import versioned_handler

    base = load_inputs(spark, SF_SMALL)
    landing, ckpt = scratch_path(spark, "landing-v"), scratch_path(spark, "ckpt-v")
    cut = F.lit(dt.date(1998, 1, 1))
    feed = DayTable(spark, scratch_path(spark, "feed-v"), FEED_SCHEMA)
    net = DayTable(spark, scratch_path(spark, "net-v"), net_volume(base).schema, keys=("loaddate", *SERIES))
    handle = versioned_handler(spark, lambda: base.with_positions(spark.read.schema(POSITIONS_SCHEMA).parquet(landing)), feed, net)
    calls = []

    def flaky(batch, epoch):
        handle(batch, epoch)
        calls.append(epoch)
        if len(calls) == 2:
            raise RuntimeError("driver lost after both commits")

    def run():
        start(spark, landing, None, "", ckpt, available_now=True, handler=flaky).awaitTermination()

    base.positions.where(F.col("loaddate") < cut).write.parquet(landing + "/part=1")
    run()
    base.positions.where(F.col("loaddate") >= cut).write.parquet(landing + "/part=2")
    with pytest.raises(StreamingQueryException):
        run()
    run()
    assert calls == [0, 1, 1] and feed.versions() == net.versions() == [1, 2]     # the replay commits nothing
    cols = FEED_SCHEMA.fieldNames()
    got = sorted(map(tuple, feed.read().select(*cols).collect()), key=str)
    assert got == sorted(map(tuple, daily_feed(base).select(*cols).collect()), key=str) and len(got) > 0
