"""The new-high test as a stateful stream: each series carries its last rows, none is read again.

A series' state is a ring buffer of the last ``window - 1`` values, the newest last, and the place (date,
subdivision) of the newest. A row is flagged from the buffer and the rows before it in the batch, as the batch test
flags it (``highs.new_high_flags``). Series are dealt by hash to GROUPS groups, and a call takes a group's rows of a
micro-batch together: there may be as many series as rows, and a call costs more than a series. A group's state is a
map of its series, of which only those with rows are read. A checkpoint belongs to the number of groups.

Late rows. A row at or before its series' newest place can't be put in order any more: it is given out with
``late`` set and no flag, and changes no state. So are rows that repeat a place. Rows of one micro-batch may
come in any order. The batch rerun (``streaming.daily``) is the way to take late rows in.

State is checkpointed by Spark (RocksDB); results are appended to a versioned table with the micro-batch's
number as run id, so a replayed batch adds nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tradewatch.operators.series import ORDER, SERIES
from tradewatch.params import NEW_HIGH_WINDOW, TEST_NEW_HIGH
from tradewatch.schemas import FEED_COLUMNS
from tradewatch.session import scratch_path, ship_code
from tradewatch.sources.versioned import DayTable

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

NET_SCHEMA = T.StructType([
    T.StructField("loaddate", T.DateType()), T.StructField("poscommodity", T.StringType()),
    T.StructField("trader", T.StringType()), T.StructField("subdivision", T.StringType()),
    T.StructField("dailyValue", T.DoubleType())])
FLAGS_SCHEMA = T.StructType([
    T.StructField("loaddate", T.DateType()), T.StructField("subdivision", T.StringType()),
    T.StructField("trader", T.StringType()), T.StructField("poscommodity", T.StringType()),
    T.StructField("dailyValue", T.DoubleType()), T.StructField("maxValue", T.DoubleType()),
    T.StructField("prevDailyVal", T.DoubleType()), T.StructField("breaks", T.IntegerType()),
    T.StructField("late", T.BooleanType())])
STATE_SCHEMA = "values array<double>, day date, subdivision string"
SERIES_SCHEMA = "poscommodity string, trader string"
#: Groups that series are dealt to. Fixed: keys of the state in every checkpoint.
GROUPS = 1024


def trailing_max(values: np.ndarray, window: int) -> np.ndarray:
    """The maximum of each full frame of `window` values (len(values) - window + 1 of them), from running maxima of
    aligned blocks, forwards and backwards."""
    n = len(values)
    padded = np.concatenate((values, np.full(-n % window, -np.inf))).reshape(-1, window)
    fore = np.maximum.accumulate(padded, axis=1).ravel()
    back = np.maximum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.maximum(back[:n - window + 1], fore[window - 1:n])


class NewHighs(StatefulProcessor):
    def __init__(self, window: int):
        self.window = window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buffers = handle.getMapState("buffers", SERIES_SCHEMA, STATE_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # The rows of a group's series of one micro-batch: a row for each day and subdivision that has arrived.
        batch = pd.concat(list(rows), ignore_index=True)
        index, names = pd.MultiIndex.from_frame(batch[SERIES]).factorize()
        held = [self.buffers.getValue(name) or ([], None, None) for name in names]
        # Places as numbers; subdivisions by their rank, those of the held places too (-1: none held).
        day = batch["loaddate"].to_numpy("datetime64[D]").astype(np.int64)
        names_of = np.array(sorted({*batch["subdivision"], *(h[2] for h in held if h[1] is not None)}), object)
        part = np.searchsorted(names_of, batch["subdivision"].to_numpy(object))
        order = np.lexsort((part, day, index))
        batch, index, day, part = batch.iloc[order], index[order], day[order], part[order]
        first = np.diff(index, prepend=-1) != 0
        # Within the batch only an equal place is late; before it, all up to the newest.
        late = ~first & (np.diff(day, prepend=0) == 0) & (np.diff(part, prepend=0) == 0)
        known = np.array([h[1] is not None for h in held], bool)
        old_day = np.array([h[1] or 0 for h in held], "datetime64[D]").astype(np.int64)[index]
        old_part = np.array([np.searchsorted(names_of, h[2]) if h[1] is not None else -1 for h in held])[index]
        late |= known[index] & ((day < old_day) | ((day == old_day) & (part <= old_part)))
        fresh, index = batch[~late], index[~late]
        if len(fresh):
            # Series one after the other, each with its held values before its rows.
            at = np.searchsorted(index, np.arange(len(names) + 1))
            new = fresh["dailyValue"].to_numpy(np.float64)
            parts = [np.concatenate((np.array(h[0], np.float64), new[a:b])) for h, a, b in zip(held, at, at[1:])]
            lengths = np.array([len(x) for x in parts])
            starts = np.cumsum(lengths) - lengths
            joined = np.concatenate(parts)
            place = np.arange(len(joined)) - np.repeat(starts, lengths)
            top = np.full(len(joined), np.nan)
            if len(joined) >= self.window:
                top[self.window - 1:] = trailing_max(joined, self.window)
            top[place < self.window - 1] = np.nan
            before = np.where(place > 0, np.concatenate(([np.nan], joined[:-1])), np.nan)
            own = place >= np.repeat(lengths - np.diff(at), lengths)
            top, before, now = top[own], before[own], joined[own]
            flag = (now >= top) & (top != before) & (top != 0)
            yield self._out(fresh, top, before, flag.astype(np.int32), False)
            days, parts_of = fresh["loaddate"].to_numpy(object), fresh["subdivision"].to_numpy(object)
            for name, values, a, b in zip(names, parts, at, at[1:]):
                if b > a:
                    self.buffers.updateValue(
                        name, (values[-max(self.window - 1, 1):].tolist(), days[b - 1], parts_of[b - 1]))
        if late.any():
            none = np.full(int(late.sum()), np.nan)
            yield self._out(batch[late], none, none, None, True)

    @staticmethod
    def _out(rows: pd.DataFrame, top, before, flag, late: bool) -> pd.DataFrame:
        out = rows[["loaddate", "subdivision", "trader", "poscommodity", "dailyValue"]].copy()
        out["maxValue"], out["prevDailyVal"] = top, before          # Arrow makes nulls of nan
        out["breaks"] = pd.array([pd.NA] * len(out) if flag is None else flag, dtype="Int32")
        out["late"] = late
        return out

    def close(self) -> None:
        pass


def flag_stream(net: DataFrame, window: int = NEW_HIGH_WINDOW) -> DataFrame:
    """Flags of a stream of net-volume rows (``NET_SCHEMA``; null keys are left out, as the batch test leaves them out)."""
    rows = net.select(*NET_SCHEMA.fieldNames()).dropna(subset=[*SERIES, *ORDER])
    dealt = rows.withColumn("group", F.pmod(F.xxhash64(*SERIES), F.lit(GROUPS)))
    return dealt.groupBy("group").transformWithStateInPandas(
        statefulProcessor=NewHighs(window), outputStructType=FLAGS_SCHEMA, outputMode="Append", timeMode="None")


def start(spark: SparkSession, landing: str, table: DayTable, checkpoint: str, window: int = NEW_HIGH_WINDOW,
          available_now: bool = False, max_files: int | None = None,
          after: Callable[[int], None] | None = None) -> StreamingQuery:
    """Flag the net-volume files that land in `landing` into `table` (of ``FLAGS_SCHEMA``); `after` is called with
    each micro-batch's number once it is committed to the table."""
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != PROVIDER:
        raise RuntimeError(f"set spark.sql.streaming.stateStore.providerClass to {PROVIDER}")
    ship_code(spark)
    reader = spark.readStream.schema(NET_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def write(batch: DataFrame, epoch: int) -> None:
        # The batch runs once and whole, a replayed one too: its state is committed with it. The table's
        # own writes (which sample the rows for their ranges) read what it gave.
        path = scratch_path(spark, "flags-batch")
        batch.write.parquet(path)
        table.append(spark.read.schema(FLAGS_SCHEMA).parquet(path), f"highs-{epoch}")
        if after:
            after(epoch)

    w = (flag_stream(reader.parquet(landing), window).writeStream.outputMode("append")
         .option("checkpointLocation", checkpoint).foreachBatch(write))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def flags_table(spark: SparkSession, path: str) -> DayTable:
    return DayTable(spark, path, FLAGS_SCHEMA, keys=(*SERIES, "loaddate", "subdivision"))


def breaks(table: DayTable, since: dt.date | None = None) -> DataFrame:
    """The feed's rows of a flags table: late rows have none."""
    rows = table.read(first=since and since + dt.timedelta(days=1)).where("NOT late")
    return rows.withColumn("test", F.lit(TEST_NEW_HIGH)).select(*FEED_COLUMNS)
