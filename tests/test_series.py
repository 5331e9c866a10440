"""Series windows against plain Spark windows and pandas, in chunks of every alignment."""

import datetime as dt
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from test_plans import formatted
from tradewatch.operators import highs as H
from tradewatch.operators import series as S

DAY = dt.date(2024, 1, 1)
COLUMNS = "loaddate date, poscommodity string, trader string, subdivision string, dailyValue double"


def rows(seed, lengths, spread=2000, values=None):
    """Series of the given lengths with repeated values, several subdivisions a day and gaps."""
    rng = np.random.default_rng(seed)
    out = []
    for k, n in enumerate(lengths):
        days = np.sort(rng.integers(0, spread, n))
        for i, day in enumerate(days):
            v = float(rng.integers(-4, 6)) if values is None else float(values[i])
            out.append((DAY + dt.timedelta(days=int(day)), f"C{k % 3}", f"T{k}", f"S{i:05d}", v))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, COLUMNS).repartition(7)


def pandas_series(data):
    p = pd.DataFrame(data, columns=["loaddate", "poscommodity", "trader", "subdivision", "v"])
    return p.sort_values(["poscommodity", "trader", "loaddate", "subdivision"]).groupby(["poscommodity", "trader"], sort=False)


LENGTHS = [1, 2, 3, 19, 20, 21, 40, 59, 60, 61, 200]


@pytest.mark.parametrize("window,chunk", [(1, None), (1, 1), (3, 2), (20, None), (20, 19), (20, 20), (20, 33), (20, 5000), (7, 64)])
def test_rolling_max_equals_pandas(spark, window, chunk):
    data = rows(1, LENGTHS)
    got = H.new_high_flags(frame(spark, data), window, chunk).toPandas()
    assert len(got) == len(data)
    got = got.sort_values(["poscommodity", "trader", "loaddate", "subdivision"])["maxValue"].to_numpy()
    want = np.concatenate([g["v"].rolling(window).max().to_numpy() for _, g in pandas_series(data)])
    assert np.array_equal(got, want, equal_nan=True)


@pytest.mark.parametrize("chunk", [None, 1, 7, 64])
def test_running_count_equals_pandas(spark, chunk):
    data = rows(2, LENGTHS)
    df = frame(spark, data).withColumn("breaks", (F.col("dailyValue") > 2).cast("int"))
    got = H.break_running_count(df, chunk).toPandas().sort_values(["poscommodity", "trader", "loaddate", "subdivision"])
    want = np.concatenate([(g["v"] > 2).cumsum().to_numpy() for _, g in pandas_series(data)])
    assert got["count_breaks"].tolist() == want.tolist()


def test_one_hot_month_spreads_over_chunks(spark):
    # A third of all rows: one series, all in one month. No chunk holds more than its share of it.
    data = rows(3, [1500], spread=28) + rows(4, [100] * 30)[100:]
    p = S.chunked(frame(spark, data), 19, 100)
    sizes = [r["count"] for r in p.rows.groupBy("_chunk").count().collect()]
    assert max(sizes) <= 119 and p.rows.where("NOT _halo").select("_chunk").distinct().count() == -(-len(data) // 100)
    hot = p.rows.where("trader = 'T0' AND NOT _halo").groupBy("_chunk").count().count()
    assert hot >= 15
    key = lambda r: tuple(map(str, r))
    a, b = (sorted(map(tuple, H.new_high_running_count(frame(spark, data), 20, c).collect()), key=key) for c in (None, 100))
    assert a == b and len(a) == len(data)


def test_places_are_dense_and_ordered(spark):
    data = rows(5, LENGTHS)
    got = S.in_order(frame(spark, data)).orderBy("_g").collect()
    assert [r._g for r in got] == list(range(len(data)))
    keys = [(r.poscommodity, r.trader, r.loaddate, r.subdivision) for r in got]
    assert keys == sorted(keys)


@pytest.mark.parametrize("chunk", [None, 75, 100])
def test_moments_are_exact(spark, chunk):
    # A mean of 1e9 and steps of 1e-5: sums of squared doubles would keep no digit of the deviation.
    rng = np.random.default_rng(6)
    values = np.round(1e9 + rng.integers(0, 50, 300) * 1e-5, 5)
    data = rows(7, [300], spread=5000, values=values)
    got = (H.band_breaks(frame(spark, data), 75, 2.0, 5, chunk).toPandas()
           .sort_values("subdivision").reset_index(drop=True))
    steps = pd.Series(np.rint(values * 1e5).astype(np.int64) - 10**14)
    assert len(got) == 226
    assert np.allclose(got["moving_std"], (steps.rolling(75).std() / 1e5).dropna().round(5), atol=1e-9)
    # A double at 1e9 is a multiple of 1.2e-7: the fifth digit of the mean may fall either way at a tie.
    assert np.allclose(got["moving_avg"] - 1e9, (steps.rolling(75).mean() / 1e5).dropna(), atol=6e-6)


def test_values_too_large_end_the_job(spark):
    data = rows(8, [5], values=[1.0, 2.0, 3.0, 1e10, 4.0])
    with pytest.raises(PySparkException, match="too large for exact moments"):
        H.band_breaks(frame(spark, data), 2).collect()


def test_window_of_one_row_and_no_rows(spark):
    one = H.band_breaks(frame(spark, rows(9, [3])), 1, 2.0).collect()
    assert len(one) == 3 and all(r.moving_std is None and r.breaks == 0 for r in one)
    none = frame(spark, rows(9, [3])).limit(0)
    assert H.new_high_running_count(none, 20, 50).count() == 0 and H.band_breaks(none, 20, chunk_rows=50).count() == 0


def test_equals_a_plain_sliding_frame(spark):
    data = rows(10, [300, 10, 77])
    w = Window.partitionBy(*S.SERIES).orderBy(*S.ORDER)
    plain = frame(spark, data).withColumn("m", F.when(F.count("dailyValue").over(w.rowsBetween(-19, 0)) == 20,
                                                      F.max("dailyValue").over(w.rowsBetween(-19, 0))))
    a = sorted((r.trader, r.subdivision, r.m) for r in plain.collect())
    b = sorted((r.trader, r.subdivision, r.maxValue) for r in H.new_high_flags(frame(spark, data), 20, 50).collect())
    assert [x[:2] for x in a] == [x[:2] for x in b] and [x[2] for x in a] == [x[2] for x in b]


@pytest.mark.parametrize("chunk", [None, 100])
def test_no_sliding_frame_in_the_plans(spark, chunk):
    df = frame(spark, rows(11, [50, 60]))
    for out in (H.new_high_breaks(df, 20, chunk), H.band_breaks(df, 20, chunk_rows=chunk), H.new_high_running_count(df, 20, chunk)):
        text = formatted(out)
        # Frames grow from their first row, or are a single row back (lag).
        frames = re.findall(r"specifiedwindowframe\(RowFrame, ([^,]+), ([^)]*)\)", text)
        assert frames and all(a == "unboundedpreceding$()" or a == b.strip() for a, b in frames), frames
    text = formatted(H.new_high_breaks(df, 20, chunk))
    assert text.count("Exchange hashpartitioning(_chunk" if chunk else "Exchange hashpartitioning(poscommodity") == 1
