"""Properties of the outputs, and brute-force checks on small random input.

The brute-force side is plain pandas written from the documented rules
(rolling row windows, plateau rule, pivot mean), run on the same small
random series as the Spark operators.
"""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradewatch.plans.queries import registry as queries
from oracle_harness import SF_ORACLE
from tradewatch.operators import highs as H

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.fixture(scope="module")
def outputs(spark):
    qs = queries()
    keys = ["tenor_breaks", "day_trade_match", "new_high_breaks", "break_running_count",
            "combined_breaks", "day_trade_breaks"]
    return {k: qs[k](spark, SF_ORACLE).toPandas() for k in keys}


def test_tenor_share_in_unit_interval(outputs):
    v = outputs["tenor_breaks"]["dailyValue"]
    assert ((v >= 0) & (v <= 1)).all()


def test_one_row_per_key_per_test(outputs):
    f = outputs["combined_breaks"]
    keys = ["test", "loaddate", "subdivision", "trader", "poscommodity"]
    assert not f.duplicated(keys).any()


def test_matched_qty_not_above_either_side(outputs):
    m = outputs["day_trade_match"].dropna(subset=["day_trade_qty"])
    both = m[(m.purchase_qty >= 0) & (m.sale_qty >= 0)]
    assert (both.day_trade_qty <= both.purchase_qty).all()
    assert (both.day_trade_qty <= both.sale_qty).all()


def test_no_new_high_before_full_window(outputs):
    f = outputs["break_running_count"].sort_values(["poscommodity", "trader", "loaddate", "subdivision"])
    rank = f.groupby(["poscommodity", "trader"]).cumcount() + 1
    assert (f.loc[rank < 252, "breaks"] == 0).all()
    assert f.loc[rank < 252, "maxValue"].isna().all()


def test_running_count_ends_at_total(outputs):
    f = outputs["break_running_count"].sort_values(["poscommodity", "trader", "loaddate", "subdivision"])
    last = f.groupby(["poscommodity", "trader"]).tail(1).set_index(["poscommodity", "trader"])
    total = f.groupby(["poscommodity", "trader"])["breaks"].sum()
    assert (last["count_breaks"] == total.loc[last.index]).all()


def test_day_trade_breaks_threshold(outputs):
    f = outputs["day_trade_breaks"]
    assert ((f.dailyValue > 100) == (f.breaks == 1)).all()


def test_input_order_does_not_matter(spark):
    q = queries()["new_high_breaks_20"]
    a = q(spark, SF_ORACLE)
    b = q(spark, SF_ORACLE)
    # shuffle the series rows before the window: same result
    net = H.net_side_volume(queries()["side_volume"](spark, SF_ORACLE))
    shuffled = net.repartition(7, F.rand(seed=3))
    c = H.new_high_breaks(shuffled, 20)
    cols = a.columns
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, a.select(cols).collect()), key=key) == \
        sorted(map(tuple, c.select(cols).collect()), key=key)
    assert a.count() == b.count()


# ------------------------------------------------------------ brute force

def _frame(spark, series):
    base = dt.date(2024, 1, 1)
    rows = []
    for (comm, trader), values in series.items():
        for i, v in enumerate(values):
            rows.append((base + dt.timedelta(days=i), comm, trader, "S", float(v)))
    return rows, spark.createDataFrame(
        rows, "loaddate date, poscommodity string, trader string, subdivision string, dailyValue double")


def _pandas_new_high(rows, window):
    p = pd.DataFrame(rows, columns=["loaddate", "poscommodity", "trader", "subdivision", "dailyValue"])
    p = p.sort_values(["loaddate", "poscommodity", "trader", "subdivision"]).reset_index(drop=True)
    g = p.groupby(["poscommodity", "trader"])["dailyValue"]
    p["maxValue"] = g.transform(lambda x: x.rolling(window=window).max())
    p["flag"] = np.where(p["dailyValue"] >= p["maxValue"], 1, 0)
    p["prev"] = g.shift(1)
    p.loc[p["maxValue"] == p["prev"], "flag"] = 0
    p.loc[p["maxValue"] == 0, "flag"] = 0
    return {(r.loaddate, r.poscommodity, r.trader): int(r.flag) for r in p.itertuples()}


series_strategy = st.dictionaries(
    st.tuples(st.sampled_from(["A", "B"]), st.sampled_from(["t1", "t2"])),
    st.lists(st.integers(min_value=-3, max_value=6), min_size=1, max_size=25),
    min_size=1, max_size=3)


@SETTINGS
@given(series=series_strategy, window=st.integers(min_value=2, max_value=6))
def test_new_high_matches_pandas(spark, series, window):
    rows, df = _frame(spark, series)
    got = {(r.loaddate, r.poscommodity, r.trader): r.breaks
           for r in H.new_high_breaks(df, window).collect()}
    assert got == _pandas_new_high(rows, window)


@SETTINGS
@given(series=series_strategy, window=st.integers(min_value=2, max_value=6))
def test_band_matches_pandas(spark, series, window):
    rows, df = _frame(spark, series)
    p = pd.DataFrame(rows, columns=["loaddate", "poscommodity", "trader", "subdivision", "dailyValue"])
    g = p.groupby(["poscommodity", "trader"])["dailyValue"]
    p["m"] = np.round(g.transform(lambda x: x.rolling(window).mean()), 5)
    p["s"] = np.round(g.transform(lambda x: x.rolling(window).std()), 5)
    p["b"] = np.round(p["m"] + p["s"] * 2, 5)
    p = p[p["m"].notna()]
    want = {(r.loaddate, r.poscommodity, r.trader): (r.m, r.s, r.b, int(r.dailyValue > r.b))
            for r in p.itertuples()}
    got = {(r.loaddate, r.poscommodity, r.trader): (r.moving_avg, r.moving_std, r.upper_bound, r.breaks)
           for r in H.band_breaks(df, window, 2.0).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][:3] == pytest.approx(want[k][:3], abs=1e-9)
        assert got[k][3] == want[k][3]


@SETTINGS
@given(cells=st.lists(st.tuples(st.sampled_from(["s1", "s2", "s3"]), st.sampled_from(["k1", "k2"]),
                                st.sampled_from(["Purchase", "Sale", "NA"]),
                                st.integers(min_value=-50, max_value=50)),
                      min_size=1, max_size=20, unique_by=lambda t: t[:3]))
def test_net_side_volume_matches_pivot_mean(spark, cells):
    day = dt.date(2024, 1, 2)
    rows = [(s, day, "C", k, side, "Sub", float(v)) for s, k, side, v in cells]
    df = spark.createDataFrame(rows, "scope string, loaddate date, poscommodity string, trader string, "
                                     "pors string, subdivision string, abs_st double")
    p = pd.DataFrame(rows, columns=["scope", "loaddate", "poscommodity", "trader", "pors", "subdivision", "abs_st"])
    pv = p.pivot_table(index=["loaddate", "poscommodity", "trader", "subdivision"], columns="pors",
                       values="abs_st").reset_index().fillna(0.0)
    for side in ("Purchase", "Sale", "NA"):
        if side not in pv:
            pv[side] = 0.0
    want = {r.trader: float(np.round(r.Purchase + r.Sale + r.NA, 5)) for r in pv.itertuples()}
    got = {r.trader: r.dailyValue for r in H.net_side_volume(df).collect()}
    assert got == pytest.approx(want)


@pytest.mark.parametrize("window,chunk", [(252, 300), (20, 25), (20, 19), (3, 2), (1, 2), (1, 1)])
def test_chunked_window_equals_plain(spark, window, chunk):
    net = H.net_side_volume(queries()["side_volume"](spark, SF_ORACLE))
    cols = ["loaddate", "subdivision", "trader", "poscommodity", "dailyValue", "maxValue",
            "prevDailyVal", "breaks"]
    plain = H.new_high_flags(net, window).select(cols)
    chunked = H.new_high_flags(net, window, chunk_rows=chunk).select(cols)
    key = lambda r: tuple(str(x) for x in r)
    a = sorted(map(tuple, plain.collect()), key=key)
    b = sorted(map(tuple, chunked.collect()), key=key)
    assert len(a) == len(b) and a == b


def test_chunked_band_and_running_count_equal_plain(spark):
    net = H.net_side_volume(queries()["side_volume"](spark, SF_ORACLE))
    key = lambda r: tuple(str(x) for x in r)
    cols = ["loaddate", "subdivision", "trader", "poscommodity", "moving_avg", "moving_std",
            "upper_bound", "breaks"]
    a = sorted(map(tuple, H.band_breaks(net, 75, 2.0).select(cols).collect()), key=key)
    b = sorted(map(tuple, H.band_breaks(net, 75, 2.0, chunk_rows=80).select(cols).collect()), key=key)
    assert a == b and len(a) > 0
    flags = H.new_high_flags(net, 20)
    cols = ["loaddate", "subdivision", "trader", "poscommodity", "count_breaks"]
    a = sorted(map(tuple, H.break_running_count(flags).select(cols).collect()), key=key)
    b = sorted(map(tuple, H.break_running_count(flags, chunk_rows=80).select(cols).collect()), key=key)
    assert a == b


def test_chunked_queries_match_oracle(spark):
    from oracle_harness import compare, duck
    from tradewatch import params
    from tradewatch.plans import queries as Q
    from tradewatch.plans.oracle import oracle_sql

    rules = params.testdata_rules().with_(series_chunk_rows=300)
    orig = Q.load_inputs

    def chunked(spark, sf_dir, rules_=None, write_facts=True):
        return orig(spark, sf_dir, rules, write_facts)

    Q.load_inputs = chunked
    try:
        con = duck(SF_ORACLE)
        for k in ("new_high_breaks", "break_running_count", "band_breaks"):
            r = compare(spark, SF_ORACLE, k, Q.registry()[k], oracle_sql()[k], con)
            assert r["values_match"] and r["spark_rows"] == r["oracle_rows"], r
    finally:
        Q.load_inputs = orig


def test_desk_level_zero_rows_equal_account_level(spark):
    from tradewatch.operators import daytrades as D
    from tradewatch.plans.inputs import load_inputs

    i = load_inputs(spark, SF_ORACLE)
    r = i.rules
    faithful = D.day_trade_breaks(D.day_trade_rows(i.fills, i.fill_dims, r.fills, r.since), r.fills)
    fast = D.day_trade_feed(i.fills, i.fill_dims, r.fills, r.since)
    key = lambda t: tuple(str(x) for x in t)
    a = sorted(map(tuple, faithful.collect()), key=key)
    b = sorted(map(tuple, fast.collect()), key=key)
    assert a == b and len(a) > 0
