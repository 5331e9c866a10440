"""Hand-written edge cases (FIXTURES.md §4, G1-G42)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tradewatch.functions import beyond_horizon, is_weekday, round_half_even
from tradewatch.operators import daytrades as D
from tradewatch.operators import feed as FD
from tradewatch.operators import highs as H
from tradewatch.operators import positions as P
from tradewatch.operators.tenor import tenor_breaks
from tradewatch import params
from tradewatch.params import OneOffRule, Scope

d = dt.date.fromisoformat
FILLS = params.testdata_rules().fills
SINCE = d("2020-01-01")


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


# ---------------------------------------------------------------- desk, flag

def test_resolve_desk_g1_g3(spark):
    df = spark.createDataFrame(
        [("F", "ABCDEFGHIJKLM", "L"), ("F", "   ", "L"), ("p", None, "L"), ("O", "Trader", "L")],
        "source string, trader_raw string, location string")
    out = rows(df.select(P.resolve_desk("source", "trader_raw", "location", ["F", "P"]).alias("d")), "d")
    assert out == [("ABCDEFGHIJ",), ("L",), ("L",), ("L",)]


def test_tenor_flag_g4(spark):
    df = spark.createDataFrame([(d("2024-01-31"), d("2025-01-31")), (d("2024-01-31"), d("2025-02-01")),
                                (d("2024-01-31"), None)], "l date, c date")
    assert rows(df.select(beyond_horizon("l", "c").alias("f")), "f") == [(0,), (1,), (0,)]


# ---------------------------------------------------------------- tenor

TENOR_COLS = "loaddate date, commodity string, desk string, subdivision string, beyond_twelve_months int, delta double"


def test_tenor_breaks_g5_g8(spark):
    day = d("2024-03-04")
    data = [
        (day, "c", "k20", "s", 1, 20.0), (day, "c", "k20", "s", 0, 80.0),
        (day, "c", "k21", "s", 1, 21.0), (day, "c", "k21", "s", 0, 79.0),
        (day, "c", "k00", "s", 0, 0.0),
        (day, "c", "k50", "s", 0, 50.0),
        (day, "c", "g6", "s", 1, 10.0), (day, "c", "g6", "s", 0, 90.0),
        (day, "c", "g7", "s", 1, 5.0), (day, "c", "g7", "s", 1, -5.0),
        (day, None, "g8", "s", 1, 5.0),
    ]
    out = {r.trader: (r.dailyValue, r.breaks)
           for r in tenor_breaks(spark.createDataFrame(data, TENOR_COLS)).collect()}
    assert out == {"k20": (0.2, 0), "k21": (0.21, 1), "k00": (0.0, 0), "k50": (0.0, 0),
                   "g6": (0.1, 0), "g7": (1.0, 1)}


# ---------------------------------------------------------------- scopes, exclusions

POS_COLS = ("loaddate date, commodity string, delta double, source string, location_code bigint, "
            "sub_location string, side string, trader_raw string, contract_month date, "
            "contract_number string, position_type string")


def _dims(spark, days):
    from tradewatch.schemas import PositionDims
    return PositionDims(
        locations=spark.createDataFrame([(1, "Loc A", 10), (2, "Loc B", 20)],
                                        "location_code bigint, location string, subdivision_code int"),
        subdivisions=spark.createDataFrame([(10, "North", 100), (20, "South", 100)],
                                           "subdivision_code int, subdivision string, division_code int"),
        divisions=spark.createDataFrame([(100, "Grain")], "division_code int, division string"),
        workdays=spark.createDataFrame([(x,) for x in days], "workday date"))


def test_overlapping_scopes_g9(spark):
    day = d("2024-03-04")
    pos = spark.createDataFrame(
        [(day, "Corn", 5.0, "X", 1, "s", "Purchase", "", d("2024-04-01"), "c1", "STD")], POS_COLS)
    scopes = (Scope("div", division="grain"), Scope("north", include_subdivisions=("North",)))
    tagged = P.scoped_positions(pos, _dims(spark, [day]), scopes, d("2024-01-01"), ["F"])
    assert sorted(r.scope for r in tagged.collect()) == ["div", "north"]
    flagged = tagged.withColumn("beyond_twelve_months", F.lit(0))
    assert rows(P.tenor_exposure(flagged), "abs_st") == [(10.0,)]        # doubled
    net = H.net_side_volume(P.side_volume(tagged))
    assert rows(net, "dailyValue") == [(5.0,)]                          # mean: unchanged
    fused = H.net_volume(tagged, [s.name for s in scopes])
    assert rows(fused, "dailyValue") == [(5.0,)]


def _rules(**kw):
    r = params.testdata_rules().positions
    from dataclasses import replace
    return replace(r, **kw)


def test_exclusions_g10_g13(spark):
    mon, sat, sun = d("2024-03-04"), d("2024-03-02"), d("2024-03-03")
    base = ("X", 1, "s", "Purchase", "", d("2024-04-01"), "c1", "STD")
    data = [(mon, "Corn", 1.0, *base), (sat, "Corn", 2.0, *base), (sun, "Corn", 3.0, *base),
            (mon, "CURRENCIES", 4.0, *base),
            (mon, "Corn", 5.0, "X", 1, None, "Purchase", "", d("2024-04-01"), "c1", "STD"),
            (mon, "Corn", 6.0, "X", 1, "s", "Purchase", "", d("2024-04-01"), None, "STD")]
    pos = spark.createDataFrame(data, POS_COLS)
    scope = Scope("north", include_subdivisions=("north",))
    rules = _rules(excluded_commodities=("Currencies",), high_scopes=(scope,),
                   high_sub_locations=("gives",), high_contracts=(),
                   one_offs=(OneOffRule(contract_number="zz", loaddate="2024-03-04"),),
                   holidays=())
    tagged = P.scoped_positions(pos, _dims(spark, [mon, sat, sun]), (scope,), d("2024-01-01"), [])
    kept = sorted(r.delta for r in P.exclude(tagged, rules, "high").collect())
    # weekend rows (G10), CURRENCIES (G13), null sub-location (G12) and the
    # row whose one-off part compares a null contract (G11) are all dropped
    assert kept == [1.0]


# ---------------------------------------------------------------- fills

FILL_COLS = ("trade_date date, load_date date, account string, account_name string, "
             "subdivision string, location string, commodity string, source string, "
             "position_month date, fin_type string, strike_price double, side string, "
             "gross_qty double, mtm double, broker_num string, card_number string, "
             "comment_code string")
T0 = d("2024-03-04")
M0 = d("2024-05-01")


def fill(side, qty, mtm=0.0, account="AC10", name="HOLDER 1", strike=0.0, load=T0, trade=T0,
         commodity="LARGE", source="FMT", location="LOC_1"):
    return (trade, load, account, name, "SUB_1", location, commodity, source, M0, "F", strike,
            side, qty, mtm, "BRK", "CRD", "N")


def test_fill_sides_g14(spark):
    f = spark.createDataFrame([fill("B", 5.0), fill("B", 7.0, load=d("2024-03-05")),
                               fill("B", 0.0)], FILL_COLS)
    assert rows(D.fill_sides(f, FILLS, SINCE), "qty") == [(5.0,)]


def test_match_g15_g17(spark):
    f = spark.createDataFrame([
        fill("B", 10.0, account="A1"), fill("S", 4.0, account="A1"),
        fill("B", 4.0, account="A2"), fill("S", 10.0, account="A2"),
        fill("B", 10.0, account="A3"),
        fill("B", 3.0, account="A4", strike=None), fill("S", 3.0, account="A4", strike=None),
        fill("B", 8.0, account="A5"), fill("S", 2.0, account="A5", name="X"),
        fill("S", 3.0, account="A5", name="Y"),
    ], FILL_COLS)
    m = D.day_trade_match(D.fill_sides(f, FILLS, SINCE))
    got = sorted(rows(m, "account", "day_trade_qty"), key=str)
    assert got == sorted([("A1", 4.0), ("A2", 4.0), ("A3", None), ("A4", None),
                          ("A5", 2.0), ("A5", 3.0)], key=str)


def test_pnl_g18_g21(spark):
    df = spark.createDataFrame(
        [("a", 10.0, 100.0, 4.0, -30.0, 4.0), ("b", 4.0, 100.0, 10.0, -30.0, 4.0),
         ("c", 5.0, 7.0, 0.0, 11.0, 0.0), ("d", 0.0, 7.0, 0.0, 11.0, 0.0)],
        "k string, purchase_qty double, purchase_pnl double, sale_qty double, sale_pnl double, "
        "day_trade_qty double")
    out = dict(rows(D.day_trade_pnl(df), "k", "day_trade_pnl"))
    assert out["a"] == pytest.approx(10.0) and out["b"] == pytest.approx(88.0)
    assert out["c"] == pytest.approx(11.0) and out["d"] is None


def test_skeleton_g22_active_g23(spark):
    t1, t2, t3 = d("2024-03-04"), d("2024-03-05"), d("2024-03-06")
    f = spark.createDataFrame([
        fill("B", 5.0, account="A1", trade=t1, load=t1), fill("S", 5.0, account="A1", trade=t1, load=t1),
        fill("S", 5.0, account="A2", trade=t2, load=t2),
        fill("S", 1.0, account="A2", trade=t3, load=t3)], FILL_COLS)
    sk = D.account_date_skeleton(f, FILLS, SINCE)
    assert sorted(rows(sk, "account", "trade_date")) == sorted(
        [(a, t) for a in ("A1", "A2") for t in (t1, t2, t3)])
    sides = D.fill_sides(f, FILLS, SINCE)
    allrows = D.day_trade_pnl(D.day_trade_match(sides)).select(*D.ROW_COLUMNS).unionByName(sk)
    act = D.active_accounts(allrows, sides, FILLS, SINCE)
    assert {r.account for r in act.collect()} == {"A1"} and act.count() == 4


def _fill_dims(spark):
    from tradewatch.schemas import FillDims
    return FillDims(
        commodity=spark.createDataFrame([("Corn", 1, "1"), ("Wheat", 2, "1"), ("Oats", 9, "1")],
                                        "description string, subgroup_id int, status_id string"),
        commodity_subgroup=spark.createDataFrame([(1, 1, "1"), (2, 2, "1")],
                                                 "id int, group_id int, status_id string"),
        commodity_group=spark.createDataFrame([(1, "Corn Products", "1"), (2, "Grains", "1")],
                                              "id int, description string, status_id string"),
        account_map=spark.createDataFrame([("AC10", "3", 7), ("AC11", "3", 8)],
                                          "source_report_code string, source_id string, location_id int"),
        locations=spark.createDataFrame([(7, "Plant", 1), (8, "GPS desk", 1)],
                                        "location_id int, location string, subdivision_id int"),
        subdivisions=spark.createDataFrame([(1, "East")], "subdivision_id int, subdivision string"))


def test_commodity_groups_g24(spark):
    from dataclasses import replace
    rules = replace(FILLS, blocked_commodity_group=("corn", "CORN PRODUCTS"))
    got = sorted(rows(D.commodity_groups(_fill_dims(spark), rules), "commoditydescription", "commgrp"),
                 key=str)
    assert got == sorted([("Wheat", "Grains"), ("Oats", None)], key=str)


def test_account_location_g25(spark):
    from dataclasses import replace
    rules = replace(FILLS, blocked_location_like="%gps%")
    df = spark.createDataFrame([("AC10", "FMT"), ("AC10", "ICE"), ("AC11", "FMT")],
                               "account string, source string")
    out = rows(D.account_location(df, _fill_dims(spark), rules), "account", "map_location")
    assert out == [("AC10", "Plant")]


def test_day_trade_breaks_g26(spark):
    df = spark.createDataFrame([(T0, "AC", "E", "P1", "G", 100.0, 1.0),
                                (T0, "AC", "E", "P2", "G", 100.01, 1.0),
                                (T0, "AC", "E", "P3", "G", None, None)],
                               "trade_date date, account string, subdivision string, location string, "
                               "commodity string, day_trade_qty double, day_trade_pnl double")
    out = dict(rows(D.day_trade_breaks(df, FILLS), "trader", "breaks"))
    assert out == {"P1": 0, "P2": 1, "P3": 0}


# ---------------------------------------------------------------- new highs

def test_side_volume_g27(spark):
    day = d("2024-03-04")
    df = spark.createDataFrame([("s", day, "C", "D", "NA", "Sub", -5.0), ("s", day, "C", "D", "NA", "Sub", 2.0),
                                ("s", day, "C", "D", "Sale", "Sub", -5.0)],
                               "scope string, loaddate date, commodity string, desk string, side string, "
                               "subdivision string, delta double")
    assert dict(rows(P.side_volume(df), "pors", "abs_st")) == {"NA": -3.0, "Sale": 5.0}


SV = "scope string, loaddate date, poscommodity string, trader string, pors string, subdivision string, abs_st double"


def test_net_side_volume_g28_g30(spark):
    day = d("2024-03-04")
    df = spark.createDataFrame([
        ("a", day, "C", "k1", "Purchase", "S", 2.0), ("b", day, "C", "k1", "Purchase", "S", 4.0),
        ("a", day, "C", "k2", "Purchase", "S", 7.0),
        ("a", day, "C", "k3", "NA", "S", 0.000025), ("a", day, "C", "k4", "NA", "S", 0.000035),
        ("a", day, "C", "k5", "Other", "S", None)], SV)
    out = dict(rows(H.net_side_volume(df), "trader", "dailyValue"))
    assert out == {"k1": 3.0, "k2": 7.0, "k3": 2e-05, "k4": 3e-05}


def _series(spark, values, subdivisions=None):
    base = d("2024-01-01")
    data = [(base + dt.timedelta(days=i), "C", "T", (subdivisions or ["S"] * len(values))[i], v)
            for i, v in enumerate(values)]
    return spark.createDataFrame(data, "loaddate date, poscommodity string, trader string, subdivision string, dailyValue double")


@pytest.mark.parametrize("values,expected", [
    ([1, 2, 2, 1, 3], [0, 0, 0, 0, 1]),      # G31: warm-up, plateau, below max
    ([5, 1, 5], [0, 0, 1]),                  # G32: older tie still counts
    ([0, 0, 0], [0, 0, 0]),                  # G33: max 0
    ([-1, -2, 0], [0, 0, 0]),
])
def test_new_high_g31_g33(spark, values, expected):
    out = H.new_high_breaks(_series(spark, [float(v) for v in values]), 3).orderBy("loaddate")
    assert [r.breaks for r in out.collect()] == expected


def test_series_order_g34(spark):
    same = d("2024-01-01")
    df = spark.createDataFrame([(same, "C", "T", "B", 2.0), (same, "C", "T", "A", 1.0),
                                (d("2024-01-02"), "C", "T", "A", 3.0)],
                               "loaddate date, poscommodity string, trader string, subdivision string, dailyValue double")
    out = H.new_high_flags(df, 2).orderBy("loaddate", "subdivision")
    assert [(r.subdivision, r.prevDailyVal) for r in out.collect()] == [("A", None), ("B", 1.0), ("A", 2.0)]


def test_running_count_g35(spark):
    df = _series(spark, [0.0] * 4).withColumn("breaks", F.lit(0))
    flags = [0, 1, 0, 1]
    base = d("2024-01-01")
    df = spark.createDataFrame([(base + dt.timedelta(days=i), "C", "T", "S", 0.0, f) for i, f in enumerate(flags)],
                               "loaddate date, poscommodity string, trader string, subdivision string, dailyValue double, breaks int")
    out = H.break_running_count(df).orderBy("loaddate")
    assert [r.count_breaks for r in out.collect()] == [0, 1, 1, 2]


def test_band_g42(spark):
    out = H.band_breaks(_series(spark, [1.0, 1.0, 1.0, 5.0]), 3, 1.0).orderBy("loaddate").collect()
    assert len(out) == 2
    last = out[-1]
    assert (last.moving_avg, last.moving_std, last.upper_bound, last.breaks) == (2.33333, 2.3094, 4.64273, 1)
    assert out[0].breaks == 0


def test_round_half_even_matches_numpy(spark):
    import numpy as np
    vals = [0.000025, 0.000035, 1.234565, -0.000025, 2.5e-05 * 3]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(round_half_even("x", 5)).collect()]
    assert got == [float(np.round(v, 5)) for v in vals]


# ---------------------------------------------------------------- feed

FEED = "loaddate date, subdivision string, trader string, poscommodity string, dailyValue double, breaks int, test string"


def test_combined_since_g36(spark):
    a = spark.createDataFrame([(d("2024-01-01"), "s", "t", "c", 1.0, 0, "x"),
                               (d("2024-01-02"), "s", "t", "c", 1.0, 0, "x")], FEED)
    out = FD.combined_breaks([a], d("2024-01-01"))
    assert rows(out, "loaddate") == [(d("2024-01-02"),)]
    assert FD.combined_breaks([a], d("2023-12-31"), until=d("2024-01-01")).count() == 1


def test_cluster_conf():
    from tradewatch.session import cluster_conf
    c = cluster_conf(100 * 10**12, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 100_000
    assert int(cluster_conf(10**9, 8)["spark.sql.shuffle.partitions"]) == 16


def test_weekday(spark):
    df = spark.createDataFrame([(d("2024-03-02"),), (d("2024-03-03"),), (d("2024-03-04"),)], "x date")
    assert rows(df.where(is_weekday("x")), "x") == [(d("2024-03-04"),)]


def test_clean_message_g41(spark):
    df = spark.createDataFrame([("it's \"bad\", x",)], "m string")
    assert rows(df.select(FD.clean_message("m")), "*") == [("its bad x",)]


# ---------------------------------------------------------------- collation, own-type sums, windows

def test_text_keys_ignore_case_and_trailing_blanks(spark):
    f = spark.createDataFrame([
        fill("B", 5.0, account="AC10", commodity="Corn"), fill("b ", 2.0, account="ac10 ", commodity="CORN"),
        fill("S", 4.0, account="Ac10", commodity="corn ")], FILL_COLS)
    sides = D.fill_sides(f, FILLS, SINCE)
    assert sorted(rows(sides, "account", "commodity", "qty")) == [("AC10", "CORN", 7.0), ("Ac10", "corn ", 4.0)]
    assert rows(D.day_trade_match(sides), "day_trade_qty") == [(4.0,)]
    out = D.day_trade_rows(f, _fill_dims(spark), FILLS, SINCE)
    matched = out.where("day_trade_qty > 0")
    assert rows(matched, "subdivision", "location", "commodity", "day_trade_qty") == [
        ("East", "Plant", "Corn Products", 4.0)]
    assert {r.account for r in D.skeleton_accounts(f, FILLS, SINCE).collect()} == {"AC10"}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_keep_small_and_large_values(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        day = d("2024-03-04")
        data = [(day, "c", "small", "s", 1, 4e-7)] * 10 + [(day, "c", "large", "s", 0, 5e12)] * 2 + \
            [(day, "c", "large", "s", 1, 5e12)] * 2
        df = spark.createDataFrame(data, TENOR_COLS)
        got = {(r.trader, r.beyond_twelve_months): r.abs_st for r in P.tenor_exposure(df).collect()}
        assert got[("small", 1)] == pytest.approx(4e-6) and got[("large", 0)] == got[("large", 1)] == 1e13
        assert {r.trader: r.dailyValue for r in tenor_breaks(df).collect()} == {"small": 1.0, "large": 0.5}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_decimal_quantities_add_up_exactly(spark):
    f = (spark.createDataFrame([fill("B", 0.1)] * 10 + [fill("S", 0.7)] * 3, FILL_COLS)
         .withColumn("gross_qty", F.col("gross_qty").cast("decimal(12,2)")))
    m = D.day_trade_match(D.fill_sides(f, FILLS, SINCE)).collect()
    assert [str(r.day_trade_qty) for r in m] == ["1.00"]


def test_window_of_one_row_and_short_chunks(spark):
    net = spark.createDataFrame([(d(f"2024-03-0{i}"), "c", "t", "s", 5.0, 5.0) for i in range(1, 5)],
                                "loaddate date, poscommodity string, trader string, subdivision string, "
                                "pns double, dailyValue double")
    want = [r.breaks for r in H.new_high_flags(net, 1).orderBy("loaddate").collect()]
    got = [r.breaks for r in H.new_high_flags(net, 1, chunk_rows=2).orderBy("loaddate").collect()]
    assert got == want == [1, 0, 0, 0]
    with pytest.raises(ValueError):
        H.new_high_flags(net, 3, chunk_rows=1)
