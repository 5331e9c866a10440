"""The kept fill groups: brought up to date by day, equal to groups of all fills."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from oracle_harness import SF_SMALL
from tradewatch.operators import daytrades as D
from tradewatch.plans.inputs import load_inputs
from tradewatch.session import scratch_path
from tradewatch.sources.fill_view import GROUPS_SCHEMA, FillView


@pytest.fixture(scope="module")
def inputs(spark):
    return load_inputs(spark, SF_SMALL)


@pytest.fixture
def view(spark, inputs):
    return FillView(spark, scratch_path(spark, "view"), inputs.rules.fills)


def groups(df):
    return sorted((tuple(map(str, r)) for r in df.select(*GROUPS_SCHEMA.fieldNames()).collect()))


def days_of(inputs):
    return [r["load_date"] for r in inputs.fills.select("load_date").distinct().orderBy("load_date").collect()]


def test_arriving_days_give_the_groups_of_all_fills(spark, inputs, view):
    days = days_of(inputs)
    view.build(inputs.fills.where(F.col("load_date") <= F.lit(days[len(days) // 2])), "history")
    kept = {f.path for f in view.table.commit().files}
    for n, day in enumerate(days[len(days) // 2 + 1:][-3:]):
        view.refresh(inputs.fills, [day], f"day-{n}")
        # a later day touches no file of the history
        assert kept <= {f.path for f in view.table.commit().files}
    rest = days[len(days) // 2 + 1:-3]
    view.refresh(inputs.fills, rest, "the rest")
    assert groups(view.groups(dt.date(1990, 1, 1))) == groups(D.fill_groups(inputs.fills, inputs.rules.fills))


def test_a_day_delivered_anew_or_lost(spark, inputs, view):
    days = days_of(inputs)
    view.build(inputs.fills, "history")
    twice = inputs.fills.where(F.col("load_date") == F.lit(days[3]))
    changed = (inputs.fills.where(~F.col("load_date").isin(days[3], days[5])).unionByName(twice).unionByName(twice))
    view.refresh(changed, [days[3], days[5]], "corrections")
    assert groups(view.groups(dt.date(1990, 1, 1))) == groups(D.fill_groups(changed, inputs.rules.fills))
    before = view.table.commit()
    view.refresh(inputs.fills, days, "corrections")                     # the same run again
    assert view.table.commit() == before


def test_refresh_reads_only_its_days(spark, inputs, view, capsys):
    days = days_of(inputs)
    inputs.fills.where(F.col("load_date").isin(days[:2])).explain("formatted")
    assert "In(load_date" in capsys.readouterr().out


def test_rules_have_views_of_their_own(spark, inputs):
    import dataclasses
    path = scratch_path(spark, "rules")
    other = dataclasses.replace(inputs.rules.fills, excluded_accounts=())
    a, b = FillView(spark, path, inputs.rules.fills), FillView(spark, path, other)
    assert a.table.path != b.table.path
    a.build(inputs.fills, "x")
    assert b.table.versions() == []


def test_test_from_the_view_equals_the_test_from_fills(spark, inputs, view):
    r = inputs.rules
    view.build(inputs.fills, "history")
    key = lambda t: tuple(map(str, t))
    a = sorted(map(tuple, D.group_feed(view.groups(r.since), inputs.fill_dims, r.fills, r.since).collect()), key=key)
    b = sorted(map(tuple, D.day_trade_feed(inputs.fills, inputs.fill_dims, r.fills, r.since).collect()), key=key)
    c = sorted(map(tuple, D.day_trade_breaks(D.day_trade_rows(inputs.fills, inputs.fill_dims, r.fills, r.since), r.fills).collect()), key=key)
    assert a == b == c and len(a) > 0


def test_spine_makes_a_row_for_each_real_day(spark):
    # a stray day of year 9999 is one more day, not eight thousand years of them
    days = spark.createDataFrame([(dt.date(2024, 1, 2),), (dt.date(2024, 1, 5),), (dt.date(9999, 12, 31),), (dt.date(2024, 1, 2),), (None,)],
                                 "trade_date date")
    keys = spark.createDataFrame([("a",), ("b",), (None,)], "account string")
    got = D.date_spine(keys, days)
    assert got.count() == 9 and D.date_spine(keys, days, dt.date(2024, 1, 2)).count() == 6
    assert D.date_spine(keys, days.limit(0)).count() == 0 and D.date_spine(keys.limit(0), days).count() == 0


def test_spellings_collapse_after_the_sums(spark):
    from test_golden import FILL_COLS, FILLS, SINCE, fill
    rows = [fill("B", 2.0), fill("B", 3.0), fill("S", 1.0)]
    f = spark.createDataFrame(rows, FILL_COLS)
    odd = f.withColumn("account", F.concat(F.upper("account"), F.lit("  ")))
    g = D.fill_groups(f.unionByName(odd), FILLS)
    assert g.where("counted").count() == 4                              # as spelled
    got = {r.pors: r.qty for r in D.group_sides(g, SINCE).collect()}
    assert got == {"B": 10.0, "S": 2.0}
