"""Plan shape: no Python UDFs, one shuffle where one is enough, pushdown."""

import re

import pytest

from tradewatch.plans.queries import registry as queries
from oracle_harness import SF_SMALL
from tradewatch.operators import daytrades as D
from tradewatch.operators import highs as H
from tradewatch.plans import queries as Q


def formatted(df, mode: str = "simple") -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(queries()))
def test_no_python_udf(spark, key):
    if key.startswith("feed_") or key == "delimited_stage":
        pytest.skip("writes files; covered by test_sinks")
    text = formatted(queries()[key](spark, SF_SMALL))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|PythonUDF", text)


def test_tenor_one_exchange_no_self_join(spark):
    text = formatted(queries()["tenor_breaks"](spark, SF_SMALL))
    # one shuffle for the share (total and beyond in one aggregate); the only
    # other exchange de-duplicates the calendar before it is broadcast
    assert len(re.findall(r"Exchange hashpartitioning\(loaddate#\d+, poscommodity", text)) == 1
    assert text.count("Exchange hashpartitioning") == 2
    assert "SortMergeJoin" not in text and "HashAggregate" in text


def test_new_high_windows_share_one_exchange(spark):
    text = formatted(H.new_high_breaks(Q._net(Q.load_inputs(spark, SF_SMALL)), chunk_rows=None))
    # numbering, blocks from both ends and look-back: one Exchange; one Sort each for the
    # numbers, the blocks backwards, and the blocks forwards with the look-back
    assert text.count("Exchange hashpartitioning(poscommodity") == 1
    # side sums and the mean pivot in one aggregation: one Exchange on the 4 keys
    assert len(re.findall(r"Exchange hashpartitioning\(loaddate#\d+, poscommodity", text)) == 1
    assert "Exchange hashpartitioning(scope" not in text
    assert len(re.findall(r"\bSort \[poscommodity", text)) == 3


def test_filters_reach_scan(spark):
    text = formatted(queries()["tenor_breaks"](spark, SF_SMALL))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(loaddate", text)
    # only the columns the test reads are scanned
    scan = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "contract_number" not in scan and "side" not in scan


def test_no_cross_join(spark):
    for key in ("account_date_skeleton", "day_trade_breaks", "account_location"):
        text = formatted(queries()[key](spark, SF_SMALL))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_fill_filters_reach_scan(spark):
    # the since-date reaches the parquet reader: of the kept groups, and of the fills where these are read
    text = formatted(queries()["fill_sides"](spark, SF_SMALL), "formatted")
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", text).group(1)
    assert "GreaterThan(load_date" in pushed and "EqualTo(counted,true)" in pushed
    i = Q.load_inputs(spark, SF_SMALL)
    text = formatted(D.fill_sides(i.fills, i.rules.fills, i.rules.since), "formatted")
    assert "GreaterThan(load_date" in re.search(r"PushedFilters: \[([^\]]*)\]", text).group(1)


def test_fills_are_summed_by_hash_and_read_once(spark):
    i = Q.load_inputs(spark, SF_SMALL)
    text = formatted(D.fill_groups(i.fills, i.rules.fills))
    assert "HashAggregate" in text and "SortAggregate" not in text and text.count("FileScan") == 1
    # the break test reads the groups once, while it writes its summary; the plan left reads the summary alone
    text = formatted(queries()["day_trade_breaks"](spark, SF_SMALL), "formatted")
    assert "fill_summary" in text and "/views/" not in text and "/fills-" not in text
