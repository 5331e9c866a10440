"""Dated rule tables against rules evaluated one by one in Python, with SQL's null logic."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from oracle_harness import SF_SMALL
from test_plans import formatted
from tradewatch.operators import positions as P
from tradewatch.operators import rules as RU
from tradewatch.plans.inputs import load_inputs

DAY = dt.date(2024, 1, 1)                                              # a Monday
POSITIONS = ("id int, scope string, loaddate date, contract_number string, side string, commodity string, location string, "
             "desk string, sub_location string, position_type string")


NAMES = [c.split()[0] for c in POSITIONS.split(", ")]


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in NAMES) for r in rows], POSITIONS)


def norm(v):
    return v.rstrip(" ").lower()


def like(text, pattern):
    return re.fullmatch(RU.like_regex(pattern), text.lower()) is not None


def excluded(row, rule, test):
    """One rule on one row: excluded unless a part is false."""
    if rule["test"] != test or (rule["valid_from"] and row["loaddate"] < rule["valid_from"]) \
            or (rule["valid_to"] and row["loaddate"] > rule["valid_to"]):
        return False
    for part in RU.EQUAL:
        if rule[part] is not None and row[part] is not None:
            same = row[part] == rule[part] if part == "scope" else norm(row[part]) == norm(rule[part])
            if not same:
                return False
    return all(rule[p] is None or row[c] is None or like(row[c], rule[p]) for p, c in RU.LIKE.items())


def plain(rows, rules, test):
    days = {d for d in (r["loaddate"] for r in rows)}
    return sorted(r["id"] for r in rows if r["loaddate"] in days and r["loaddate"].weekday() < 5
                  and not any(excluded(r, x, test) for x in rules))


def make(seed, n_rows, n_rules):
    rnd = random.Random(seed)
    values = {"scope": ["one", "six"], "contract_number": ["C1", "c2 ", ""], "side": ["Purchase", "Sale", "NA"],
              "commodity": ["Corn", "CORN  ", "Wheat"], "location": ["L1", "l2"], "desk": ["Desk A", "desk_b", "50% off"],
              "sub_location": ["red plate", "Hot Ring"], "position_type": ["STD", "alt"]}
    rows = [{"id": i, "loaddate": DAY + dt.timedelta(days=rnd.randrange(40)),
             **{p: rnd.choice([*v, None] if p != "scope" else v) for p, v in values.items()}} for i in range(n_rows)]
    rules = []
    for _ in range(n_rules):
        a, b = (rnd.choice([None, DAY + dt.timedelta(days=rnd.randrange(40))]) for _ in range(2))
        rule = dict.fromkeys(RU.RULE_SCHEMA.fieldNames()) | {"test": rnd.choice(["tenor", "high"]), "valid_from": a, "valid_to": b}
        for p in rnd.sample(list(values), rnd.randint(1, 4)):
            rule[p] = rnd.choice(values[p]).upper() if p != "scope" else rnd.choice(values[p])
        if rnd.random() < 0.3:
            rule["desk_like"] = rnd.choice(["%desk%", "DESK__", "50\\%%", "%", "desk\\_b"])
        rules.append(rule)
    return rows, rules


def run(spark, rows, rules, test):
    df = frame(spark, rows)
    table = spark.createDataFrame([Row(**r) for r in rules], RU.RULE_SCHEMA) if rules else spark.createDataFrame([], RU.RULE_SCHEMA)
    days = spark.createDataFrame([(r["loaddate"],) for r in rows] * 2 + [(None,)], "workday date")
    out = RU.exclude_by_rules(df, table, test, days)
    assert out.columns == df.columns
    return sorted(r.id for r in out.collect())


@pytest.mark.parametrize("seed,n_rules", [(1, 0), (2, 1), (3, 5), (4, 12), (5, 70)])
def test_rules_equal_one_by_one_evaluation(spark, seed, n_rules):
    rows, rules = make(seed, 400, n_rules)
    for test in ("tenor", "high"):
        assert run(spark, rows, rules, test) == plain(rows, rules, test)


def test_groups_of_rules(spark, monkeypatch):
    monkeypatch.setattr(RU, "GROUP_RULES", 3)
    monkeypatch.setattr(RU, "_BITS", 2)
    rows, rules = make(6, 300, 10)
    assert run(spark, rows, rules, "high") == plain(rows, rules, "high")


def test_validity_is_inclusive_and_may_be_empty(spark):
    rows = [{"id": i, "scope": "one", "loaddate": DAY + dt.timedelta(days=i), **dict.fromkeys(RU.EQUAL[1:])} for i in range(5)]
    blank = dict.fromkeys(RU.RULE_SCHEMA.fieldNames()) | {"test": "high"}
    span = blank | {"valid_from": DAY + dt.timedelta(days=1), "valid_to": DAY + dt.timedelta(days=2)}
    assert run(spark, rows, [span], "high") == [0, 3, 4]
    assert run(spark, rows, [span | {"valid_from": DAY + dt.timedelta(days=3)}], "high") == [0, 1, 2, 3, 4]   # ends before it starts
    assert run(spark, rows, [blank | {"valid_to": dt.date.max, "scope": "six"}], "high") == [0, 1, 2, 3, 4]
    assert run(spark, rows, [blank | {"valid_from": DAY + dt.timedelta(days=4)}], "high") == [0, 1, 2, 3]


def test_tuple_rules_as_rows_give_the_same_positions(spark):
    i = load_inputs(spark, SF_SMALL)
    r = i.rules
    table = RU.rule_rows(spark, r.positions)
    key = lambda t: tuple(map(str, t))
    for test, scopes, since in (("tenor", r.positions.tenor_scopes, r.since), ("high", r.positions.high_scopes, r.high_since)):
        rows = P.scoped_positions(i.positions, i.position_dims, scopes, since, r.positions.desk_sources)
        cols = ["scope", "loaddate", "commodity", "desk", "delta", "contract_number", "sub_location"]
        a = sorted(map(tuple, P.exclude(rows, r.positions, test).select(cols).collect()), key=key)
        b = sorted(map(tuple, RU.exclude_by_rules(rows, table, test, i.position_dims.workdays).select(cols).collect()), key=key)
        assert a == b and 0 < len(a) < rows.count()


def test_positions_are_read_once_and_not_shuffled(spark):
    i = load_inputs(spark, SF_SMALL)
    r = i.rules
    rows = i.positions.withColumns({"scope": F.col("source"), "location": F.col("sub_location"), "desk": F.col("trader_raw")})
    text = formatted(RU.exclude_by_rules(rows, RU.rule_rows(spark, r.positions), "high", i.position_dims.workdays))
    assert text.count("positions-") == 1
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "SortMergeJoin" not in text
    # the only exchange deals calendar days
    assert all("workday" in x or "_day" in x for x in re.findall(r"Exchange hashpartitioning\(([^,]*)", text))


@pytest.mark.parametrize("pattern,text,hit", [("a%", "Abc", True), ("a_c", "abc", True), ("a_c", "ac", False), ("%.x", "a.x", True),
                                              ("%.x", "abx", False), ("50\\%", "50%", True), ("50\\%", "50x", False), ("%", "", True),
                                              ("a%", "a\nb", True)])
def test_like_as_a_regular_expression(spark, pattern, text, hit):
    assert like(text, pattern) == hit
    row = spark.createDataFrame([(text,)], "t string").select(F.lower("t").like(pattern).alias("a"),
                                                              F.lower("t").rlike(RU.like_regex(pattern)).alias("b")).first()
    assert row.a == row.b == hit
