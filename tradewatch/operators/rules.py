"""Exclusion rules as a dated table: what is excluded changes by rows, not by code.

A rule (``RULE_SCHEMA``) holds from `valid_from` to `valid_to` (null: open), for one test and one scope (null:
all), and names any of its parts: texts that a column must equal, or LIKE patterns that it must match. A position is
excluded where a rule holds on its load date and none of the rule's parts is false; as in the SQL it replaces
(``NOT (a AND b)``, ``NOT IN``), a part compared with a null is not false. A rule without parts excludes its days.

Plan. Rules are numbered and each is a bit. For each part one small table gives the bits of the rules that a value
meets, joined by equality; the days of the calendar are placed into the intervals between the rules' dates
once, and joined by day; LIKE lists are looked at only where one expression of all their patterns finds
something. What is left is an AND of 64-bit words. The cost of a position grows with the number of parts and words,
not with the number of rules; the position table is read once and not shuffled.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.functions import norm
from tradewatch.params import WEEKEND_DAYS, PositionRules, Scope

EQUAL = ("scope", "contract_number", "side", "commodity", "location", "desk", "sub_location", "position_type")
LIKE = {"desk_like": "desk", "sub_location_like": "sub_location"}
RULE_SCHEMA = T.StructType(
    [T.StructField("test", T.StringType()), T.StructField("valid_from", T.DateType()), T.StructField("valid_to", T.DateType())]
    + [T.StructField(c, T.StringType()) for c in (*EQUAL, *LIKE)])
#: Rules that are decided together (more are decided group after group).
GROUP_RULES = 512
_BITS = 63          # of a word: the sign is left alone


def rule_rows(spark: SparkSession, rules: PositionRules) -> DataFrame:
    """The rules of a ``PositionRules`` as rows."""
    blank = dict.fromkeys(RULE_SCHEMA.fieldNames())
    rows: list[dict] = []

    def add(test: str, **parts) -> None:
        rows.append({**blank, "test": test, **parts})

    def scope_rules(test: str, scopes: tuple[Scope, ...]) -> None:
        for v in rules.excluded_commodities:
            add(test, commodity=v)
        for s in scopes:
            for v in rules.excluded_desks:
                add(test, scope=s.name, **{s.desk_column: v})
            if s.exclude_position_type:
                add(test, scope=s.name, position_type=rules.excluded_position_type)
            for day in rules.holidays if s.exclude_holidays else ():
                add(test, scope=s.name, valid_from=dt.date.fromisoformat(day), valid_to=dt.date.fromisoformat(day))

    scope_rules("tenor", rules.tenor_scopes)
    scope_rules("high", rules.high_scopes)
    for v in rules.tenor_sub_locations:
        add("tenor", sub_location=v)
    for v in rules.tenor_sub_location_like:
        add("tenor", sub_location_like=v)
    for v in rules.high_contracts:
        add("high", contract_number=v)
    for v in rules.high_sub_locations:
        add("high", sub_location=v)
    for o in rules.one_offs:
        day = dt.date.fromisoformat(o.loaddate) if o.loaddate else None
        add("high", valid_from=day, valid_to=day, contract_number=o.contract_number, side=o.side, commodity=o.commodity,
            location=o.location, desk=o.desk, desk_like=o.desk_like)
    return spark.createDataFrame([Row(**r) for r in rows], RULE_SCHEMA) if rows else spark.createDataFrame([], RULE_SCHEMA)


def _words(ids: list[int], n: int) -> list[int]:
    """The bits of `ids` as words for `n` rules."""
    out = [0] * -(-n // _BITS)
    for i in ids:
        out[i // _BITS] |= 1 << (i % _BITS)
    return out


def _small(spark: SparkSession, key: str, keys: pa.Array, names: list[str], words: list[list[int]]) -> DataFrame:
    """A key with its words. From Arrow, so that Spark knows how few bytes it has and broadcasts it by its own threshold."""
    return spark.createDataFrame(pa.table({key: keys, **{n: pa.array([w[i] for w in words], pa.int64()) for i, n in enumerate(names)}}))


def _key(v: str) -> str:
    return v.rstrip(" ").lower()


def like_regex(pattern: str) -> str:
    """A LIKE pattern as a regular expression for whole, lower-cased text."""
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i].lower()
        if c == "\\" and i + 1 < len(pattern):
            i += 1
            out += re.escape(pattern[i].lower())
        else:
            out += {"%": "(?s:.*)", "_": "(?s:.)"}.get(c, re.escape(c))
        i += 1
    return f"^{out}$"


@dataclass(frozen=True)
class _Group:
    """Up to GROUP_RULES rules of one test, numbered."""

    rules: list[Row]

    @property
    def n_words(self) -> int:
        return -(-len(self.rules) // _BITS)

    def names(self, part: str) -> list[str]:
        return [f"_{part}_{w}" for w in range(self.n_words)]

    def bits(self, ids: list[int]) -> list[int]:
        return _words(ids, len(self.rules))

    def lookup(self, spark: SparkSession, part: str) -> DataFrame | None:
        """(value, words): the rules that each value of a part meets; None where no rule has the part."""
        by_value: dict[str, list[int]] = {}
        for i, r in enumerate(self.rules):
            if r[part] is not None:
                by_value.setdefault(r[part] if part == "scope" else _key(r[part]), []).append(i)
        if not by_value:
            return None
        return _small(spark, f"_{part}", pa.array(list(by_value), pa.string()), self.names(part),
                      [self.bits(ids) for ids in by_value.values()])

    def free(self, part: str) -> list[int]:
        return self.bits([i for i, r in enumerate(self.rules) if r[part] is None])

    def days(self, calendar: DataFrame) -> DataFrame:
        """(day, words): the rules that hold on each day. The rules' dates cut time into intervals, each with its
        words; a day's interval is the number of cuts up to it."""
        spark, day = calendar.sparkSession, dt.timedelta(days=1)
        cuts = sorted({r["valid_from"] for r in self.rules if r["valid_from"]}
                      | {r["valid_to"] + day for r in self.rules if r["valid_to"] and r["valid_to"] < dt.date.max})
        inside = []
        for at in [dt.date.min, *cuts]:
            inside.append(self.bits([i for i, r in enumerate(self.rules)
                                     if (r["valid_from"] or dt.date.min) <= at <= (r["valid_to"] or dt.date.max)]))
        names = self.names("day")
        intervals = _small(spark, "_interval", pa.array(range(len(inside)), pa.int32()), names, inside)
        place = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("_day"))) if cuts else F.lit(0)
        every = calendar.select(F.col("workday").alias("_day")).where(F.col("_day").isNotNull()).distinct()
        return every.withColumn("_interval", place.cast("int")).join(intervals, "_interval").select("_day", *names)

    def like_words(self, part: str, column: str) -> list[Column] | None:
        """The words of a row's LIKE matches: the rules are looked at where any pattern matches."""
        with_part = [(i, r[part]) for i, r in enumerate(self.rules) if r[part] is not None]
        if not with_part:
            return None
        patterns: dict[str, list[int]] = {}
        for i, p in with_part:
            patterns.setdefault(p.lower(), []).append(i)
        text, out, free = F.lower(F.col(column)), [], self.free(part)
        any_of = "|".join(f"(?:{like_regex(p)})" for p in patterns)
        for w in range(self.n_words):
            met = [F.when(text.like(p), F.lit(self.bits(ids)[w])).otherwise(F.lit(0).cast("long")) for p, ids in patterns.items()]
            hit = reduce(lambda a, b: a.bitwiseOR(b), met)
            own = F.when(text.rlike(any_of), hit).otherwise(F.lit(0).cast("long"))
            out.append(F.when(text.isNull(), F.lit(-1).cast("long")).otherwise(own.bitwiseOR(F.lit(free[w]))))
        return out


def exclude_by_rules(rows: DataFrame, rules: DataFrame, test: str, calendar: DataFrame) -> DataFrame:
    """The scope-tagged rows that no rule of `test` excludes, weekends left out.

    `calendar` (column ``workday``) holds the rows' days; rows of other days are no workday's and go.
    The rules, a table that people keep, come to the driver; positions do not."""
    found = rules.where(F.col("test") == test).collect()
    out = rows.where(~F.dayofweek("loaddate").isin(list(WEEKEND_DAYS)))
    for start in range(0, len(found), GROUP_RULES):
        out = _exclude_group(out, _Group(found[start:start + GROUP_RULES]), calendar)
    return out


def _exclude_group(rows: DataFrame, group: _Group, calendar: DataFrame) -> DataFrame:
    spark, kept = rows.sparkSession, rows.columns
    out = rows.join(group.days(calendar), F.col("loaddate") == F.col("_day"))
    words = [[F.col(c)] for c in group.names("day")]
    for part in EQUAL:
        table = group.lookup(spark, part)
        if table is None:
            continue
        value = F.col(part) if part == "scope" else norm(part)
        out = out.withColumn(f"_{part}_value", value).join(table, F.col(f"_{part}_value") == F.col(f"_{part}"), "left")
        for w, (name, free) in enumerate(zip(group.names(part), group.free(part))):
            met = F.coalesce(F.col(name), F.lit(0).cast("long")).bitwiseOR(F.lit(free))
            words[w].append(F.when(F.col(part).isNull(), F.lit(-1).cast("long")).otherwise(met))
    for part, column in LIKE.items():
        for w, met in enumerate(group.like_words(part, column) or []):
            words[w].append(met)
    excluded = reduce(lambda a, b: a | b, [reduce(lambda a, b: a.bitwiseAND(b), w) != 0 for w in words])
    return out.where(~excluded).select(*kept)
