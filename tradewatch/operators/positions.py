"""Position-side operators: scopes, exclusions, desk, tenor flag, sums.

One scan of the position fact serves every scope of a test: each row is
tagged with the scopes it belongs to (``explode`` of the matching scope
names), so a row in two scopes becomes two rows, exactly as if the scope
extracts had been run separately and appended.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.functions import (
    beyond_horizon,
    in_text,
    not_in_text,
    same_text,
)
from tradewatch.functions.text import (
    ilike_any_sql,
    in_text_sql,
    not_in_text_sql,
    same_text_sql,
    sql_str,
)
from tradewatch.params import WEEKEND_DAYS
from tradewatch.params import NET_SIDE, OneOffRule, PositionRules, Scope
from tradewatch.schemas import PositionDims

SERIES_KEYS = ["loaddate", "poscommodity", "trader", "subdivision"]


def resolve_desk(source: Column | str, trader: Column | str, location: Column | str,
                 book_sources: Sequence[str]) -> Column:
    """Desk = first 10 characters of the trader for trader-level books with a
    non-blank trader; otherwise the location. A null trader falls through to
    the location (``null NOT IN ('')`` is not true)."""
    trader = F.col(trader) if isinstance(trader, str) else trader
    location = F.col(location) if isinstance(location, str) else location
    named = in_text(source, book_sources) & not_in_text(trader, [""])
    return F.when(named, F.substring(trader, 1, 10)).otherwise(location)


def attach_dims(positions: DataFrame, dims: PositionDims) -> DataFrame:
    """Location -> subdivision -> division, left joins on codes (broadcast
    when Spark knows their bytes to be few, shuffled otherwise)."""
    return (positions
            .join(dims.locations, "location_code", "left")
            .join(dims.subdivisions, "subdivision_code", "left")
            .join(dims.divisions, "division_code", "left"))


def on_workdays(df: DataFrame, workdays: DataFrame) -> DataFrame:
    """Keep rows whose load date is a workday (semi join on distinct days, so
    a repeated calendar day cannot duplicate rows)."""
    days = workdays.select(F.col("workday").alias("loaddate")).distinct()
    return df.join(days, "loaddate", "left_semi")


def scope_member(scope: Scope) -> str:
    """Membership of `scope` as a SQL predicate."""
    if scope.include_subdivisions is not None:
        return in_text_sql("subdivision", scope.include_subdivisions)
    cond = same_text_sql("division", scope.division)
    if scope.exclude_subdivisions:
        cond += " AND " + not_in_text_sql("subdivision", scope.exclude_subdivisions)
    return cond


def scoped_positions(positions: DataFrame, dims: PositionDims, scopes: Sequence[Scope],
                     since: dt.date, book_sources: Sequence[str]) -> DataFrame:
    """Position rows after `since`, on workdays, dims attached, one row per
    matching scope (column ``scope``), desk resolved (column ``desk``)."""
    rows = positions.where(F.col("loaddate") > F.lit(since))
    rows = on_workdays(attach_dims(rows, dims), dims.workdays)
    # One slot per scope, null when the row is not a member; explode + IS NOT
    # NULL stays inside whole-stage codegen (a lambda filter would not).
    names = F.expr("array(" + ", ".join(
        f"CASE WHEN {scope_member(s)} THEN {sql_str(s.name)} END" for s in scopes) + ")")
    return (rows
            .withColumn("scope", F.explode(names))
            .where(F.col("scope").isNotNull())
            .withColumn("desk", resolve_desk("source", "trader_raw", "location", book_sources)))


def _dates_sql(days: Sequence[str]) -> str:
    return ", ".join(f"DATE {sql_str(dt.date.fromisoformat(d).isoformat())}" for d in days)


def one_off_keep(rule: OneOffRule) -> str:
    """``NOT (a AND b AND ...)`` over the parts the rule sets, as SQL."""
    parts = []
    if rule.contract_number is not None:
        parts.append(same_text_sql("contract_number", rule.contract_number))
    if rule.loaddate is not None:
        parts.append(f"loaddate = {_dates_sql([rule.loaddate])}")
    if rule.side is not None:
        parts.append(same_text_sql("side", rule.side))
    if rule.commodity is not None:
        parts.append(same_text_sql("commodity", rule.commodity))
    if rule.location is not None:
        parts.append(same_text_sql("location", rule.location))
    if rule.desk is not None:
        parts.append(same_text_sql("desk", rule.desk))
    if rule.desk_like is not None:
        parts.append(ilike_any_sql("desk", [rule.desk_like]))
    return "NOT (" + " AND ".join(parts) + ")" if parts else "TRUE"


def exclude(df: DataFrame, rules: PositionRules, test: str) -> DataFrame:
    """Weekend, holiday, commodity, sub-location, contract, desk and one-off
    exclusions of `test` ('tenor' or 'high') on scope-tagged rows.

    The rules become two SQL predicates (common ones, then a CASE on the
    scope), with SQL's null logic: a comparison with null drops the row."""
    weekend = ", ".join(str(d) for d in WEEKEND_DAYS)
    common = [f"NOT dayofweek(loaddate) IN ({weekend})",
              not_in_text_sql("commodity", rules.excluded_commodities)]
    if test == "tenor":
        scopes = rules.tenor_scopes
        common += [not_in_text_sql("sub_location", rules.tenor_sub_locations),
                   f"NOT {ilike_any_sql('sub_location', rules.tenor_sub_location_like)}"]
    else:
        scopes = rules.high_scopes
        common += [not_in_text_sql("contract_number", rules.high_contracts),
                   not_in_text_sql("sub_location", rules.high_sub_locations)]
        common += [one_off_keep(r) for r in rules.one_offs]

    def scope_rule(s: Scope) -> str:
        c = [not_in_text_sql(s.desk_column, rules.excluded_desks)]
        if s.exclude_position_type:
            c.append(f"NOT {same_text_sql('position_type', rules.excluded_position_type)}")
        if s.exclude_holidays and rules.holidays:
            c.append(f"NOT loaddate IN ({_dates_sql(rules.holidays)})")
        return " AND ".join(f"({x})" for x in c)

    per_scope = ("CASE " + " ".join(f"WHEN scope = {sql_str(s.name)} THEN {scope_rule(s)}"
                                    for s in scopes) + " ELSE FALSE END")
    return df.where(" AND ".join(f"({x})" for x in common)).where(per_scope)


def tenor_rows(positions: DataFrame, dims: PositionDims, rules: PositionRules,
               since: dt.date, horizon_months: int) -> DataFrame:
    rows = scoped_positions(positions, dims, rules.tenor_scopes, since, rules.desk_sources)
    return (exclude(rows, rules, "tenor")
            .withColumn("beyond_twelve_months",
                        beyond_horizon("loaddate", "contract_month", horizon_months)))


def high_rows(positions: DataFrame, dims: PositionDims, rules: PositionRules,
              since: dt.date) -> DataFrame:
    rows = scoped_positions(positions, dims, rules.high_scopes, since, rules.desk_sources)
    return exclude(rows, rules, "high")


def tenor_exposure(rows: DataFrame) -> DataFrame:
    """Σ|delta| per (date, commodity, desk, subdivision, beyond flag).

    Scope copies of a row are all summed (overlapping scopes count twice)."""
    return (rows.groupBy(
                "loaddate", F.col("commodity").alias("poscommodity"),
                F.col("desk").alias("trader"), "subdivision", "beyond_twelve_months")
            .agg(F.sum(F.abs("delta")).cast("double").alias("abs_st")))


def side_volume(rows: DataFrame) -> DataFrame:
    """Per scope and (date, commodity, desk, side, subdivision):
    Σ delta for the inventory side, Σ|delta| for purchases and sales."""
    v = F.when(same_text("side", NET_SIDE), F.col("delta")).otherwise(F.abs("delta"))
    return (rows.groupBy(
                "scope", "loaddate", F.col("commodity").alias("poscommodity"),
                F.col("desk").alias("trader"), F.col("side").alias("pors"), "subdivision")
            .agg(F.sum(v).cast("double").alias("abs_st")))
