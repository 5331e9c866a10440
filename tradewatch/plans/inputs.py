"""Load the inputs of one run from a directory of driver tables."""

from __future__ import annotations

import threading
from dataclasses import dataclass, field, fields, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tradewatch.operators import daytrades
from tradewatch.params import RuleSet, testdata_rules
from tradewatch.schemas import (
    FILLS_SCHEMA,
    POSITIONS_SCHEMA,
    WORKDAYS_SCHEMA,
    FillDims,
    PositionDims,
)
from tradewatch.session import shared_dir
from tradewatch.sources import testdata
from tradewatch.sources.fill_view import FillView
from tradewatch.sources.store import table_key, written_table
from tradewatch.sources.tables import read_input


# One build of a view at a time within a process (queries may run in threads).
_VIEW_LOCK = threading.Lock()


def _src(sf_dir: str, *names: str) -> list[str]:
    return [f"{sf_dir.rstrip('/')}/{n}.parquet" for n in names]


@dataclass
class Inputs:
    """The run's inputs, each built on first use (a query that reads only
    positions never plans the fill side). Fields given explicitly win."""

    spark: SparkSession
    sf_dir: str
    rules: RuleSet = field(default_factory=testdata_rules)
    write_facts: bool = True
    given: dict = field(default_factory=dict)

    @cached_property
    def positions(self) -> DataFrame:
        if "positions" in self.given:
            return self.given["positions"]
        if not self.write_facts:
            return testdata.positions(self.spark, self.sf_dir)
        return written_table(
            self.spark, "positions", lambda: testdata.positions(self.spark, self.sf_dir),
            _src(self.sf_dir, "lineitem", "orders", "part"), "loaddate", POSITIONS_SCHEMA)

    @cached_property
    def fills(self) -> DataFrame:
        if "fills" in self.given:
            return self.given["fills"]
        if not self.write_facts:
            return testdata.fills(self.spark, self.sf_dir)
        return written_table(
            self.spark, "fills", lambda: testdata.fills(self.spark, self.sf_dir),
            _src(self.sf_dir, "events", "part"), "load_date", FILLS_SCHEMA)

    @cached_property
    def fill_groups(self) -> DataFrame:
        """Sums of the fills after the rules' since-date: from the kept view, which is summed once and
        brought up to date by day; lazily from the fills where these are given or not written."""
        if "fills" in self.given or not self.write_facts:
            return daytrades.fill_groups(self.fills, self.rules.fills)
        key = table_key(self.spark, "fills", _src(self.sf_dir, "events", "part"), FILLS_SCHEMA)
        view = FillView(self.spark, f"{shared_dir(self.spark).rstrip('/')}/tradewatch/views/{key}", self.rules.fills)
        with _VIEW_LOCK:
            if not view.table.versions():
                view.build(self.fills, "build")
        return view.groups(self.rules.since)

    @cached_property
    def position_dims(self) -> PositionDims:
        if "position_dims" in self.given:
            return self.given["position_dims"]
        dims = testdata.position_dims(self.spark, self.sf_dir)
        if not self.write_facts:
            return dims
        # The calendar is derived from the order table: write it once (one
        # small file) instead of scanning all orders in every query.
        days = written_table(
            self.spark, "workdays", lambda: dims.workdays, _src(self.sf_dir, "orders"),
            "workday", WORKDAYS_SCHEMA, files=1)
        return replace(dims, workdays=days)

    @cached_property
    def fill_dims(self) -> FillDims:
        return self.given.get("fill_dims") or testdata.fill_dims(self.spark, self.sf_dir)

    def with_rules(self, rules: RuleSet) -> Inputs:
        """Same inputs (already built members reused), other rules."""
        out = replace(self, rules=rules)
        for k in ("positions", "fills", "position_dims", "fill_dims"):
            if k in self.__dict__:
                out.__dict__[k] = self.__dict__[k]
        return out

    def with_positions(self, positions: DataFrame) -> Inputs:
        out = self.with_rules(self.rules)
        out.__dict__["positions"] = positions
        return out


def source_inputs(spark: SparkSession, sources: dict[str, object], rules: RuleSet) -> Inputs:
    """Inputs read from production sources (``tables.read_input``): ``positions`` and ``fills``, and the
    dimensions by "group.member", such as ``position_dims.locations``. Sources planned by day are read from the
    rules' look-back on."""
    def read(name: str, schema=None, since=None) -> DataFrame:
        return read_input(spark, sources[name], schema, since)

    given: dict = {}
    if "positions" in sources:
        given["positions"] = read("positions", POSITIONS_SCHEMA, min(rules.high_since, rules.since))
    if "fills" in sources:
        given["fills"] = read("fills", FILLS_SCHEMA, rules.since)
    for group, kind in (("position_dims", PositionDims), ("fill_dims", FillDims)):
        names = [f.name for f in fields(kind)]
        if all(f"{group}.{n}" in sources for n in names):
            given[group] = kind(**{n: read(f"{group}.{n}") for n in names})
    return Inputs(spark, "", rules, given=given)


def load_inputs(spark: SparkSession, sf_dir: str, rules: RuleSet | None = None,
                write_facts: bool = True) -> Inputs:
    """Inputs over the driver tables in `sf_dir`. With `write_facts` the two
    derived fact tables are written once to the shared folder and read from
    there; otherwise they stay lazy views. Dimensions are always views.

    Timestamps are read as timestamp_ntz, so no result depends on the
    session time zone (the caller's session is left as it is)."""
    return Inputs(spark, sf_dir, rules or testdata_rules(), write_facts)
