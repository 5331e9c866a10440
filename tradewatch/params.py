"""Limits, scopes and exclusions held as data.

Every literal the surveillance tests compare against lives here, not in the
operators. A :class:`RuleSet` bundles them; :func:`testdata_rules` maps the
rules onto the driver's synthetic tables (see ``sources.testdata``).

Site-specific values (desk names, account codes, one-off contract rules,
people) are deliberately *not* shipped: a deployment passes them in as a
``RuleSet`` of its own.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

# --- fixed values: they must equal the original job's for the same results --
TENOR_SHARE_LIMIT = 0.2          # tenor break if share beyond horizon > 0.2
TENOR_HORIZON_MONTHS = 12        # contract month beyond load month + 12
DAY_TRADE_QTY_LIMIT = 100.0      # day-trade break if matched qty > 100
NEW_HIGH_WINDOW = 252            # rows in the rolling new-high window
BAND_WINDOW = 75                 # rows in the (retired) mean + k*std band test
BAND_K = 2.0
LOOKBACK_DAYS = 260              # calendar days read before `since` for new highs
ROUND_DIGITS = 5                 # numpy-style half-even rounding of daily volume
WEEKEND_DAYS = (1, 7)            # dayofweek(): 1 = Sunday, 7 = Saturday
SIDES = ("Purchase", "Sale", "NA")   # pivot columns, in this order
NET_SIDE = "NA"                  # inventory side: signed delta, not |delta|
TEST_TENOR = "tenor breaks"
TEST_DAY_TRADE = "day trade breaks"
TEST_NEW_HIGH = "PnS breaks"
BUY_CODE = "B"
SELL_CODE = "S"
# source system -> source id in the account map; other sources map to "0"
SOURCE_IDS = (("FMT", "3"), ("WFC", "67"))
MAPPED_SOURCE_IDS = ("67", "3")
UNMAPPED_SOURCE_ID = "0"
EXCLUDED_COMMENT_CODES = ("K", "I", " I")
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Scope:
    """One population of positions tested together.

    Membership is ``division`` (optionally minus ``exclude_subdivisions``) or
    ``include_subdivisions``. The other fields switch scope-specific rules.
    """

    name: str
    division: str | None = None
    include_subdivisions: tuple[str, ...] | None = None
    exclude_subdivisions: tuple[str, ...] = ()
    exclude_position_type: bool = False
    exclude_holidays: bool = False
    desk_column: str = "desk"      # column the desk exclusion list applies to


@dataclass(frozen=True)
class OneOffRule:
    """Drop rows where every given part matches: ``NOT (a AND b AND ...)``.

    Unset parts (None) are left out of the conjunction. SQL three-valued
    logic is kept, so a null in a compared column drops the row.
    """

    contract_number: str | None = None
    loaddate: str | None = None
    side: str | None = None
    commodity: str | None = None
    location: str | None = None
    desk: str | None = None
    desk_like: str | None = None


@dataclass(frozen=True)
class PositionRules:
    desk_sources: tuple[str, ...]              # books whose trader names the desk
    excluded_commodities: tuple[str, ...]
    holidays: tuple[str, ...]
    excluded_position_type: str
    excluded_desks: tuple[str, ...]
    tenor_sub_locations: tuple[str, ...]
    tenor_sub_location_like: tuple[str, ...]
    high_sub_locations: tuple[str, ...]
    high_contracts: tuple[str, ...]
    one_offs: tuple[OneOffRule, ...]
    tenor_scopes: tuple[Scope, ...]
    high_scopes: tuple[Scope, ...]


@dataclass(frozen=True)
class FillRules:
    excluded_accounts: tuple[str, ...]
    excluded_account_like: tuple[str, ...]
    excluded_subdivision_like: tuple[str, ...]
    excluded_broker: str
    excluded_card: str
    excluded_source: str
    excluded_account_names: tuple[str, ...]
    blocked_commodity_group: tuple[str, str]   # (commodity, group) pair dropped
    blocked_location_like: str
    excluded_day_trade_commodity: str          # compared case-sensitively
    excluded_day_trade_subdivisions: tuple[str, ...] = ()   # empty = keep all


@dataclass(frozen=True)
class RuleSet:
    since: dt.date
    positions: PositionRules
    fills: FillRules
    tenor_share_limit: float = TENOR_SHARE_LIMIT
    tenor_horizon_months: int = TENOR_HORIZON_MONTHS
    day_trade_limit: float = DAY_TRADE_QTY_LIMIT
    new_high_window: int = NEW_HIGH_WINDOW
    band_window: int = BAND_WINDOW
    band_k: float = BAND_K
    lookback_days: int = LOOKBACK_DAYS
    # Split each new-high series into row chunks of this size (with a halo);
    # None = one window partition per series.
    series_chunk_rows: int | None = 10_000
    # Last load day of the feed (None: no end).
    until: dt.date | None = None

    @property
    def high_since(self) -> dt.date:
        """New highs read `lookback_days` calendar days before `since`."""
        return self.since - dt.timedelta(days=self.lookback_days)

    def with_(self, **kw) -> RuleSet:
        return replace(self, **kw)


def _scopes(test: str, division: str, division_minus: tuple[str, ...],
            six: tuple[str, ...], three: tuple[str, ...], one: tuple[str, ...]):
    """The four populations of each test and their switches (scope matrix)."""
    if test == "tenor":
        return (
            Scope("division", division=division, exclude_subdivisions=division_minus,
                  exclude_position_type=True, exclude_holidays=True, desk_column="location"),
            Scope("six", include_subdivisions=six, exclude_position_type=True,
                  desk_column="desk"),
            Scope("three", include_subdivisions=three, desk_column="location"),
            Scope("one", include_subdivisions=one, desk_column="desk"),
        )
    return (
        Scope("six", include_subdivisions=six, exclude_holidays=True),
        Scope("division", division=division, exclude_subdivisions=division_minus),
        Scope("three", include_subdivisions=three),
        Scope("one", include_subdivisions=one),
    )


def testdata_rules(since: str = "1996-01-01") -> RuleSet:
    """Rules over the driver's synthetic tables (values are synthetic).

    Spellings differ in case from the data on purpose in places ('Africa',
    'Promo', '4-not spec') to exercise the case-insensitive SQL layer.
    """
    division = "Africa"
    division_minus = ("NATION_0",)
    six = ("NATION_1", "NATION_2", "NATION_3", "NATION_6", "NATION_7", "NATION_8")
    three = ("NATION_4", "NATION_9", "NATION_14")
    one = ("NATION_0",)
    positions = PositionRules(
        desk_sources=("F", "P"),
        excluded_commodities=("Promo", "No Such Type", ""),
        holidays=("1996-12-25", "1997-07-04", "1998-12-25"),
        excluded_position_type="ALT",
        excluded_desks=("Supplier#000000003", "Supplier#000000007", "Supplier#000000011",
                        "Supplier#000000019", "Supplier#000000023", "2-HIGH",
                        "4-not spec", "No Such Desk"),
        tenor_sub_locations=("red plate", "small widget", "hot ring"),
        tenor_sub_location_like=("%gizmo%",),
        high_sub_locations=("red plate", "small widget", "hot ring", "hot plate",
                            "large rod", "old rod", "blue ring", "red widget"),
        high_contracts=("C7",),
        one_offs=(
            OneOffRule(contract_number="", loaddate="1997-03-04", commodity="economy",
                       location="Supplier#000000001"),
            OneOffRule(loaddate="1996-05-06", side="Purchase", commodity="Large",
                       location="Supplier#000000002"),
            OneOffRule(loaddate="1997-09-29", side="Purchase", commodity="medium",
                       desk_like="%urgent%"),
            OneOffRule(loaddate="1998-02-10", side="Sale", commodity="small",
                       desk="1-URGENT"),
            OneOffRule(contract_number="C1000", loaddate="1997-01-02", side="Purchase",
                       commodity="standard", location="Supplier#000000004"),
            OneOffRule(loaddate="1999-06-15", side="NA", commodity="Economy",
                       desk="Supplier#000000005"),
        ),
        tenor_scopes=_scopes("tenor", division, division_minus, six, three, one),
        high_scopes=_scopes("high", division, division_minus, six, three, one),
    )
    fills = FillRules(
        excluded_accounts=("AC01", "AC02", "AC03", "AC04"),
        excluded_account_like=("AC3%",),
        excluded_subdivision_like=("SUB_4%",),
        excluded_broker="BR0",
        excluded_card="CD0",
        excluded_source="SX0",
        excluded_account_names=("HOLDER 8", "HOLDER 9", "HOLDER X"),
        blocked_commodity_group=("Economy", "Europe Group"),
        blocked_location_like="%ation_7%",
        excluded_day_trade_commodity="asia group",
    )
    return RuleSet(since=dt.date.fromisoformat(since), positions=positions, fills=fills)


def overlapping_rules(since: str = "1996-01-01") -> RuleSet:
    """The same rules with a division scope that keeps the subdivision which has a scope of its own, so that
    rows belong to two scopes."""
    r = testdata_rules(since)
    p = r.positions

    def whole(scopes: tuple[Scope, ...]) -> tuple[Scope, ...]:
        return tuple(replace(s, exclude_subdivisions=()) for s in scopes)

    return r.with_(positions=replace(p, tenor_scopes=whole(p.tenor_scopes), high_scopes=whole(p.high_scopes)))


#: Dated rules over the driver's tables, as rows of ``operators.rules.RULE_SCHEMA``: (test, valid from, valid to, parts).
#: The first six are one-offs that each drop rows; the others open, close and overlap in time.
DATED_RULES = (
    ("high", "1996-01-15", "1996-12-20", {"commodity": "Economy", "side": "purchase", "location": "Supplier#000000001"}),
    ("high", "1996-03-01", "1998-01-31", {"commodity": "large", "side": "Sale ", "desk_like": "%urgent%"}),
    ("high", None, "1997-06-30", {"commodity": "medium", "desk": "1-URGENT", "scope": "six"}),
    ("high", "1997-01-02", None, {"commodity": "small", "side": "NA", "sub_location_like": "%ring%"}),
    ("high", "1996-06-03", "1996-06-28", {"scope": "division"}),
    ("high", "1997-09-01", "1997-10-15", {"position_type": "STD", "side": "Purchase"}),
    ("high", "1997-10-01", "1997-12-31", {"position_type": "std", "side": "purchase", "scope": "three"}),
    ("tenor", "1996-07-01", "1997-06-30", {"commodity": "Economy"}),
    ("tenor", "1997-07-01", "1997-07-31", {"desk_like": "3-%"}),
)
