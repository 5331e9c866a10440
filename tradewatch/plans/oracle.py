"""Oracle SQL (DuckDB) for every registered query.

Written the way the original extracts were: one SELECT per scope appended
with UNION ALL, the tenor share through a self-join of the beyond-horizon
subset, the day-trade skeleton as a real cross join. Only the rule values
are taken from the same ``RuleSet``; the logic is independent of the Spark
plans, which is what makes it a useful check.

Tables are the driver's views: lineitem, orders, part, supplier, nation,
region, events.
"""

from __future__ import annotations

from collections.abc import Iterable

from tradewatch.params import (
    BUY_CODE,
    DATED_RULES,
    EXCLUDED_COMMENT_CODES,
    NET_SIDE,
    SELL_CODE,
    SIDES,
    RuleSet,
    Scope,
    overlapping_rules,
    testdata_rules,
)


def _q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _k(v: str) -> str:
    return _q(v.rstrip(" ").lower())


def _n(col: str) -> str:
    return f"lower(rtrim({col}))"


def _in(col: str, vals: Iterable[str]) -> str:
    vals = sorted({v.rstrip(" ").lower() for v in vals})
    if not vals:
        return "FALSE"
    return f"{_n(col)} IN ({', '.join(_q(v) for v in vals)})"


def _not_in(col: str, vals: Iterable[str]) -> str:
    vals = sorted({v.rstrip(" ").lower() for v in vals})
    if not vals:
        return "TRUE"
    return f"{_n(col)} NOT IN ({', '.join(_q(v) for v in vals)})"


def _sum(expr: str) -> str:
    return f"CAST(sum({expr}) AS DOUBLE)"


def _dates(vals: Iterable[str]) -> str:
    return ", ".join(f"DATE {_q(v)}" for v in vals)


# ---------------------------------------------------------------- base views

def base_positions(r: RuleSet) -> str:
    books = _in("v.source", r.positions.desk_sources)
    blank = _not_in("v.trader_raw", [""])
    return f"""
positions AS (
  SELECT CAST(o.o_orderdate AS DATE) AS loaddate, p.p_type AS commodity,
         CASE WHEN l.l_linestatus = 'O' THEN -l.l_quantity ELSE l.l_quantity END AS delta,
         o.o_orderstatus AS source, l.l_suppkey AS location_code, p.p_name AS sub_location,
         CASE l.l_returnflag WHEN 'A' THEN 'Purchase' WHEN 'R' THEN 'Sale' ELSE 'NA' END AS side,
         CASE WHEN o.o_orderkey % 11 = 0 THEN NULL WHEN o.o_orderkey % 13 = 0 THEN '   '
              ELSE o.o_orderpriority END AS trader_raw, CAST(l.l_shipdate AS DATE) AS contract_month,
         'C' || CAST(o.o_orderkey AS VARCHAR) AS contract_number,
         CASE l.l_linenumber WHEN 7 THEN 'ALT' WHEN 6 THEN NULL ELSE 'STD' END AS position_type
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
workdays AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS workday FROM orders
  WHERE dayofweek(CAST(o_orderdate AS DATE)) NOT IN (0, 6)
),
pos_dims AS (
  SELECT v.*, s.s_name AS location, n.n_name AS subdivision, rg.r_name AS division,
         CASE WHEN {books} AND {blank} THEN substr(v.trader_raw, 1, 10)
              ELSE s.s_name END AS desk
  FROM positions v
  LEFT JOIN supplier s ON s.s_suppkey = v.location_code
  LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
  LEFT JOIN region rg ON rg.r_regionkey = n.n_regionkey
)"""


def _member(s: Scope) -> str:
    if s.include_subdivisions is not None:
        return _in("subdivision", s.include_subdivisions)
    c = f"{_n('division')} = {_k(s.division)}"
    if s.exclude_subdivisions:
        c += " AND " + _not_in("subdivision", s.exclude_subdivisions)
    return c


def _scope_extract(r: RuleSet, s: Scope, test: str) -> str:
    """One scope's extract, filters as the original SQL had them."""
    pr = r.positions
    since = r.since if test == "tenor" else r.high_since
    w = [f"loaddate > DATE '{since.isoformat()}'",
         "loaddate IN (SELECT workday FROM workdays)",
         _member(s),
         "dayofweek(loaddate) NOT IN (0, 6)",
         _not_in("commodity", pr.excluded_commodities),
         _not_in(s.desk_column, pr.excluded_desks)]
    if s.exclude_position_type:
        w.append(f"{_n('position_type')} <> {_k(pr.excluded_position_type)}")
    if s.exclude_holidays and pr.holidays:
        w.append(f"loaddate NOT IN ({_dates(pr.holidays)})")
    if test == "tenor":
        w.append(_not_in("sub_location", pr.tenor_sub_locations))
        for pat in pr.tenor_sub_location_like:
            w.append(f"lower(sub_location) NOT LIKE {_q(pat.lower())}")
    else:
        w.append(_not_in("contract_number", pr.high_contracts))
        w.append(_not_in("sub_location", pr.high_sub_locations))
        for o in pr.one_offs:
            parts = []
            if o.contract_number is not None:
                parts.append(f"{_n('contract_number')} = {_k(o.contract_number)}")
            if o.loaddate is not None:
                parts.append(f"loaddate = DATE {_q(o.loaddate)}")
            if o.side is not None:
                parts.append(f"{_n('side')} = {_k(o.side)}")
            if o.commodity is not None:
                parts.append(f"{_n('commodity')} = {_k(o.commodity)}")
            if o.location is not None:
                parts.append(f"{_n('location')} = {_k(o.location)}")
            if o.desk is not None:
                parts.append(f"{_n('desk')} = {_k(o.desk)}")
            if o.desk_like is not None:
                parts.append(f"lower(desk) LIKE {_q(o.desk_like.lower())}")
            if parts:
                w.append("NOT (" + " AND ".join(parts) + ")")
    return (f"SELECT *, {_q(s.name)} AS scope FROM pos_dims WHERE "
            + "\n    AND ".join(w))


def _scoped_plain(r: RuleSet, s: Scope, test: str) -> str:
    since = r.since if test == "tenor" else r.high_since
    return (f"SELECT *, {_q(s.name)} AS scope FROM pos_dims WHERE loaddate > DATE "
            f"'{since.isoformat()}' AND loaddate IN (SELECT workday FROM workdays) AND {_member(s)}")


def tenor_rows(r: RuleSet) -> str:
    ex = "\n  UNION ALL\n  ".join(_scope_extract(r, s, "tenor") for s in r.positions.tenor_scopes)
    h = r.tenor_horizon_months
    return f"""
tenor_rows AS (
  SELECT *, CASE WHEN CAST(date_trunc('month', contract_month) AS DATE)
                      > CAST(date_trunc('month', loaddate) + INTERVAL {h} MONTH AS DATE)
                 THEN 1 ELSE 0 END AS beyond_twelve_months
  FROM (
  {ex}
  )
)"""


def high_rows(r: RuleSet) -> str:
    ex = "\n  UNION ALL\n  ".join(_scope_extract(r, s, "high") for s in r.positions.high_scopes)
    return f"""
high_rows AS (
  {ex}
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n"


# ------------------------------------------------------------------ queries

SCOPED_COLS = ("scope, loaddate, commodity, delta, source, location, subdivision, division, "
               "sub_location, side, trader_raw, contract_month, contract_number, "
               "position_type, desk")
EXCLUDED_COLS = ("scope, loaddate, commodity, desk, subdivision, side, delta, sub_location, "
                 "contract_number")


def sql_scoped_positions(r: RuleSet) -> str:
    t = " UNION ALL ".join(_scoped_plain(r, s, "tenor") for s in r.positions.tenor_scopes)
    h = " UNION ALL ".join(_scoped_plain(r, s, "high") for s in r.positions.high_scopes)
    return (_with(base_positions(r))
            + f"SELECT 'tenor' AS test, {SCOPED_COLS} FROM ({t})\n"
            + f"UNION ALL SELECT 'high' AS test, {SCOPED_COLS} FROM ({h})")


def sql_scoped_positions_landed(r: RuleSet) -> str:
    t = " UNION ALL ".join(_scoped_plain(r, s, "tenor") for s in r.positions.tenor_scopes)
    return _with(base_positions(r)) + f"SELECT {SCOPED_COLS} FROM ({t})"


def sql_exclusion_rules(r: RuleSet) -> str:
    return (_with(base_positions(r), tenor_rows(r), high_rows(r))
            + f"SELECT 'tenor' AS test, {EXCLUDED_COLS} FROM tenor_rows\n"
            + f"UNION ALL SELECT 'high' AS test, {EXCLUDED_COLS} FROM high_rows")


def _dated_rule(test: str, first: str | None, last: str | None, parts: dict) -> str:
    """One dated rule as the condition that would have been written into the extract."""
    c = [f"test = {_q(test)}"]
    c += [f"loaddate >= DATE {_q(first)}"] if first else []
    c += [f"loaddate <= DATE {_q(last)}"] if last else []
    for k, v in parts.items():
        if k == "scope":
            c.append(f"scope = {_q(v)}")
        elif k.endswith("_like"):
            c.append(f"lower({k[:-5]}) LIKE {_q(v.lower())}")
        else:
            c.append(f"{_n(k)} = {_k(v)}")
    return "NOT (" + " AND ".join(c) + ")"


def sql_rule_table() -> str:
    r = overlapping_rules()
    rules = "\n  AND ".join(_dated_rule(*rule) for rule in DATED_RULES)
    return (_with(base_positions(r), tenor_rows(r), high_rows(r))
            + f"""SELECT test, {EXCLUDED_COLS} FROM (
  SELECT 'tenor' AS test, * FROM (SELECT {EXCLUDED_COLS}, position_type, location FROM tenor_rows)
  UNION ALL
  SELECT 'high' AS test, * FROM (SELECT {EXCLUDED_COLS}, position_type, location FROM high_rows))
WHERE {rules}""")


def sql_desk_resolution(r: RuleSet) -> str:
    return (_with(base_positions(r))
            + "SELECT source, trader_raw, location, desk, count(*) AS n_rows\n"
              "FROM pos_dims GROUP BY source, trader_raw, location, desk")


def sql_tenor_flag(r: RuleSet) -> str:
    h = r.tenor_horizon_months
    return (_with(base_positions(r))
            + f"""SELECT load_month, contract_month, beyond_twelve_months, count(*) AS n_rows
FROM (
  SELECT CAST(date_trunc('month', loaddate) AS DATE) AS load_month,
         CAST(date_trunc('month', contract_month) AS DATE) AS contract_month,
         CASE WHEN CAST(date_trunc('month', contract_month) AS DATE)
                   > CAST(date_trunc('month', loaddate) + INTERVAL {h} MONTH AS DATE)
              THEN 1 ELSE 0 END AS beyond_twelve_months
  FROM positions)
GROUP BY load_month, contract_month, beyond_twelve_months""")


def sql_tenor_exposure(r: RuleSet) -> str:
    return (_with(base_positions(r), tenor_rows(r))
            + f"""SELECT loaddate, commodity AS poscommodity, desk AS trader, subdivision,
       beyond_twelve_months, {_sum('abs(delta)')} AS abs_st
FROM tenor_rows GROUP BY loaddate, commodity, desk, subdivision, beyond_twelve_months""")


def tenor_feed(r: RuleSet) -> str:
    lim = r.tenor_share_limit
    return f"""
tenor_exp AS (
  SELECT loaddate, commodity AS poscommodity, desk AS trader, subdivision,
         beyond_twelve_months, {_sum('abs(delta)')} AS abs_st
  FROM tenor_rows GROUP BY ALL
),
tenor_tot AS (
  SELECT loaddate, poscommodity, trader, subdivision, sum(abs_st) AS total
  FROM tenor_exp
  WHERE loaddate IS NOT NULL AND poscommodity IS NOT NULL AND trader IS NOT NULL
    AND subdivision IS NOT NULL
  GROUP BY ALL
),
tenor_out AS (
  SELECT loaddate, poscommodity, trader, subdivision, sum(abs_st) AS outside
  FROM tenor_exp WHERE beyond_twelve_months = 1 GROUP BY ALL
),
tenor_feed AS (
  SELECT t.loaddate, t.subdivision, t.trader, t.poscommodity,
         CASE WHEN coalesce(o.outside, 0) > 0 THEN o.outside / t.total
              ELSE CAST(0 AS DOUBLE) END AS dailyValue,
         CASE WHEN (CASE WHEN coalesce(o.outside, 0) > 0 THEN o.outside / t.total ELSE 0 END)
                   > {lim} THEN 1 ELSE 0 END AS breaks,
         'tenor breaks' AS test
  FROM tenor_tot t LEFT JOIN tenor_out o
    ON t.loaddate = o.loaddate AND t.poscommodity = o.poscommodity
   AND t.trader = o.trader AND t.subdivision = o.subdivision
)"""


def sql_tenor_breaks(r: RuleSet) -> str:
    return _with(base_positions(r), tenor_rows(r), tenor_feed(r)) + "SELECT * FROM tenor_feed"


def high_net(r: RuleSet) -> str:
    avgs = " + ".join(f"coalesce(avg(abs_st) FILTER (WHERE pors = {_q(sd)}), 0)"
                      for sd in SIDES)
    return f"""
high_side AS (
  SELECT scope, loaddate, commodity AS poscommodity, desk AS trader, side AS pors, subdivision,
         {_sum(f"CASE WHEN {_n('side')} = {_k(NET_SIDE)} THEN delta ELSE abs(delta) END")} AS abs_st
  FROM high_rows GROUP BY ALL
),
high_net AS (
  SELECT loaddate, poscommodity, trader, subdivision, pns,
         round_even(pns * CAST(100000 AS DOUBLE), 0) / CAST(100000 AS DOUBLE) AS dailyValue
  FROM (
    SELECT loaddate, poscommodity, trader, subdivision, CAST({avgs} AS DOUBLE) AS pns
    FROM high_side
    WHERE loaddate IS NOT NULL AND poscommodity IS NOT NULL AND trader IS NOT NULL
      AND subdivision IS NOT NULL
    GROUP BY loaddate, poscommodity, trader, subdivision
    HAVING count(abs_st) FILTER (WHERE pors IS NOT NULL) > 0
  )
)"""


def high_flags(n: int) -> str:
    return f"""
high_flags AS (
  SELECT *, CASE WHEN maxValue = prevDailyVal THEN 0 WHEN maxValue = 0 THEN 0
                 WHEN dailyValue >= maxValue THEN 1 ELSE 0 END AS breaks
  FROM (
    SELECT *, CASE WHEN count(dailyValue) OVER wn = {n} THEN max(dailyValue) OVER wn END AS maxValue,
              lag(dailyValue) OVER w AS prevDailyVal
    FROM high_net
    WINDOW w AS (PARTITION BY poscommodity, trader ORDER BY loaddate, subdivision),
           wn AS (PARTITION BY poscommodity, trader ORDER BY loaddate, subdivision
                  ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)
  )
)"""


def _high_base(r: RuleSet) -> tuple[str, ...]:
    return (base_positions(r), high_rows(r), high_net(r))


def sql_side_volume(r: RuleSet) -> str:
    return (_with(base_positions(r), high_rows(r), high_net(r))
            + "SELECT * FROM high_side")


def sql_net_side_volume(r: RuleSet) -> str:
    return _with(*_high_base(r)) + "SELECT * FROM high_net"


def sql_new_high_breaks(r: RuleSet, n: int | None = None) -> str:
    n = n or r.new_high_window
    return (_with(*_high_base(r), high_flags(n))
            + "SELECT loaddate, subdivision, trader, poscommodity, dailyValue, breaks, "
              "'PnS breaks' AS test FROM high_flags")


def sql_series_order(r: RuleSet) -> str:
    return (_with(*_high_base(r)) + """SELECT poscommodity, trader, loaddate, subdivision, dailyValue,
       row_number() OVER (ORDER BY poscommodity, trader, loaddate, subdivision) - 1 AS place
FROM high_net""")


def sql_break_running_count(r: RuleSet) -> str:
    return (_with(*_high_base(r), high_flags(r.new_high_window))
            + """SELECT loaddate, subdivision, trader, poscommodity, dailyValue, maxValue,
       prevDailyVal, breaks,
       CAST(sum(breaks) OVER (PARTITION BY poscommodity, trader ORDER BY loaddate, subdivision
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
         AS count_breaks
FROM high_flags""")


def _r5(x: str) -> str:
    return f"round_even(({x}) * CAST(100000 AS DOUBLE), 0) / CAST(100000 AS DOUBLE)"


def sql_band_breaks(r: RuleSet) -> str:
    n, k = r.band_window, r.band_k
    return (_with(*_high_base(r)) + f"""SELECT loaddate, subdivision, trader, poscommodity, dailyValue, moving_avg,
       moving_std, upper_bound,
       CASE WHEN dailyValue > upper_bound THEN 1 ELSE 0 END AS breaks, 'PnS breaks' AS test
FROM (
  SELECT *, {_r5(f"moving_avg + moving_std * {k}")} AS upper_bound
  FROM (
    SELECT *, {_r5(f"CASE WHEN count(dailyValue) OVER wn = {n} THEN avg(dailyValue) OVER wn END")} AS moving_avg,
              {_r5(f"CASE WHEN count(dailyValue) OVER wn = {n} THEN stddev_samp(dailyValue) OVER wn END")} AS moving_std
    FROM high_net
    WINDOW wn AS (PARTITION BY poscommodity, trader ORDER BY loaddate, subdivision
                  ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)
  )
  WHERE moving_avg IS NOT NULL
)""")


# ---------------------------------------------------------------- day trades

def base_fills(r: RuleSet) -> str:
    return """
fills AS (
  SELECT CAST(e.ts AS DATE) AS trade_date,
         CAST(e.ts + INTERVAL 2 HOUR AS DATE) AS load_date,
         'AC' || lpad(CAST(e.user_id % 40 AS VARCHAR), 2, '0') AS account,
         'HOLDER ' || CAST(e.user_id % 40 % 9 AS VARCHAR) AS account_name,
         'SUB_' || CAST(e.user_id % 5 AS VARCHAR) AS subdivision,
         'LOC_' || CAST(e.event_id % 3 AS VARCHAR) AS location,
         p.p_type AS commodity,
         CASE WHEN e.event_id % 6 < 2 THEN 'FMT' WHEN e.event_id % 6 < 4 THEN 'WFC'
              WHEN e.event_id % 6 = 4 THEN 'SX0' ELSE 'ICE' END AS source,
         CAST(date_trunc('month', CAST(e.ts AS DATE)) + to_months(e.k % 3) AS DATE)
           AS position_month,
         CASE WHEN e.k % 2 = 0 THEN 'F' ELSE 'O' END AS fin_type,
         CASE WHEN e.k % 10 = 9 THEN NULL ELSE CAST(e.k % 2 AS DOUBLE) * 5.0 END AS strike_price,
         CASE WHEN e.event_type IN ('purchase', 'click') THEN 'B'
              WHEN e.event_type IN ('view', 'signup') THEN 'S' END AS side,
         CAST(e.value AS DECIMAL(12, 2)) AS gross_qty,
         CAST(CASE WHEN e.k % 2 = 0 THEN e.value ELSE -e.value END AS DECIMAL(12, 2)) AS mtm,
         CASE WHEN e.k % 17 = 0 THEN 'BR0' ELSE 'BRK' END AS broker_num,
         CASE WHEN e.k % 19 = 0 THEN 'CD0' ELSE 'CRD' END AS card_number,
         CASE WHEN e.k % 11 = 0 THEN 'K' WHEN e.k % 11 = 1 THEN ' I' ELSE 'N' END AS comment_code
  FROM (SELECT *, TRY_CAST(regexp_extract(props, '"k":\\s*(\\d+)', 1) AS INTEGER) AS k
        FROM events) e
  LEFT JOIN part p ON p.p_partkey = e.k
)"""


def _fill_where(r: RuleSet, comment: bool, names: bool) -> str:
    f = r.fills
    since = r.since.isoformat()
    w = [_not_in("account", f.excluded_accounts)]
    w += [f"lower(account) NOT LIKE {_q(p.lower())}" for p in f.excluded_account_like]
    w += [f"lower(subdivision) NOT LIKE {_q(p.lower())}" for p in f.excluded_subdivision_like]
    w += [f"{_n('broker_num')} <> {_k(f.excluded_broker)}",
          f"{_n('card_number')} <> {_k(f.excluded_card)}",
          f"load_date > DATE '{since}'",
          "load_date = trade_date",
          f"{_n('source')} <> {_k(f.excluded_source)}",
          "gross_qty <> 0"]
    if comment:
        w.append(_not_in("comment_code", EXCLUDED_COMMENT_CODES))
    if names:
        w.append(_not_in("account_name", f.excluded_account_names))
    return "\n    AND ".join(w)


_GROUP = ("trade_date, account, subdivision, location, commodity, source, position_month, "
          "fin_type, side, account_name, strike_price")
_MATCH_ON = " AND ".join(f"b.{k} = s.{k}" for k in
                         ("trade_date", "commodity", "account", "position_month", "fin_type",
                          "strike_price"))


def fill_ctes(r: RuleSet) -> str:
    w = _fill_where(r, comment=True, names=False)
    ws = _fill_where(r, comment=False, names=True)
    since = r.since.isoformat()
    return f"""
buys AS (
  SELECT {_GROUP.replace('side', 'side AS pors')},
         CAST(sum(gross_qty) AS DOUBLE) AS purchase_qty, CAST(sum(mtm) AS DOUBLE) AS purchase_pnl
  FROM fills WHERE {_n('side')} = {_k(BUY_CODE)}
    AND {w}
  GROUP BY {_GROUP}
),
sells AS (
  SELECT {_GROUP.replace('side', 'side AS pors')},
         CAST(sum(gross_qty) AS DOUBLE) AS sale_qty, CAST(sum(mtm) AS DOUBLE) AS sale_pnl
  FROM fills WHERE {_n('side')} = {_k(SELL_CODE)}
    AND {w}
  GROUP BY {_GROUP}
),
matched AS (
  SELECT b.*, s.sale_qty, s.sale_pnl,
         CASE WHEN b.purchase_qty < s.sale_qty THEN b.purchase_qty ELSE s.sale_qty END
           AS day_trade_qty
  FROM buys b LEFT JOIN sells s ON {_MATCH_ON}
),
matched_pnl AS (
  SELECT *, CASE WHEN purchase_qty > day_trade_qty
                 THEN (CASE WHEN purchase_qty = 0 THEN NULL ELSE day_trade_qty / purchase_qty END)
                      * purchase_pnl + sale_pnl
                 ELSE (CASE WHEN sale_qty = 0 THEN NULL ELSE day_trade_qty / sale_qty END)
                      * sale_pnl + purchase_pnl END AS day_trade_pnl
  FROM matched
),
skeleton AS (
  SELECT dt.trade_date, acct.account, CAST(NULL AS VARCHAR) AS subdivision,
         CAST(NULL AS VARCHAR) AS location, acct.commodity, acct.source,
         CAST(NULL AS DATE) AS position_month, CAST(NULL AS VARCHAR) AS fin_type,
         CAST(NULL AS VARCHAR) AS pors, acct.account_name, CAST(NULL AS DOUBLE) AS strike_price,
         CAST(0 AS DOUBLE) AS purchase_qty, CAST(0 AS DOUBLE) AS purchase_pnl,
         CAST(0 AS DOUBLE) AS sale_qty, CAST(0 AS DOUBLE) AS sale_pnl,
         CAST(0 AS DOUBLE) AS day_trade_qty, CAST(0 AS DOUBLE) AS day_trade_pnl
  FROM (SELECT DISTINCT account, account_name, commodity, source FROM fills
        WHERE {ws}) acct
  CROSS JOIN (SELECT trade_date FROM fills
              WHERE load_date > DATE '{since}' AND trade_date >= load_date
              GROUP BY trade_date) dt
),
all_rows AS (
  SELECT * FROM matched_pnl
  UNION ALL
  SELECT * FROM skeleton
),
active AS (
  SELECT p.* FROM all_rows p
  LEFT JOIN (SELECT account AS mktfilter, sum(day_trade_qty) AS daytradefilter
             FROM matched GROUP BY account) mk ON mk.mktfilter = p.account
  WHERE mk.mktfilter IS NOT NULL
    AND {_not_in('p.account_name', r.fills.excluded_account_names)}
    AND p.trade_date > DATE '{since}'
)"""


def commcode(r: RuleSet) -> str:
    d, g = r.fills.blocked_commodity_group
    return f"""
commcode AS (
  SELECT DISTINCT com.description AS commoditydescription, grp.commgrp
  FROM (SELECT DISTINCT p_type AS description, length(p_type) AS subgroup_id FROM part
        WHERE CASE WHEN p_size = 50 THEN '0' ELSE '1' END = '1') com
  LEFT JOIN (SELECT DISTINCT p_size AS id, p_size % 4 AS group_id FROM part
             WHERE CASE WHEN p_size = 8 THEN '0' ELSE '1' END = '1') sub
    ON com.subgroup_id = sub.id
  LEFT JOIN (SELECT r_regionkey AS id,
                    upper(substr(r_name, 1, 1)) || lower(substr(r_name, 2, 100)) || ' Group'
                      AS commgrp
             FROM region) grp
    ON sub.group_id = grp.id
  WHERE (CASE WHEN {_n('com.description')} = {_k(d)} AND {_n('grp.commgrp')} = {_k(g)}
              THEN 0 ELSE 1 END) = 1
)"""


def mapped(r: RuleSet) -> str:
    pat = r.fills.blocked_location_like.lower()
    ids = ", ".join(_q(v) for v in ("3", "67"))
    return f"""
acct_map AS (
  SELECT 'AC' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS source_report_code,
         sid AS source_id, n_nationkey AS location_id
  FROM nation, (SELECT unnest(['3', '67', '0']) AS sid)
),
mapped AS (
  SELECT pos.trade_date, pos.account, sub.r_name AS subdivision, loc.n_name AS location,
         cc.commgrp AS commodity, pos.day_trade_qty, pos.day_trade_pnl
  FROM active pos
  LEFT JOIN commcode cc ON cc.commoditydescription = pos.commodity
  INNER JOIN acct_map rsm
    ON pos.account = rsm.source_report_code
   AND CASE WHEN {_n('pos.source')} = 'fmt' THEN '3' WHEN {_n('pos.source')} = 'wfc' THEN '67'
            ELSE '0' END = rsm.source_id
   AND rsm.source_id IN ({ids})
  INNER JOIN nation loc ON rsm.location_id = loc.n_nationkey
  INNER JOIN region sub ON loc.n_regionkey = sub.r_regionkey
  WHERE lower(loc.n_name) NOT LIKE {_q(pat)}
)"""


def _fills_all(r: RuleSet) -> tuple[str, ...]:
    return (base_fills(r), fill_ctes(r))


_ROW_COLS = ("trade_date, account, subdivision, location, commodity, source, position_month, "
             "fin_type, pors, account_name, strike_price, purchase_qty, purchase_pnl, sale_qty, "
             "sale_pnl, day_trade_qty, day_trade_pnl")


def sql_fill_sides(r: RuleSet) -> str:
    return (_with(*_fills_all(r)) + f"""SELECT {_GROUP.replace('side', 'pors')},
       purchase_qty AS qty, purchase_pnl AS pnl FROM buys
UNION ALL
SELECT {_GROUP.replace('side', 'pors')}, sale_qty AS qty, sale_pnl AS pnl FROM sells""")


def sql_day_trade_match(r: RuleSet) -> str:
    return _with(*_fills_all(r)) + "SELECT * FROM matched"


def sql_day_trade_pnl(r: RuleSet) -> str:
    return _with(*_fills_all(r)) + "SELECT * FROM matched_pnl"


def sql_account_date_skeleton(r: RuleSet) -> str:
    return _with(*_fills_all(r)) + "SELECT * FROM skeleton"


def sql_active_accounts(r: RuleSet) -> str:
    return _with(*_fills_all(r)) + f"SELECT {_ROW_COLS} FROM active"


def sql_commodity_groups(r: RuleSet) -> str:
    return _with(commcode(r)) + "SELECT * FROM commcode"


def sql_account_location(r: RuleSet) -> str:
    return _with(*_fills_all(r), commcode(r), mapped(r)) + "SELECT * FROM mapped"


def day_trade_feed(r: RuleSet) -> str:
    lim = r.day_trade_limit
    excl = _q(r.fills.excluded_day_trade_commodity)
    sub = ""
    if r.fills.excluded_day_trade_subdivisions:
        vals = ", ".join(_q(v) for v in r.fills.excluded_day_trade_subdivisions)
        sub = f"AND (subdivision IS NULL OR subdivision NOT IN ({vals}))"
    return f"""
day_trade_feed AS (
  SELECT loaddate, subdivision, trader, poscommodity, dailyValue,
         CASE WHEN dailyValue > {lim} THEN 1 ELSE 0 END AS breaks, 'day trade breaks' AS test
  FROM (
    SELECT trade_date AS loaddate, subdivision, commodity AS poscommodity, location AS trader,
           {_sum('CAST(coalesce(day_trade_qty, 0) AS DECIMAL(38, 2))')} AS dailyValue
    FROM mapped
    WHERE commodity IS DISTINCT FROM {excl} {sub}
      AND trade_date IS NOT NULL AND subdivision IS NOT NULL AND commodity IS NOT NULL
      AND location IS NOT NULL
    GROUP BY trade_date, subdivision, commodity, location
  )
)"""


def sql_day_trade_breaks(r: RuleSet) -> str:
    return (_with(*_fills_all(r), commcode(r), mapped(r), day_trade_feed(r))
            + "SELECT * FROM day_trade_feed")


def _feed_all(r: RuleSet) -> str:
    return _with(base_positions(r), tenor_rows(r), tenor_feed(r), high_rows(r), high_net(r),
                 high_flags(r.new_high_window), base_fills(r), fill_ctes(r), commcode(r),
                 mapped(r), day_trade_feed(r)) + f"""
, combined AS (
  SELECT * FROM (
    SELECT loaddate, subdivision, trader, poscommodity, dailyValue, breaks, test FROM tenor_feed
    UNION ALL
    SELECT loaddate, subdivision, trader, poscommodity, dailyValue, breaks, test
    FROM day_trade_feed
    UNION ALL
    SELECT loaddate, subdivision, trader, poscommodity, dailyValue, breaks, 'PnS breaks'
    FROM high_flags)
  WHERE loaddate > DATE '{r.since.isoformat()}'
)
"""


def sql_combined_breaks(r: RuleSet) -> str:
    return _feed_all(r) + "SELECT * FROM combined"


def sql_feed_append_cast(r: RuleSet) -> str:
    return _feed_all(r) + """SELECT loaddate AS day, substr(subdivision, 1, 6) AS area, trader AS desk,
       poscommodity AS commodity, dailyValue AS value, CAST(breaks AS BIGINT) AS broken, substr(test, 1, 5) AS kind
FROM combined"""


def sql_feed_append_strict(r: RuleSet) -> str:
    return _feed_all(r) + "SELECT * FROM combined UNION ALL SELECT * FROM combined"


def sql_feed_rerun(r: RuleSet) -> str:
    return _feed_all(r) + "SELECT * FROM combined WHERE loaddate > DATE '1997-06-01'"


def sql_delimited_rejects(r: RuleSet) -> str:
    head, tail = "loaddate || '~' || subdivision || '~' || trader", "'~' || breaks || '~' || test"
    return _feed_all(r) + f"""SELECT {head} AS line, 'fields' AS reason, NULL AS field FROM combined WHERE breaks = 1
UNION ALL SELECT {head} || '~' || poscommodity || '~1.5' || {tail} || '~more', 'fields', NULL FROM combined WHERE breaks = 1
UNION ALL SELECT {head} || '~' || poscommodity || '~much' || {tail}, 'type', 'dailyValue' FROM combined WHERE breaks = 1"""


def sql_run_audit(r: RuleSet) -> str:
    return _feed_all(r) + """SELECT 'trade surveillance' AS process, 'Job Complete' AS step, test,
       count(*) AS rows, CAST(sum(breaks) AS BIGINT) AS breaks, min(loaddate) AS min_date,
       max(loaddate) AS max_date, 1 AS success, '' AS message
FROM combined GROUP BY test"""


def sql_feed_rollback(r: RuleSet) -> str:
    return _feed_all(r) + """SELECT *, 1 AS version FROM combined
UNION ALL SELECT *, 2 AS version FROM combined WHERE loaddate <= DATE '1997-06-01'"""


def sql_audit_log(r: RuleSet) -> str:
    return sql_run_audit(r) + """
UNION ALL SELECT 'trade surveillance', 'Writing feed', NULL, NULL, NULL, NULL, NULL, 0,
       '7 columns (loaddate subdivision trader poscommodity dailyValue breaks test) for a 2-column target (its value)'"""


def oracle_sql(rules: RuleSet | None = None) -> dict[str, str]:
    r = rules or testdata_rules()
    return {
        "scoped_positions": sql_scoped_positions(r),
        "scoped_positions_landed": sql_scoped_positions_landed(r),
        "exclusion_rules": sql_exclusion_rules(r),
        "rule_table": sql_rule_table(),
        "net_side_volume_overlap": sql_net_side_volume(overlapping_rules()),
        "desk_resolution": sql_desk_resolution(r),
        "tenor_flag": sql_tenor_flag(r),
        "tenor_exposure": sql_tenor_exposure(r),
        "tenor_breaks": sql_tenor_breaks(r),
        "side_volume": sql_side_volume(r),
        "net_side_volume": sql_net_side_volume(r),
        "new_high_breaks": sql_new_high_breaks(r),
        "new_high_breaks_20": sql_new_high_breaks(r, 20),
        "new_high_stream": sql_new_high_breaks(r),
        "series_order": sql_series_order(r),
        "break_running_count": sql_break_running_count(r),
        "band_breaks": sql_band_breaks(r),
        "fill_sides": sql_fill_sides(r),
        "day_trade_match": sql_day_trade_match(r),
        "day_trade_pnl": sql_day_trade_pnl(r),
        "account_date_skeleton": sql_account_date_skeleton(r),
        "active_accounts": sql_active_accounts(r),
        "commodity_groups": sql_commodity_groups(r),
        "account_location": sql_account_location(r),
        "day_trade_breaks": sql_day_trade_breaks(r),
        "fill_view_refresh": sql_day_trade_breaks(r),
        "combined_breaks": sql_combined_breaks(r),
        "combined_until": sql_combined_breaks(r) + " WHERE loaddate <= DATE '1997-12-31'",
        "feed_append": sql_combined_breaks(r),
        "feed_append_cast": sql_feed_append_cast(r),
        "feed_append_strict": sql_feed_append_strict(r),
        "feed_replace": sql_combined_breaks(r),
        "feed_rollback": sql_feed_rollback(r),
        "feed_rerun": sql_feed_rerun(r),
        "delimited_stage": sql_combined_breaks(r),
        "delimited_good": sql_combined_breaks(r),
        "delimited_rejects": sql_delimited_rejects(r),
        "run_audit": sql_run_audit(r),
        "audit_log": sql_audit_log(r),
    }


__all__ = ["oracle_sql"]
