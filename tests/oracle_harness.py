"""Run a registered Spark query and its DuckDB oracle; compare the results.

Usable from pytest and from the command line:
    python tests/oracle_harness.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):          # exact: the engines must agree to the bit
        return None if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if isinstance(v, dt.datetime) and v.time() == dt.time(0):
        return v.date()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(cols: list[str], records) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           for x in t))


def compare(spark, sf_dir: str, key: str, query, sql: str, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    out = {"key": key, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_sec": round(t1 - t0, 2), "oracle_sec": round(t2 - t1, 2),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    if not out["columns_match"]:
        out["spark_cols"] = s_cols
        out["oracle_cols"] = d_cols
        out["values_match"] = False
        return out
    a = rows_of(s_cols, s_rows)
    b = rows_of(d_cols, d_rows)
    out["values_match"] = a == b
    if not out["values_match"]:
        sa, sb = set(a), set(b)
        out["only_spark"] = sorted(sa - sb, key=str)[:5]
        out["only_oracle"] = sorted(sb - sa, key=str)[:5]
    return out


def main(argv: list[str]) -> int:
    import __spark_entry__ as E
    from tradewatch.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = build_session("local[8]")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys or list(qs):
        if k not in sqls:
            df = qs[k](spark, sf_dir)
            print(f"{k}: no oracle, rows={df.count()}")
            continue
        r = compare(spark, sf_dir, k, qs[k], sqls[k], con)
        ok = r["columns_match"] and r["values_match"] and r["spark_rows"] == r["oracle_rows"]
        bad += not ok
        print(("OK   " if ok else "FAIL ") + str(r), flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
