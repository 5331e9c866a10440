"""String predicates with the source databases' comparison rules.

The position and fill extracts compared strings case-insensitively and
ignoring trailing blanks (default collation of both databases). Those rules
are applied here; the pandas-era steps that compared exactly use plain
``==`` / ``eqNullSafe`` in the operators instead.

Null handling is SQL's: a comparison with null is null, so a filter drops
the row -- ``NOT IN`` included.

A predicate on a named column is built as one SQL expression (one call into
the JVM instead of one per function), which keeps plan construction cheap
when rule tables hold many values.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _key(v: str) -> str:
    return v.rstrip(" ").lower()


def sql_str(v: str) -> str:
    """A Spark SQL string literal (backslash escapes)."""
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _norm_sql(name: str) -> str:
    return f"lower(rtrim({_ident(name)}))"


def norm(c: Column | str) -> Column:
    """Comparison key: lower case, trailing blanks removed."""
    if isinstance(c, str):
        return F.expr(_norm_sql(c))
    return F.lower(F.rtrim(c))


def _vals(values: Iterable[str]) -> list[str]:
    return sorted({_key(v) for v in values})


# SQL-text forms, for composing many rules into one expression.

def same_text_sql(name: str, value: str) -> str:
    return f"{_norm_sql(name)} = {sql_str(_key(value))}"


def in_text_sql(name: str, values: Iterable[str]) -> str:
    vals = _vals(values)
    return f"{_norm_sql(name)} IN ({', '.join(map(sql_str, vals))})" if vals else "FALSE"


def not_in_text_sql(name: str, values: Iterable[str]) -> str:
    """SQL ``NOT IN``: null input gives null (row dropped by a filter)."""
    vals = _vals(values)
    return f"{_norm_sql(name)} NOT IN ({', '.join(map(sql_str, vals))})" if vals else "TRUE"


def ilike_any_sql(name: str, patterns: Iterable[str]) -> str:
    """Case-insensitive SQL LIKE against any of the patterns."""
    pats = [p.lower() for p in patterns]
    if not pats:
        return "FALSE"
    col = f"lower({_ident(name)})"
    return "(" + " OR ".join(f"{col} LIKE {sql_str(p)}" for p in pats) + ")"


# Column forms.

def same_text(c: Column | str, value: str) -> Column:
    if isinstance(c, str):
        return F.expr(same_text_sql(c, value))
    return norm(c) == F.lit(_key(value))


def in_text(c: Column | str, values: Iterable[str]) -> Column:
    if isinstance(c, str):
        return F.expr(in_text_sql(c, values))
    vals = _vals(values)
    return norm(c).isin(vals) if vals else F.lit(False)


def not_in_text(c: Column | str, values: Iterable[str]) -> Column:
    """SQL ``NOT IN``: null input gives null (row dropped by a filter)."""
    if isinstance(c, str):
        return F.expr(not_in_text_sql(c, values))
    vals = _vals(values)
    return ~norm(c).isin(vals) if vals else F.lit(True)


def ilike_any(c: Column | str, patterns: Iterable[str]) -> Column:
    """Case-insensitive SQL LIKE against any of the patterns."""
    if isinstance(c, str):
        return F.expr(ilike_any_sql(c, patterns))
    out = None
    for p in patterns:
        t = F.lower(c).like(p.lower())
        out = t if out is None else (out | t)
    return out if out is not None else F.lit(False)
