"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(c: Column | str, digits: int) -> Column:
    """numpy's ``round(x, n)``: scale, round half to even, scale back.

    Spark's ``round``/``bround`` round the decimal value and disagree with
    numpy on binary ties (0.000025 -> 3e-05 vs numpy's 2e-05).
    """
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)
