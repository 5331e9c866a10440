"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewatch.params import TENOR_HORIZON_MONTHS, WEEKEND_DAYS


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def month_start(c: Column | str) -> Column:
    return F.trunc(_c(c), "MM")


def is_weekday(c: Column | str) -> Column:
    """Spark numbers days 1 = Sunday .. 7 = Saturday, as the source did."""
    return ~F.dayofweek(_c(c)).isin(list(WEEKEND_DAYS))


def beyond_horizon(loaddate: Column | str, contract_month: Column | str,
                   months: int = TENOR_HORIZON_MONTHS) -> Column:
    """1 when the contract month starts strictly after load month + `months`.

    Both sides are month starts; a null contract month gives 0 (CASE ELSE).
    """
    horizon = F.add_months(month_start(loaddate), months)
    return F.when(month_start(contract_month) > horizon, F.lit(1)).otherwise(F.lit(0))
