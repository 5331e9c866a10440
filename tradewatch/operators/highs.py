"""New-high test: daily net volume at a rolling row-window high.

Series = (commodity, desk), rows ordered by (load date, subdivision).

Skew: the window input is the per-day pivot, not raw positions. With
``chunk_rows`` the rows of all series, numbered in order, are cut into chunks of
that many rows with a halo of the previous ``window - 1`` (``series.chunked``):
same results, no task's group holds more than ``chunk_rows + window - 1`` rows,
wherever the rows of a series lie in time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.functions import round_half_even, same_text
from tradewatch.functions.text import sql_str
from tradewatch.operators.positions import SERIES_KEYS
from tradewatch.operators.series import ORDER, SERIES, Placed, placed, rolling_max, rolling_moments, running_sum
from tradewatch.params import (
    BAND_K,
    BAND_WINDOW,
    NET_SIDE,
    NEW_HIGH_WINDOW,
    ROUND_DIGITS,
    SIDES,
    TEST_NEW_HIGH,
)
from tradewatch.schemas import FEED_COLUMNS

__all__ = ["ORDER", "SERIES", "band_breaks", "break_running_count", "net_side_volume", "net_volume", "new_high_breaks",
           "new_high_flags", "new_high_running_count"]


def net_side_volume(side_vol: DataFrame, digits: int = ROUND_DIGITS) -> DataFrame:
    """Mean per side across scope copies (a pivot with mean), missing sides 0,
    Purchase + Sale + NA, rounded half-even like numpy.

    Conditional ``avg`` per side is the pivot in one aggregation. Sides are
    matched exactly (the pivot did not fold case); keys whose values are all
    null, or with a null key, are left out as the pivot left them out.
    """
    vals = {s: F.avg(F.when(F.col("pors") == s, F.col("abs_st"))) for s in SIDES}
    present = F.count(F.when(F.col("pors").isNotNull(), F.col("abs_st")))
    agg = (side_vol.dropna(subset=SERIES_KEYS)
           .groupBy(*SERIES_KEYS)
           .agg(*[v.alias(f"side_{i}") for i, v in enumerate(vals.values())],
                present.alias("n_values"))
           .where(F.col("n_values") > 0))
    pns = None
    for i in range(len(SIDES)):
        c = F.coalesce(F.col(f"side_{i}"), F.lit(0.0))
        pns = c if pns is None else pns + c
    return agg.select(*SERIES_KEYS, pns.alias("pns"),
                      round_half_even(pns, digits).alias("dailyValue"))


def net_volume(rows: DataFrame, scopes: list[str], digits: int = ROUND_DIGITS) -> DataFrame:
    """``net_side_volume(side_volume(rows))`` in one aggregation.

    Per key, one conditional sum per (scope, side) gives the per-scope
    side volumes; their mean over the scopes present, per side, is the
    pivot. One shuffle on the four keys instead of two (six keys, then four).
    """
    v = F.when(same_text("side", NET_SIDE), F.col("delta")).otherwise(F.abs("delta"))
    keyed = rows.select("scope", "loaddate", F.col("commodity").alias("poscommodity"),
                        F.col("desk").alias("trader"), "subdivision", "side", v.alias("v"))
    # Many similar expressions: written as SQL text, one JVM call each.
    cells = [F.expr(f"CAST(sum(CASE WHEN scope = {sql_str(sc)} AND side = {sql_str(sd)} THEN v END) "
                    "AS DOUBLE)").alias(f"c_{i}_{j}")
             for i, sc in enumerate(scopes) for j, sd in enumerate(SIDES)]
    present = F.expr("count(CASE WHEN side IS NOT NULL THEN v END)").alias("n_values")
    agg = (keyed.dropna(subset=SERIES_KEYS).groupBy(*SERIES_KEYS)
           .agg(*cells, present).where(F.col("n_values") > 0))
    means = []
    for j in range(len(SIDES)):
        cs = [f"c_{i}_{j}" for i in range(len(scopes))]
        total = " + ".join(f"coalesce({c}, 0.0D)" for c in cs)
        n = " + ".join(f"CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END" for c in cs)
        means.append(f"coalesce(try_divide({total}, CAST({n} AS DOUBLE)), 0.0D)")
    pns = F.expr(" + ".join(f"({m})" for m in means))
    return agg.select(*SERIES_KEYS, pns.alias("pns"), round_half_even(pns, digits).alias("dailyValue"))


def _flag(v: Column) -> Column:
    return (F.when(F.col("maxValue") == F.col("prevDailyVal"), 0)
            .when(F.col("maxValue") == 0, 0)
            .when(v >= F.col("maxValue"), 1)
            .otherwise(0)).cast("int")


def _flagged(net: DataFrame, window: int, chunk_rows: int | None) -> Placed:
    # The previous value needs a row of halo even when the window is one row.
    p = rolling_max(placed(net, max(window - 1, 1), chunk_rows), "dailyValue", window, "maxValue")
    rows = p.rows.withColumn("prevDailyVal", F.lag("dailyValue", 1).over(p.along()))
    return p.with_rows(rows.withColumn("breaks", _flag(F.col("dailyValue"))))


def new_high_flags(net: DataFrame, window: int = NEW_HIGH_WINDOW,
                   chunk_rows: int | None = None) -> DataFrame:
    """maxValue, prevDailyVal and the new-high flag per row.

    flag = 1 when dailyValue >= max of the last `window` rows; then 0 when that
    max equals the previous row's value (plateau) or is 0.
    """
    return _flagged(net, window, chunk_rows).own()


def new_high_breaks(net: DataFrame, window: int = NEW_HIGH_WINDOW,
                    chunk_rows: int | None = None) -> DataFrame:
    return (new_high_flags(net, window, chunk_rows)
            .withColumn("test", F.lit(TEST_NEW_HIGH))
            .select(*FEED_COLUMNS))


def break_running_count(flags: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    """Running Σ of breaks per series, in series order."""
    return running_sum(placed(flags, 0, chunk_rows), "breaks", "count_breaks")


def new_high_running_count(net: DataFrame, window: int = NEW_HIGH_WINDOW,
                           chunk_rows: int | None = None) -> DataFrame:
    """``break_running_count(new_high_flags(net))`` over one numbering of the rows."""
    return running_sum(_flagged(net, window, chunk_rows), "breaks", "count_breaks")


def band_breaks(net: DataFrame, window: int = BAND_WINDOW, k: float = BAND_K,
                digits: int = ROUND_DIGITS, chunk_rows: int | None = None) -> DataFrame:
    """Retired band test: mean + k * sample std over `window` rows, each
    rounded; break when the value is above the bound; warm-up rows dropped."""
    p = rolling_moments(placed(net, window - 1, chunk_rows), "dailyValue", window, digits, "moving_avg", "moving_std")
    out = (p.own().where(F.col("moving_avg").isNotNull())
           .withColumn("moving_avg", round_half_even("moving_avg", digits))
           .withColumn("moving_std", round_half_even("moving_std", digits))
           .withColumn("upper_bound",
                       round_half_even(F.col("moving_avg") + F.col("moving_std") * k, digits)))
    return (out.withColumn("breaks", F.when(F.col("dailyValue") > F.col("upper_bound"), 1).otherwise(0).cast("int"))
            .withColumn("test", F.lit(TEST_NEW_HIGH)))
