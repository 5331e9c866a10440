"""Tenor test: share of exposure beyond the horizon, per desk and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.operators.positions import SERIES_KEYS
from tradewatch.params import TENOR_SHARE_LIMIT, TEST_TENOR
from tradewatch.schemas import FEED_COLUMNS


def tenor_breaks(rows: DataFrame, limit: float = TENOR_SHARE_LIMIT) -> DataFrame:
    """One aggregation over flagged rows (one shuffle, no self-join):

    total  = Σ|delta| per (date, commodity, desk, subdivision)
    beyond = the same sum over rows flagged beyond the horizon
    share  = beyond / total when beyond > 0, else 0; break when share > limit.

    Rows with a null key are left out, as the grouping in the original did.
    """
    a = F.abs("delta")
    keyed = (rows.select("loaddate", F.col("commodity").alias("poscommodity"),
                         F.col("desk").alias("trader"), "subdivision",
                         "beyond_twelve_months", "delta")
             .dropna(subset=SERIES_KEYS))
    agg = keyed.groupBy(*SERIES_KEYS).agg(
        F.sum(a).cast("double").alias("total"),
        F.sum(F.when(F.col("beyond_twelve_months") == 1, a)).cast("double").alias("beyond"))
    beyond = F.coalesce(F.col("beyond"), F.lit(0.0))
    share = F.when(beyond > 0, beyond / F.col("total")).otherwise(F.lit(0.0))
    return (agg.withColumn("dailyValue", share.cast("double"))
            .withColumn("breaks", F.when(F.col("dailyValue") > limit, 1).otherwise(0).cast("int"))
            .withColumn("test", F.lit(TEST_TENOR))
            .select(*FEED_COLUMNS))
