"""Fill groups kept as a table and brought up to date by day.

The day-trade test reads sums of fills by load date and group keys (``daytrades.fill_groups``), not
the fills. They are kept as a versioned table: when days of fills arrive, or are delivered anew, only these
days are summed, and their groups replace the ones held. A group never spans load dates, so the
sums of a day depend on that day's fills alone.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.operators.daytrades import GROUP_KEYS, fill_groups
from tradewatch.params import FillRules
from tradewatch.sources.versioned import Commit, DayTable

_TYPES = {"trade_date": T.DateType(), "position_month": T.DateType(), "strike_price": T.DoubleType()}
#: Sums of decimal(12,2), as Spark types them.
SUM = T.DecimalType(22, 2)
GROUPS_SCHEMA = T.StructType(
    [T.StructField("load_date", T.DateType())]
    + [T.StructField(k, _TYPES.get(k, T.StringType())) for k in GROUP_KEYS]
    + [T.StructField("kept", T.BooleanType()), T.StructField("counted", T.BooleanType()),
       T.StructField("qty", SUM), T.StructField("pnl", SUM)])


class FillView:
    """The groups below `path`, under one set of rules (they decide which fills are kept and counted)."""

    def __init__(self, spark: SparkSession, path: str, rules: FillRules):
        self.rules = rules
        mark = hashlib.sha1(repr(rules).encode()).hexdigest()[:12]
        self.table = DayTable(spark, f"{path.rstrip('/')}/{mark}", GROUPS_SCHEMA, day="load_date", keys=("load_date",))

    def build(self, fills: DataFrame, run: str) -> Commit:
        """Sum all fills (the first run)."""
        return self.table.replace(fill_groups(fills, self.rules), run, since=dt.date.min)

    def refresh(self, fills: DataFrame, days: list[dt.date], run: str) -> Commit:
        """Sum the fills of `days` anew; the filter reaches their scan. A day that has lost all of its fills loses
        its groups. A committed run id changes nothing."""
        spark = self.table.spark
        arrived = spark.createDataFrame([(d,) for d in days], "load_date date")
        fresh = fill_groups(fills.where(F.col("load_date").isin(days)), self.rules)
        return self.table.replace(fresh, run, also=arrived)

    def groups(self, since: dt.date) -> DataFrame:
        """The groups loaded after `since`; files of earlier days are not read."""
        return self.table.read(first=since + dt.timedelta(days=1))
