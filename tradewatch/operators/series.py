"""Row windows over series that need no frame of their own per row.

Order. ``in_order`` numbers all rows in the order of (series, date, subdivision): the rows are
range-partitioned and sorted, each row's place within its partition is written with it, and the
partitions' starts, a prefix sum over one row a partition, are added. Neither a series nor a month
is ever one task's work: ``chunked`` cuts the numbered rows into chunks of equal length,
wherever series begin and end, with a halo of the rows that a window reaches back to.

Rolling maximum. A frame of `window` rows that ends at row i covers the end of one aligned block
of `window` rows and the head of the next (or exactly one). With the running maximum of each block
from its head and from its end, the answer is the greater of the value at i and the value
``window - 1`` rows before: two growing frames and a look-back instead of a frame rebuilt for each row.

Moments. Sums of x and x squared over `window` rows are differences of running sums, which are exact
integers of 10**-digits, so nothing cancels.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewatch.session import scratch_path

SERIES = ["poscommodity", "trader"]
ORDER = ["loaddate", "subdivision"]
#: Values at or beyond this are refused by the moments: their squares' running sums might not fit a decimal.
LARGEST = 1e10


def in_order(net: DataFrame) -> DataFrame:
    """`net` with ``_g``, each row's place (0 to n - 1) in the order of (series, date, subdivision).

    The ordered rows are written to the shared folder, which also cuts the lineage."""
    spark = net.sparkSession
    path = scratch_path(spark, "series")
    ordered = (net.repartitionByRange(*SERIES, *ORDER).sortWithinPartitions(*SERIES, *ORDER)
               .withColumn("_at", F.monotonically_increasing_id()))
    ordered.write.parquet(path)
    rows = spark.read.schema(ordered.schema).parquet(path)
    part = F.shiftrightunsigned("_at", 33)
    counts = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)
    return rows.withColumn("_part", part).join(starts, "_part").select(*net.columns, place.alias("_g"))


@dataclass(frozen=True)
class Placed:
    """Rows with their place ``_g`` and the keys within which windows run; rows marked ``_halo`` are
    repeated from the chunk before and no rows of the result."""

    rows: DataFrame
    keys: list[str]

    def along(self) -> Window:
        """A key's rows in order (by block first where there are blocks: the same order)."""
        order = ["_block", "_g"] if "_block" in self.rows.columns else ["_g"]
        return Window.partitionBy(*self.keys).orderBy(*order)

    def with_rows(self, rows: DataFrame) -> Placed:
        return Placed(rows, self.keys)

    def own(self, *columns: str) -> DataFrame:
        """The rows without the halo, and without the helper columns but `columns`."""
        out = self.rows.where(~F.col("_halo"))
        return out.select(*[c for c in out.columns if not c.startswith("_") or c in columns])


def whole(net: DataFrame) -> Placed:
    """Each series as one group, numbered by itself."""
    number = F.row_number().over(Window.partitionBy(*SERIES).orderBy(*ORDER)).cast("long") - 1
    return Placed(net.select("*", number.alias("_g"), F.lit(False).alias("_halo")), SERIES)


def chunked(net: DataFrame, halo: int, chunk_rows: int) -> Placed:
    """Chunks of `chunk_rows` rows in order; the last `halo` rows of each are repeated at the head of the next."""
    if chunk_rows < max(halo, 1):
        raise ValueError(f"chunks of {chunk_rows} rows can't hold a halo of {halo}")
    chunk = F.expr(f"_g div {chunk_rows}")
    in_halo = F.col("_g") % chunk_rows >= chunk_rows - halo
    copies = F.when(in_halo, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    rows = (in_order(net).withColumn("_halo", F.explode(copies))
            .withColumn("_chunk", chunk + F.col("_halo").cast("long")))
    # Dealt once, by chunk alone: all windows within a chunk run on this one exchange.
    rows = rows.repartition("_chunk")
    return Placed(rows, ["_chunk", *SERIES])


def placed(net: DataFrame, halo: int, chunk_rows: int | None) -> Placed:
    return whole(net) if chunk_rows is None else chunked(net, halo, chunk_rows)


def rolling_max(p: Placed, value: str, window: int, name: str) -> Placed:
    """Adds `name`: the maximum of the last `window` rows, the row's own included; null until there are as many.

    `value` holds no nulls. Blocks are aligned to ``_g``, whatever series they belong to: a row
    ``window - 1`` rows back in the same series is all that a full frame needs."""
    rows = p.rows.withColumn("_block", F.expr(f"_g div {window}"))
    grow = (Window.unboundedPreceding, Window.currentRow)
    block = Window.partitionBy(*p.keys, "_block")
    rows = rows.withColumn("_back", F.max(value).over(block.orderBy(F.desc("_g")).rowsBetween(*grow)))
    rows = rows.withColumn("_fore", F.max(value).over(block.orderBy("_g").rowsBetween(*grow)))
    along = p.with_rows(rows).along()
    back = F.lag("_back", window - 1).over(along)
    return p.with_rows(rows.withColumn(name, F.when(back.isNotNull(), F.greatest("_fore", back))).drop("_back", "_fore"))


def rolling_moments(p: Placed, value: str, window: int, digits: int, mean: str, std: str) -> Placed:
    """Adds the mean and the sample deviation of the last `window` rows; null until there are as many.

    `value` is a multiple of 10**-digits below LARGEST in magnitude (other values end the job)."""
    unit = float(10 ** digits)
    v = F.col(value)
    number = F.when(F.abs(v) < LARGEST, F.rint(v * unit).cast(f"decimal({11 + digits},0)")).otherwise(
        F.raise_error(F.concat(F.lit(f"{value} is too large for exact moments: "), v.cast("string"))))
    rows = p.rows.withColumn("_x", number)
    grow = p.along().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select("*", F.sum("_x").over(grow).alias("_s1"), F.sum(F.col("_x") * F.col("_x")).over(grow).alias("_s2"))

    def within(total: str) -> Column:
        before = F.lag(total, window).over(p.along())
        return F.col(total) - F.coalesce(before, F.lit(0).cast("decimal(38,0)"))

    full = F.lag("_s1", window - 1).over(p.along()).isNotNull()
    rows = rows.select("*", within("_s1").alias("_d1"), within("_s2").alias("_d2"), full.alias("_full"))
    apart = (F.col("_d2") * window - F.col("_d1") * F.col("_d1")).cast("double")
    variance = F.try_divide(apart, F.lit(float(window * (window - 1)))) / F.lit(unit * unit)
    return p.with_rows(rows.withColumn(mean, F.when(F.col("_full"), F.col("_d1").cast("double") / F.lit(window * unit)))
                       .withColumn(std, F.when(F.col("_full"), F.sqrt(variance)))
                       .drop("_x", "_s1", "_s2", "_d1", "_d2", "_full"))


def running_sum(p: Placed, value: str, name: str) -> DataFrame:
    """The rows with `name`: the sum of `value` from the series' first row on.

    Within a chunk it grows along the rows; a chunk's totals of a series are added to the chunks after it (a table
    of one row for each series of a chunk)."""
    own = p.rows.where(~F.col("_halo"))
    grow = p.along().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = own.withColumn("_run", F.sum(value).over(grow).cast("long"))
    if "_chunk" not in p.keys:
        return p.with_rows(rows.withColumn(name, F.col("_run"))).own()
    totals = own.groupBy(*p.keys).agg(F.sum(value).cast("long").alias("_total"))
    before = Window.partitionBy(*SERIES).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    # Only a chunk's first series can have begun before it: at most one row a chunk is left.
    carried = totals.withColumn("_carry", F.sum("_total").over(before)).where(F.col("_carry") != 0).drop("_total")
    total = F.coalesce("_carry", F.lit(0).cast("long")) + F.col("_run")
    return p.with_rows(rows.join(carried, p.keys, "left").select(*own.columns, total.alias(name))).own()
