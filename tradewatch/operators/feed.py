"""The break feed: combine the tests, stage, append, audit."""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.params import TEST_DAY_TRADE, TEST_NEW_HIGH, TEST_TENOR
from tradewatch.schemas import AUDIT_SCHEMA, FEED_COLUMNS, FEED_SCHEMA

STAGE_SEP = "~"
STAGE_NULL = "\\N"   # null marker, so a null and an empty string stay distinct
PROCESS = "trade surveillance"
STEP_DONE = "Job Complete"
TESTS = (TEST_TENOR, TEST_DAY_TRADE, TEST_NEW_HIGH)


def combined_breaks(tests: list[DataFrame], since: dt.date,
                    until: dt.date | None = None) -> DataFrame:
    """Union of the tests' feeds by name; load date as a date; only days after
    `since` (drops the look-back rows the new-high windows needed) and, when
    given, up to `until` inclusive."""
    feed = reduce(lambda a, b: a.unionByName(b), [t.select(*FEED_COLUMNS) for t in tests])
    cond = F.col("loaddate") > F.lit(since)
    if until is not None:
        cond = cond & (F.col("loaddate") <= F.lit(until))
    return feed.withColumn("loaddate", F.to_date("loaddate")).where(cond)


def _fit(c: Column, target: T.DataType) -> Column:
    """Cast to the target column type; a bounded string is cut to its length
    first, as a cast to varchar(n) cuts."""
    if isinstance(target, (T.VarcharType, T.CharType)):
        return F.substring(c.cast("string"), 1, target.length).cast(target)
    return c.cast(target)


def cast_to_target(df: DataFrame, target: T.StructType) -> DataFrame:
    """Cast by ordinal position to the target's types and names."""
    if len(df.columns) != len(target.fields):
        raise ValueError(f"{len(df.columns)} columns ({', '.join(df.columns)}) for a {len(target.fields)}-column target "
                         f"({', '.join(target.fieldNames())})")
    return df.select(*[_fit(F.col(f"`{c}`"), f.dataType).alias(f.name)
                       for c, f in zip(df.columns, target.fields)])


def target_schema(spark: SparkSession, table: str) -> T.StructType:
    """The table's schema with bounded strings as such: Spark reads them back
    as plain strings and keeps the bound in the catalog."""
    fields, plain = [], spark.table(table).schema.fields
    for c, f in zip(spark.sql(f"DESCRIBE TABLE {table}").take(len(plain)), plain):
        m = re.fullmatch(r"(var)?char\((\d+)\)", c["data_type"])
        kind = (T.VarcharType if m[1] else T.CharType)(int(m[2])) if m else f.dataType
        fields.append(T.StructField(f.name, kind, f.nullable))
    return T.StructType(fields)


def append_feed(spark: SparkSession, df: DataFrame, table: str, convert: bool = True,
                path: str | None = None, audit: WriteAudit | None = None) -> None:
    """Append `df` to `table`, creating it (from `df`'s types) when absent; `audit` watches the rows written.

    convert=True: cast by position to the existing table's types, then insert
    by position. convert=False: insert as is, by position too, so mismatched
    types fail under the ANSI store-assignment policy instead of being coerced.
    """
    def watched(rows: DataFrame) -> DataFrame:
        return audit.watch(rows) if audit else rows

    if not spark.catalog.tableExists(table):
        kw = {"path": path} if path else {}
        spark.catalog.createTable(table, source="parquet", schema=df.schema, **kw)
        watched(df).write.insertInto(table)
        return
    if convert:
        cast_to_target(watched(df), target_schema(spark, table)).write.insertInto(table)
    else:
        watched(df).write.insertInto(table)


PARTITIONS = ["test", "loaddate"]


def replace_days(spark: SparkSession, feed: DataFrame, table: str, path: str | None = None,
                 since: dt.date | None = None, partitions: list[str] = PARTITIONS,
                 audit: WriteAudit | None = None) -> None:
    """Write `feed` into `table` (partitioned by test and load date), replacing
    only the tests and days present in `feed`; the table is created when absent.

    A rerun of a test's day replaces all of its rows, so the table never
    holds it twice (the alternative to appending); other tests' rows stay. With
    `since`, the feed is everything after that day: days that have lost all
    their rows go. Rows are dealt by partition first, so that a day is about
    one file and not one of every task."""
    cols = [c for c in feed.columns if c not in partitions] + partitions
    ordered = feed.select(*cols).repartition(*partitions)
    if audit:
        ordered = audit.watch(ordered)
    if not spark.catalog.tableExists(table):
        w = ordered.write.format("parquet").partitionBy(*partitions)
        if path:
            w = w.option("path", path)
        w.saveAsTable(table)
        return
    # insertInto takes the mode from the session only, so it is set for the write.
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        ordered.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(key, before)
    if since is not None:
        # Partition values only: bounded by the calendar.
        there = spark.table(table).where(F.col("loaddate") > F.lit(since)).select(*partitions).distinct()
        gone = there.join(feed.select(*partitions).distinct(), partitions, "left_anti").collect()
        for r in gone:
            spec = ", ".join(f"{c} = '{r[c]}'" for c in partitions)
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def stage_delimited(df: DataFrame, path: str, sep: str = STAGE_SEP,
                    encoding: str | None = None) -> None:
    """Headerless, index-free delimited files (the bulk-load staging format)."""
    w = (df.write.mode("error").option("sep", sep).option("header", "false")
         .option("nullValue", STAGE_NULL))
    if encoding:
        w = w.option("encoding", encoding)
    w.csv(path)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType = FEED_SCHEMA,
                   sep: str = STAGE_SEP) -> DataFrame:
    """Read staged files back with an explicit schema (no inference)."""
    return (spark.read.schema(schema).option("sep", sep).option("header", "false")
            .option("nullValue", STAGE_NULL).option("mode", "FAILFAST").csv(path))


def clean_message(c: Column | str) -> Column:
    """Quotes and commas stripped, so the message fits a quoted SQL literal."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, "[\"',]", "")


def run_audit(feed: DataFrame, process: str = PROCESS, step: str = STEP_DONE) -> DataFrame:
    """One audit row per test of a run: rows, breaks, date range, success."""
    return (feed.groupBy("test").agg(
                F.count(F.lit(1)).alias("rows"),
                F.sum("breaks").cast("long").alias("breaks"),
                F.min("loaddate").alias("min_date"),
                F.max("loaddate").alias("max_date"))
            .select(F.lit(process).alias("process"), F.lit(step).alias("step"), "test", "rows",
                    "breaks", "min_date", "max_date", F.lit(1).alias("success"),
                    clean_message(F.lit("")).alias("message"),
                    F.current_user().alias("run_user"),
                    F.current_timestamp().alias("run_ts")))


class WriteAudit:
    """Audit figures taken while a feed is written: no second job reads or recomputes it.

    ``watch`` goes right before the write, after any exchange, so each row is counted once."""

    def __init__(self, tests: tuple[str, ...] = TESTS):
        self.tests, self.observation = tests, Observation()

    def watch(self, feed: DataFrame) -> DataFrame:
        figures = []
        for i, test in enumerate(self.tests):
            of = F.col("test") == test
            figures += [F.count(F.when(of, 1)).alias(f"rows_{i}"),
                        F.coalesce(F.sum(F.when(of, F.col("breaks"))).cast("long"), F.lit(0).cast("long")).alias(f"breaks_{i}"),
                        F.min(F.when(of, F.col("loaddate"))).alias(f"min_{i}"), F.max(F.when(of, F.col("loaddate"))).alias(f"max_{i}")]
        return feed.observe(self.observation, *figures)

    def rows(self, spark: SparkSession, process: str = PROCESS, step: str = STEP_DONE) -> DataFrame:
        """One row per test with rows, as ``run_audit`` gives; none where nothing was written (a run
        that had been committed before)."""
        got = self.observation.get if self.written else {}
        found = [(process, step, test, got[f"rows_{i}"], got[f"breaks_{i}"], got[f"min_{i}"], got[f"max_{i}"], 1, "")
                 for i, test in enumerate(self.tests) if got.get(f"rows_{i}")]
        schema = T.StructType(AUDIT_SCHEMA.fields[:9])
        return spark.createDataFrame(found, schema).select(
            "*", F.current_user().alias("run_user"), F.current_timestamp().alias("run_ts"))

    @property
    def written(self) -> bool:
        return getattr(self.observation, "_jo", None) is not None


def audit_failure(spark: SparkSession, error: BaseException | str, process: str = PROCESS,
                  step: str = "Initializing") -> DataFrame:
    """The single audit row written when a run fails."""
    row = spark.createDataFrame([(process, step, str(error))], "process string, step string, m string")
    return row.select(
        "process", "step", F.lit(None).cast("string").alias("test"),
        F.lit(None).cast("long").alias("rows"), F.lit(None).cast("long").alias("breaks"),
        F.lit(None).cast("date").alias("min_date"), F.lit(None).cast("date").alias("max_date"),
        F.lit(0).alias("success"), clean_message("m").alias("message"),
        F.current_user().alias("run_user"), F.current_timestamp().alias("run_ts"))
