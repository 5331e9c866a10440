"""Query results of a database as a Spark table, through its Python driver (DB-API 2).

The original job pulled its inputs with queries over ODBC. Here such a query is a Spark data source: the driver
plans ranges of the load date, and each task opens a connection of its own, runs the query for its range and yields
Arrow batches of a fixed number of rows. A since-date, given or pushed down by Spark from a filter, moves the first
range, so earlier days are never fetched.

Contract. The columns asked for must be in the query's result (any order, any case of letters; others are not
fetched); a missing one, or a value that doesn't fit its type, ends the read with its name.

Tested with sqlite3, whose databases are files; any DB-API module works that the executors can import and whose
parameters are marked "?" (as ODBC's are).
"""

from __future__ import annotations

import datetime as dt
import decimal
import importlib
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_schema

from tradewatch.session import ship_code

BATCH_ROWS = 10_000
DAY = dt.timedelta(days=1)


@dataclass(frozen=True)
class Query:
    """A query and how to reach its database: ``connect(*arguments)`` of the DB-API `module`."""

    module: str
    arguments: tuple
    sql: str
    date_column: str = "loaddate"
    ranges: int = 64


@dataclass
class DateRange(InputPartition):
    """Days from `first` up to, not including, `end`; both None: rows without a day."""

    first: str | None
    end: str | None


class QueryReader(DataSourceReader):
    def __init__(self, schema: T.StructType, query: Query, since: dt.date | None):
        self.schema, self.query = schema, query
        self.first, self.last = since + DAY if since else None, None
        self.bounded = since is not None

    def _connect(self):
        return importlib.import_module(self.query.module).connect(*self.query.arguments)

    def partitions(self) -> Sequence[InputPartition]:
        """The days that the query has within the bounds, in `ranges` ranges of about as many days; and the
        rows without a day, if no bound leaves them out."""
        con, c = self._connect(), self.query.date_column
        try:
            low, high, empty = con.cursor().execute(
                f"SELECT min({c}), max({c}), sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) FROM ({self.query.sql}) q").fetchone()
        finally:
            con.close()
        out = [DateRange(None, None)] if empty and not self.bounded else []
        if low is None:
            return out
        low, high = max(_date(low), self.first or dt.date.min), min(_date(high), self.last or dt.date.max)
        days = (high - low).days + 1
        n = min(self.query.ranges, days)
        cuts = [low + dt.timedelta(days=days * i // n) for i in range(n + 1)] if days > 0 else []
        return out + [DateRange(a.isoformat(), b.isoformat()) for a, b in zip(cuts, cuts[1:])]

    def read(self, partition: DateRange | None) -> Iterator[pa.RecordBatch]:
        if partition is None:                   # what Spark passes where no range was planned
            return
        con, c = self._connect(), self.query.date_column
        try:
            cursor = con.cursor()
            cursor.execute(f"SELECT * FROM ({self.query.sql}) q LIMIT 0")
            there = {d[0].lower(): d[0] for d in cursor.description}
            missing = [n for n in self.schema.fieldNames() if n.lower() not in there]
            if missing:
                raise ValueError(f"the query has no column {', '.join(missing)}")
            names = ", ".join('"' + there[n.lower()] + '"' for n in self.schema.fieldNames())
            where, given = (f"{c} IS NULL", ()) if partition.first is None else (f"{c} >= ? AND {c} < ?", (partition.first, partition.end))
            cursor.execute(f"SELECT {names} FROM ({self.query.sql}) q WHERE {where}", given)
            target = to_arrow_schema(self.schema)
            while rows := cursor.fetchmany(BATCH_ROWS):
                yield pa.RecordBatch.from_arrays(
                    [_column(f, column) for f, column in zip(self.schema.fields, zip(*rows))], schema=target)
        finally:
            con.close()


class PushedQueryReader(QueryReader):
    """With filters from Spark (which refuses a reader that takes filters while the session has them off)."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Day bounds narrow the ranges; Spark applies every filter to the rows as well."""
        for f in filters:
            if getattr(f, "attribute", None) == (self.query.date_column,) and isinstance(getattr(f, "value", None), dt.date):
                kind = type(f)
                if kind in (GreaterThan, GreaterThanOrEqual, EqualTo):
                    low = f.value + DAY if kind is GreaterThan else f.value
                    self.first, self.bounded = max(self.first or low, low), True
                if kind in (LessThan, LessThanOrEqual, EqualTo):
                    high = f.value - DAY if kind is LessThan else f.value
                    self.last, self.bounded = min(self.last or high, high), True
            yield f


def _date(v) -> dt.date:
    return v.date() if isinstance(v, dt.datetime) else v if isinstance(v, dt.date) else dt.date.fromisoformat(str(v)[:10])


def _column(f: T.StructField, values: Sequence) -> pa.Array:
    """Values of one column in the type asked for: dates may come as ISO text, decimals as numbers."""
    t = to_arrow_schema(T.StructType([f])).field(0).type
    try:
        if isinstance(f.dataType, T.DateType):
            values = [None if v is None else _date(v) for v in values]
        elif isinstance(f.dataType, T.DecimalType):
            step = decimal.Decimal(1).scaleb(-f.dataType.scale)
            values = [None if v is None else decimal.Decimal(str(v)).quantize(step) for v in values]
        elif isinstance(f.dataType, T.StringType) and not all(v is None or isinstance(v, str) for v in values):
            raise TypeError("a value is no text")
        return pa.array(values, t)
    except (pa.ArrowException, ValueError, TypeError, ArithmeticError) as e:
        raise ValueError(f"column {f.name} holds a value that is no {f.dataType.simpleString()}: {e}") from e


class QuerySource(DataSource):
    """Format ``dbapi_query`` (see ``read_query``, which sets its options)."""

    @classmethod
    def name(cls) -> str:
        return "dbapi_query"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        found = json.loads(self.options["query"])
        since = self.options.get("since")
        query = Query(**{**found, "arguments": tuple(found["arguments"])})
        kind = PushedQueryReader if self.options.get("push") == "true" else QueryReader
        return kind(schema, query, dt.date.fromisoformat(since) if since else None)


def read_query(spark: SparkSession, query: Query, schema: T.StructType, since: dt.date | None = None) -> DataFrame:
    """The query's rows with the columns of `schema`; with `since`, of the days after it. Filters on the day are
    pushed down where the session's `spark.sql.python.filterPushdown.enabled` is on."""
    ship_code(spark)
    spark.dataSource.register(QuerySource)
    r = spark.read.format("dbapi_query").schema(schema).option("query", json.dumps(query.__dict__))
    r = r.option("push", spark.conf.get("spark.sql.python.filterPushdown.enabled"))
    return (r.option("since", since.isoformat()) if since else r).load()
