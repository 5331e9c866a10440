"""Bulk load of delimited files that keeps good lines and reports the others.

Every line is parsed once, as text; a line that doesn't fit the target is a reject with its file, its text and the first
reason that holds:

* ``fields``: it has fewer or more fields than the target (separators within quotes are none),
* ``type``: a field is no value of its column's type,
* ``length``: a text is longer than its column's bound (an error here, where the appending cast cuts).

A load may be given the number of rejects it puts up with. Blank lines are skipped.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.operators.feed import STAGE_NULL, STAGE_SEP


class TooManyRejects(Exception):
    pass


def _n_fields(line: Column, sep: str) -> Column:
    """Separators outside quoted fields, and one. A backslash escapes a character of a quoted field."""
    mark = re.escape(sep)
    bare = F.regexp_replace(line, rf'(^|{mark})"(?:\\.|[^"\\])*"', "$1")
    return F.size(F.split(bare, mark, -1))


def _bound(t: T.DataType) -> int | None:
    return t.length if isinstance(t, (T.VarcharType, T.CharType)) else None


@dataclass(frozen=True)
class Load:
    """A parsed load: its good rows, of the target's types, and its rejects (file, line, reason, field)."""

    parsed: DataFrame
    schema: T.StructType

    @property
    def rows(self) -> DataFrame:
        return self.parsed.where("reason IS NULL").select(
            *[F.col(f"_v.{f.name}").alias(f.name) for f in self.schema.fields])

    @property
    def rejects(self) -> DataFrame:
        return self.parsed.where("reason IS NOT NULL").select("file", "line", "reason", "field")

    def within(self, max_rejects: int) -> DataFrame:
        """The good rows, if there are no more than `max_rejects` rejects (counted up to one more)."""
        found = self.rejects.limit(max_rejects + 1).collect()
        if len(found) > max_rejects:
            first = found[0]
            raise TooManyRejects(f"more than {max_rejects} lines don't fit, one of them ({first['reason']}, {first['field']}): "
                                 f"{first['line'][:200]}")
        return self.rows


def load_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = STAGE_SEP,
                   null: str = STAGE_NULL) -> Load:
    """Parse the files in `path` against `schema` (names and types, in the files' order)."""
    names = schema.fieldNames()
    lines = (spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("line"))
             .where(F.trim("line") != ""))
    texts = ", ".join(f"`{n}` string" for n in names)
    options = {"sep": sep, "nullValue": null, "mode": "PERMISSIVE"}
    parsed = lines.select("*", F.from_csv("line", texts, options).alias("_t"),
                          _n_fields(F.col("line"), sep).alias("_n"))
    plain = {f.name: T.StringType() if _bound(f.dataType) else f.dataType for f in schema.fields}
    cast = F.struct(*[F.col(f"_t.{n}").try_cast(plain[n]).alias(n) for n in names])
    parsed = parsed.select("*", cast.alias("_v"))

    def first(bad: dict[str, Column]) -> Column:
        """The name of the first field whose condition holds."""
        return F.coalesce(*[F.when(c, F.lit(n)) for n, c in bad.items()], F.lit(None).cast("string"))

    mistyped = first({n: F.col(f"_t.{n}").isNotNull() & F.col(f"_v.{n}").isNull() for n in names})
    long = first({f.name: F.char_length(f"_t.{f.name}") > _bound(f.dataType) for f in schema.fields if _bound(f.dataType)})
    return Load(parsed.select("file", "line", "_v", (F.col("_n") != len(names)).alias("_off"), mistyped.alias("_type"), long.alias("_long"))
                .select("file", "line", "_v",
                        F.when(F.col("_off"), "fields").when(F.col("_type").isNotNull(), "type")
                        .when(F.col("_long").isNotNull(), "length").alias("reason"),
                        F.when(~F.col("_off"), F.coalesce("_type", "_long")).alias("field")), schema)
