"""A table of dated rows whose days are replaced, with one committed version at a time.

Rows lie in Parquet files of any number of days; a commit is a small JSON file that names all files of
a version with their row counts and first and last day (a zone map), and the run that wrote it.

* A run writes its rows to a folder of its own, computed once, and then commits. Commits are made by a rename that
  fails if the version exists, so of two writers one is told to look again; files without a commit are never read.
* A run id that has been committed is a no-op, so a retried run adds nothing.
* Replacing days reads only the files whose zone meets them and copies what stays; other files are kept as they are.
* Readers see the files of one version, whatever is written meanwhile, and with a range of days only those
  that can hold it.

File counts follow bytes, not days: rows are dealt by ranges of days and Spark joins small ranges.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.sources.store import file_system

#: Run ids that a commit remembers: a repeat is recognised within so many commits.
RUNS_KEPT = 1000
#: How often a writer looks again when others commit before it.
TRIES = 20


@dataclass(frozen=True)
class File:
    path: str                   # below the table's folder
    rows: int
    first: str | None           # days in ISO form; None: the file holds rows without a day only
    last: str | None

    def meets(self, first: str | None, last: str | None) -> bool:
        """May the file hold a day from `first` to `last` (None: open)?"""
        return self.first is None or ((last is None or self.first <= last) and (first is None or self.last >= first))


@dataclass(frozen=True)
class Commit:
    version: int
    run: str
    operation: str
    files: tuple[File, ...] = ()
    runs: tuple[str, ...] = field(default=(), repr=False)


EMPTY = Commit(0, "", "create")


class CommitConflict(Exception):
    """Another writer has committed the version."""


class DayTable:
    """The table below `path`; `keys` are the columns that a replacement goes by, `day` among them."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, day: str = "loaddate",
                 keys: tuple[str, ...] = ("test", "loaddate")):
        self.spark, self.path, self.schema, self.day, self.keys = spark, path.rstrip("/"), schema, day, keys

    # ---- versions

    def versions(self) -> list[int]:
        fs, log = file_system(self.spark, f"{self.path}/log")
        if not fs.exists(log):
            return []
        return sorted(int(s.getPath().getName()[:-5]) for s in fs.listStatus(log) if s.getPath().getName().endswith(".json"))

    def commit(self, version: int | None = None) -> Commit:
        """A version's commit, the last one's by default."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return EMPTY
        fs, p = file_system(self.spark, f"{self.path}/log/{version:020d}.json")
        stream = fs.open(p)
        try:
            found = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Commit(found["version"], found["run"], found["operation"], tuple(File(**f) for f in found["files"]), tuple(found["runs"]))

    def _publish(self, commit: Commit) -> None:
        fs, written = file_system(self.spark, f"{self.path}/log/.{uuid.uuid4().hex}")
        out = fs.create(written, False)
        out.write(json.dumps(asdict(commit)).encode())
        out.close()
        _, target = file_system(self.spark, f"{self.path}/log/{commit.version:020d}.json")
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        never_over = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(written, target, never_over)
        except Exception as e:
            fs.delete(written, False)
            if fs.exists(target):
                raise CommitConflict(f"version {commit.version} of {self.path} was committed by another run") from e
            raise

    # ---- reading

    def read(self, version: int | None = None, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """The rows of a version; with days, only theirs."""
        bounds = [d.isoformat() if d else None for d in (first, last)]
        out = self._rows([f for f in self.commit(version).files if first is last is None or f.meets(*bounds)])
        if first:
            out = out.where(F.col(self.day) >= F.lit(first))
        return out.where(F.col(self.day) <= F.lit(last)) if last else out

    def _rows(self, files: list[File]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f.path}" for f in files])

    # ---- writing

    def _stage(self, rows: DataFrame, watch: Callable[[DataFrame], DataFrame] | None = None) -> list[File]:
        """Write rows to a folder of their own; its files' zones. `watch` sees the rows as they are written."""
        folder = f"data/{uuid.uuid4().hex}"
        names = self.schema.fieldNames()
        # Ranges of days; a hot day's rows are told apart by their hash.
        spread = F.xxhash64(*names).alias("_spread")
        dealt = rows.select(*names, spread).repartitionByRange(self.day, "_spread").drop("_spread")
        (watch(dealt) if watch else dealt).write.parquet(f"{self.path}/{folder}")
        zones = (self.spark.read.schema(self.schema).parquet(f"{self.path}/{folder}")
                 .groupBy(F.col("_metadata.file_name").alias("name"))
                 .agg(F.count(F.lit(1)).alias("n"), F.min(self.day).alias("a"), F.max(self.day).alias("b")).collect())
        return [File(f"{folder}/{z['name']}", z["n"], z["a"] and z["a"].isoformat(), z["b"] and z["b"].isoformat()) for z in zones]

    def _committed(self, run: str, operation: str, files) -> Commit:
        """Commit what `files(previous commit)` names, looking again after other writers' commits."""
        for _ in range(TRIES):
            before = self.commit()
            if run in before.runs:
                return before
            done = Commit(before.version + 1, run, operation, tuple(files(before)), (*before.runs, run)[-RUNS_KEPT:])
            try:
                self._publish(done)
                return done
            except CommitConflict:
                continue
        raise CommitConflict(f"{TRIES} commits of {self.path} were made by others first")

    def append(self, rows: DataFrame, run: str, watch: Callable[[DataFrame], DataFrame] | None = None) -> Commit:
        """Add rows; a committed run id adds nothing."""
        before = self.commit()
        if run in before.runs:
            return before
        new = self._stage(rows, watch)
        return self._committed(run, "append", lambda c: [*c.files, *new])

    def replace(self, rows: DataFrame, run: str, since: dt.date | None = None, also: DataFrame | None = None,
                watch: Callable[[DataFrame], DataFrame] | None = None) -> Commit:
        """Replace the keys (tests' days) that `rows` holds, or that `also` names; with `since`, all rows after
        that day go, whether `rows` has their keys or not. A committed run id changes nothing."""
        before = self.commit()
        if run in before.runs:
            return before
        new = self._stage(rows, watch)
        gone = self._rows(new).select(*self.keys)
        if also is not None:
            gone = gone.union(also.select(*self.keys))
        gone = gone.distinct()
        first, last = gone.agg(F.min(self.day), F.max(self.day)).first()
        kept: dict[File, list[File]] = {}

        def remaining(old: list[File]) -> list[File]:
            same = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in self.keys])
            rest = self._rows(old).alias("l").join(gone.alias("r"), same, "left_anti")
            if since is not None:
                rest = rest.where(F.coalesce(F.col(self.day) <= F.lit(since), F.lit(True)))
            return self._stage(rest)

        def files(c: Commit) -> list[File]:
            bounds = [d.isoformat() if d else None for d in (first, last)]
            touched = [f for f in c.files if (first is not None and f.meets(*bounds)) or f.first is None
                       or (since is not None and f.last > since.isoformat())]
            if touched and (key := tuple(touched)) not in kept:
                kept[key] = remaining(touched)
            return [f for f in c.files if f not in touched] + (kept[tuple(touched)] if touched else []) + new

        return self._committed(run, "replace", files)

    def expire(self, versions: int = 1, hours: float = 24.0) -> int:
        """Drop all but the last `versions` versions, and folders that none of them names and that are older
        than `hours` (a run may still be writing younger ones). Returns the number of folders dropped."""
        all_versions = self.versions()
        kept = all_versions[-versions:]
        named = {f.path.rsplit("/", 1)[0] for v in kept for f in self.commit(v).files}
        fs, data = file_system(self.spark, f"{self.path}/data")
        for v in all_versions[:-versions]:
            fs.delete(file_system(self.spark, f"{self.path}/log/{v:020d}.json")[1], False)
        dropped = 0
        for s in (fs.listStatus(data) if fs.exists(data) else []):
            old = time.time() * 1000 - s.getModificationTime() > hours * 3_600_000
            if f"data/{s.getPath().getName()}" not in named and old:
                dropped += bool(fs.delete(s.getPath(), True))
        return dropped


__all__ = ["Commit", "CommitConflict", "DayTable", "File"]
