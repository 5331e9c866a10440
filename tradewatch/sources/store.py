"""Written fact tables in the shared folder.

The position and fill facts the tests read are, in production, stored
tables. When they have to be derived (the driver's TPC-H-like tables), they
are written once as parquet under the shared folder (``spark.checkpoint.dir``),
range-partitioned on the load date so that date filters skip whole files by
their min/max statistics, and read back by every query of the session.
Writing them also cuts the lineage: a lost executor re-reads the written
files instead of replaying the source joins.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.session import shared_dir

# Source bytes per written file. Joined rows take several times their columnar
# source (about 4 times for the positions, shuffled, and more while they are
# sorted), and a file is the work of one task.
BYTES_PER_FILE = 16 << 20

#: Part of every table's key: raise it when what the adapters derive changes.
VERSION = 3

# One writer per table name within a process (queries may run in threads).
_LOCK = threading.Lock()


def file_system(spark: SparkSession, path: str):
    """(file system, path) of a path, by the session's Hadoop settings: a path
    without a scheme is on the cluster's default file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _fingerprint(spark: SparkSession, sources: list[str], schema: T.StructType) -> tuple[str, int]:
    """Hash of version, schema, and the sources' names, lengths, file counts and
    times; their total length."""
    h = hashlib.sha1(f"{VERSION}:{schema.json()}".encode())
    total = 0
    for s in sorted(sources):
        h.update(s.encode())
        fs, p = file_system(spark, s)
        if not fs.exists(p):
            continue
        c = fs.getContentSummary(p)
        total += c.getLength()
        h.update(f"{c.getLength()}:{c.getFileCount()}:{fs.getFileStatus(p).getModificationTime()}".encode())
    return h.hexdigest()[:16], total


def table_key(spark: SparkSession, name: str, sources: list[str], schema: T.StructType) -> str:
    """Name of a table derived from `sources` as they are now."""
    return f"{name}-{_fingerprint(spark, sources, schema)[0]}"


def written_table(spark: SparkSession, name: str, build: Callable[[], DataFrame],
                  sources: list[str], order_by: str, schema: T.StructType,
                  files: int | None = None) -> DataFrame:
    """The table `name` derived from `sources`, written once per fingerprint
    and read back with its declared `schema` (`files` fixes the file count,
    e.g. 1 for a small dimension)."""
    key, size = _fingerprint(spark, sources, schema)
    path = f"{shared_dir(spark).rstrip('/')}/tradewatch/tables/{name}-{key}"
    if _complete(spark, path):
        return spark.read.schema(schema).parquet(path)
    with _LOCK:
        if _complete(spark, path):
            return spark.read.schema(schema).parquet(path)
        return _write(spark, build, path, size, order_by, schema, files)


def _complete(spark: SparkSession, path: str) -> bool:
    """True when a committed write left its ``_SUCCESS`` marker (a write cut
    short by a failure is rewritten, not read)."""
    fs, marker = file_system(spark, f"{path}/_SUCCESS")
    return fs.exists(marker)


def _write(spark: SparkSession, build: Callable[[], DataFrame], path: str, size: int,
           order_by: str, schema: T.StructType, files: int | None = None) -> DataFrame:
    """Write the table into a private folder first, then rename it into place,
    so a concurrent process never sees half of it."""
    target = f"{path}.tmp-{uuid.uuid4().hex}"
    # At least one file per core so small tables still scan in parallel.
    n = files or max(spark.sparkContext.defaultParallelism, -(-size // BYTES_PER_FILE))
    # Range on (date, row hash): files cover date ranges (min/max skipping),
    # and a date holding a large share of the rows is split across files.
    cols = schema.fieldNames()
    spread = F.xxhash64(*cols).alias("_spread")
    (build().select(*cols, spread)
     .repartitionByRange(n, order_by, "_spread").sortWithinPartitions(order_by)
     .drop("_spread")
     .write.mode("overwrite").parquet(target))
    fs, src = file_system(spark, target)
    _, dst = file_system(spark, path)
    if fs.exists(dst) and not _complete(spark, path):            # a cut-short write
        fs.rename(dst, file_system(spark, f"{path}.incomplete-{uuid.uuid4().hex}")[1])
    # Another process may have won the race: then its table is read.
    if not fs.exists(dst) and not fs.rename(src, dst) and not _complete(spark, path):
        raise OSError(f"{target} can't be renamed to {path}")
    return spark.read.schema(schema).parquet(path)
