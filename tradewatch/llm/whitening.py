"""Embedding whitening with Spark MLlib's distributed BlockMatrix.

1. Entries become integers, so sums and deviations are exact; rows are numbered
   densely and their centred values grouped into blocks of BLOCK_ROWS rows,
   written as MLlib matrices to the shared folder.
2. The blocks are read as BlockMatrix. Its transpose times itself is the
   scatter matrix, a dimension by dimension matrix that alone reaches the driver
   (numpy's eigh gives its unit eigenvectors).
3. The BlockMatrix times the whitening matrix (eigenvectors over the roots of
   their eigenvalues) projects all rows; the same product of the projected rows
   with themselves tells how far their covariance is from the identity.

MLlib collects the places of a matrix' blocks and deals the result over about the
root of its partitions. Both are bounded by cutting the rows into groups of
GROUP_BLOCKS blocks, a BlockMatrix each: scatter matrices add up, projections
are appended. Everything but the small matrices stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewatch.llm.common import numbered
from tradewatch.session import scratch_path

#: Fixed values of the contract: an entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Entries at or beyond this magnitude are not whitened: their exact sums might not fit a long.
LARGEST = float(1 << 25)
#: Rows and columns of a block; blocks of rows in a group, and in a file.
BLOCK_ROWS, BLOCK_COLUMNS = 1024, 1024
GROUP_BLOCKS, FILE_BLOCKS = 8192, 128
#: Eigenvalues at or below this share of the largest are rounding: such directions can't be whitened.
RANK_SHARE = 1e-12

RESULT = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, "
          "identity_error double")
#: Blocks with the matrix as MLlib's type and as the plain columns it is stored as.
_PLACE = T.StructType([T.StructField("i", T.LongType()), T.StructField("j", T.LongType())])
_AS_MATRIX = T.StructType([T.StructField("place", _PLACE), T.StructField("matrix", MatrixUDT())])
_AS_COLUMNS = T.StructType([T.StructField("place", _PLACE), T.StructField("matrix", MatrixUDT.sqlType())])


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, x array<long>) of the vectors that take part, of any length but 0."""
    c = F.transform("embedding", lambda v: v.cast("double"))
    odd = F.exists("c", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) >= LARGEST))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), c.alias("c"))
            .where(F.col("c").isNotNull() & (F.size("c") > 0) & ~F.coalesce(odd, F.lit(True)))
            .select("vec_id", F.transform("c", lambda v: F.floor(v * SCALE) + SHIFT).alias("x")))


def _matrix(values, rows, columns, by_rows: bool):
    """Column: MLlib's columns of a dense matrix."""
    none = F.lit(None).cast("array<int>")
    return F.struct(F.lit(1).cast("byte").alias("type"), rows.cast("int").alias("numRows"),
                    columns.cast("int").alias("numCols"), none.alias("colPtrs"), none.alias("rowIndices"),
                    values.alias("values"), F.lit(by_rows).alias("isTransposed"))


class Blocks:
    """A tall matrix as written blocks, in groups of GROUP_BLOCKS blocks of rows."""

    def __init__(self, table: DataFrame, path: str, n_rows: int, n_columns: int):
        """`table`: place (i, j), matrix in MLlib's columns, and any others; written to `path`."""
        self.spark, self.path, self.n_rows, self.n_columns = table.sparkSession, path, n_rows, n_columns
        self.schema = table.schema
        group = F.expr(f"place.i div {GROUP_BLOCKS}")
        (table.withColumn("g", group).write.option("maxRecordsPerFile", FILE_BLOCKS).partitionBy("g").parquet(path))

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path).drop("g")

    def groups(self) -> Iterator[BlockMatrix]:
        for g in range(-(-self.n_rows // (BLOCK_ROWS * GROUP_BLOCKS))):
            first = g * GROUP_BLOCKS
            # Counted from the group's first block, so that the matrix has no empty rows of blocks.
            part = self.spark.read.schema(_AS_MATRIX).parquet(f"{self.path}/g={g}")
            part = part.select(F.struct((F.col("place.i") - first).alias("i"), F.col("place.j").alias("j")).alias("place"), "matrix")
            rows = min(self.n_rows - first * BLOCK_ROWS, GROUP_BLOCKS * BLOCK_ROWS)
            yield _block_matrix(part, BLOCK_ROWS, BLOCK_COLUMNS, rows, self.n_columns)

    def gram(self) -> np.ndarray:
        """The matrix' transpose times itself, on the driver: columns by columns numbers."""
        out = np.zeros((self.n_columns, self.n_columns))
        for a in self.groups():
            # The rows' blocks are added up in as many tasks as the group has blocks for.
            splits = max(1, min(a.numRowBlocks // 4, 4 * self.spark.sparkContext.defaultParallelism))
            product = a.transpose()._java_matrix_wrapper.call("multiply", a._java_matrix_wrapper._java_model, splits)
            out += BlockMatrix(product, BLOCK_COLUMNS, BLOCK_COLUMNS).toLocalMatrix().toArray()
        return (out + out.T) / 2

    def times(self, right: np.ndarray) -> DataFrame:
        """(place, matrix) of the blocks of the matrix times `right`."""
        cut = [((i // BLOCK_COLUMNS, 0), DenseMatrix(len(m), m.shape[1], m.flatten(order="F").tolist()))
               for i in range(0, len(right), BLOCK_COLUMNS) for m in [right[i:i + BLOCK_COLUMNS]]]
        small = _block_matrix(self.spark.createDataFrame(cut, _AS_MATRIX), BLOCK_COLUMNS, BLOCK_COLUMNS, *right.shape)
        found = []
        for g, a in enumerate(self.groups()):
            product = callMLlibFunc("getMatrixBlocks", a.multiply(small)._java_matrix_wrapper._java_model)
            place, matrix = product.columns
            found.append(product.select(
                F.struct((F.col(f"{place}._1") + g * GROUP_BLOCKS).cast("long").alias("i"),
                         F.col(f"{place}._2").cast("long").alias("j")).alias("place"), F.col(matrix).alias("matrix")))
        path = scratch_path(self.spark, "llm/product")
        reduce(DataFrame.union, found).write.option("maxRecordsPerFile", FILE_BLOCKS).parquet(path)
        return self.spark.read.schema(_AS_COLUMNS).parquet(path)


def _block_matrix(blocks: DataFrame, *sizes: int) -> BlockMatrix:
    return BlockMatrix(callMLlibFunc("createBlockMatrix", blocks, *sizes), *sizes)


def centred_blocks(rows: DataFrame, n: int, sums: list[int]) -> Blocks:
    """Blocks of x - S / n with their rows' (vec_id, deviation) beside the first column block."""
    d = len(sums)
    total = F.array(*[F.lit(s).cast("long") for s in sums])
    apart = F.zip_with("x", total, lambda x, s: x * F.lit(n).cast("long") - s)
    zero = F.lit(0).cast("decimal(38,0)")
    square = F.aggregate("apart", zero, lambda a, v: (a + v.cast("decimal(19,0)") * v.cast("decimal(19,0)")).cast("decimal(38,0)"))
    placed = (rows.select(F.expr(f"row div {BLOCK_ROWS}").alias("i"), "row", "vec_id", apart.alias("apart"))
              .select("i", "row", "vec_id", square.alias("deviation"),
                      F.transform("apart", lambda v: v.cast("double") / F.lit(float(n))).alias("c")))
    # A block's rows are BLOCK_ROWS at most.
    grouped = placed.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("row", "vec_id", "deviation", "c"))).alias("r"))
    j = F.explode(F.sequence(F.lit(0).cast("long"), F.lit((d - 1) // BLOCK_COLUMNS).cast("long")))
    cut = grouped.select("i", "r", j.alias("j"))
    width = F.least(F.lit(BLOCK_COLUMNS), d - F.col("j") * BLOCK_COLUMNS).cast("int")
    values = F.flatten(F.transform("r", lambda r: F.slice(r["c"], (F.col("j") * BLOCK_COLUMNS + 1).cast("int"), width)))
    members = F.when(F.col("j") == 0, F.transform("r", lambda r: F.struct(r["vec_id"].alias("vec_id"), r["deviation"].alias("deviation"))))
    table = cut.select(F.struct("i", "j").alias("place"), _matrix(values, F.size("r"), width, True).alias("matrix"),
                       members.alias("members"))
    return Blocks(table, scratch_path(rows.sparkSession, "llm/centred"), n, d)


def _recentred(product: DataFrame, n: int, k: int) -> Blocks:
    """The projected rows less their means (which differ from 0 by rounding)."""
    m, at = F.col("matrix.numRows"), F.col("matrix.values")
    column = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("c")
    part = product.select(at.alias("v"), m.alias("m"), column)
    sums = (part.groupBy("c").agg(F.sum(F.aggregate(F.expr("slice(v, c * m + 1, m)"), F.lit(0.0), lambda a, v: a + v)).alias("s"))
            .orderBy("c").collect())
    means = F.array(*[F.lit(r["s"] / n) for r in sums])
    values = F.transform(at, lambda v, i: v - F.element_at(means, (F.floor(i / m) + 1).cast("int")))
    table = product.select("place", _matrix(values, m, F.col("matrix.numCols"), False).alias("matrix"))
    return Blocks(table, scratch_path(product.sparkSession, "llm/whitened"), n, k)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation decimal(38,0), whitened, explained, identity_error) of each vector that
    takes part and each of the first `components` components of the vectors' covariance.

    Vectors that are null, empty, of a length other than the most common one (ties: the shorter), hold null or
    non-finite entries, or entries of LARGEST or more take no part; rows with a null id do and keep it. Repeated
    rows are rows of their own. Components without variance (eigenvalues that are rounding only) are left out, so
    equal vectors, or a single one, give no rows; so does an empty table. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = numbered(usable(vectors), "vectors")
    length = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if length is None:
        return spark.createDataFrame([], RESULT)
    if rows.where(F.size("x") != length["d"]).limit(1).count():
        rows = numbered(rows.where(F.size("x") == length["d"]).select("vec_id", "x"), "vectors")
    per_entry = (rows.select(F.posexplode("x").alias("p", "v")).groupBy("p").agg(F.sum("v").alias("s"), F.count("*").alias("n"))
                 .orderBy("p").collect())
    n, sums = per_entry[0]["n"], [r["s"] for r in per_entry]

    blocks = centred_blocks(rows, n, sums)
    scatter = blocks.gram() / n
    e, vector = np.linalg.eigh(scatter)
    order = np.argsort(-e, kind="stable")
    e, vector = e[order], vector[:, order]
    k = min(components, int((e > max(e[0], 0.0) * RANK_SHARE).sum()))
    if not k:
        return spark.createDataFrame([], RESULT)

    product = blocks.times(vector[:, :k] / np.sqrt(e[:k]))
    error = float(np.abs(_recentred(product, n, k).gram() / n - np.eye(k)).max())
    members = blocks.rows().where("place.j = 0").select(F.col("place.i").alias("i"), "members")
    shares = F.array(*[F.lit(float(v)) for v in e[:k] / scatter.trace()])
    found = (members.join(product.select(F.col("place.i").alias("i"), "matrix"), "i")
             .select(F.posexplode("members").alias("p", "r"), "matrix")
             .select("p", "r", "matrix", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("c")))
    at = F.when(F.col("matrix.isTransposed"), F.col("p") * k + F.col("c")).otherwise(F.col("c") * F.col("matrix.numRows") + F.col("p"))
    return found.select(
        F.col("r.vec_id").alias("vec_id"), (F.col("c") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"),
        F.col("r.deviation").alias("deviation"), F.get("matrix.values", at.cast("int")).alias("whitened"),
        F.get(shares, F.col("c")).alias("explained"), F.lit(error).alias("identity_error"))


def digest(whitened: DataFrame) -> DataFrame:
    """The result with the deviation as a long (null where it doesn't fit one)."""
    return whitened.withColumn("deviation", F.col("deviation").try_cast("long"))
