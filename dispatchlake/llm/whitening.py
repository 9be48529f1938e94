"""PCA whitening of embeddings with distributed block matrices.

Entries are taken to a grid, x = floor(64 * c) + 1000000, so that equal vectors and sums are exact. The fit list
holds each distinct x vector once. Its rows, centred and numbered from 0, become a ``BlockMatrix``; transpose
times matrix gives the scatter, whose eigenvectors numpy finds (the scatter is as large as the number of
dimensions, not of rows); matrix times whitening matrix projects the rows. The middle dimension of each product
is cut into splits, so no task gets more than ``BLOCKS_A_SPLIT`` blocks. Rows with the same x share one projection.

Defined results: a row whose vector is null, empty or holds null or non-finite entries is left out; a row without
id stays, with a null id; repeated rows each get their result and count once in the fit; a component without variance
(eigenvalue within rounding of 0) is left out, so equal vectors only, or an empty table, give no rows; other columns
are ignored. Vectors of several lengths are an error. ``deviation`` is exact and fails beyond 64 bits.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispatchlake.session import settle

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
BLOCK_VALUES = 1 << 17  # of a block: 1 MB of doubles
BLOCKS_A_SPLIT = 16


def grid(vector: str) -> Column:
    return F.transform(F.col(vector).cast("array<double>"), lambda c: F.floor(c * SCALE) + SHIFT)


def finite(vector: str) -> Column:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def numbered(rows: DataFrame, label: str) -> DataFrame:
    """Rows of a fresh table with ``index`` from 0 without gaps: counts by part are added up, not the rows."""
    rows = settle(
        rows.withColumn("part", F.spark_partition_id()).withColumn(
            "at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        ),
        label,
    )
    counts = [(r["part"], r["count"]) for r in rows.groupBy("part").count().orderBy("part").collect()]
    before = np.cumsum([0, *(n for _, n in counts)])
    starts = rows.sparkSession.createDataFrame(
        [(p, int(b)) for (p, _), b in zip(counts, before)], "part int, before long"
    )  # a row for each task of the step before
    return rows.join(F.broadcast(starts), "part").withColumn("index", F.col("before") + F.col("at")).drop("part", "at", "before")


def block_matrix(rows: DataFrame, n: int, width: int) -> BlockMatrix:
    """Rows (index, values) as blocks of whole rows."""
    vectors = rows.select("index", array_to_vector("values").alias("vector"))
    indexed = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), n, width)
    return indexed.toBlockMatrix(max(1, BLOCK_VALUES // width), width)


def product(a: BlockMatrix, b: BlockMatrix) -> BlockMatrix:
    """a times b; the middle dimension in splits, each a task of its own."""
    splits = max(1, -(-a.numColBlocks // BLOCKS_A_SPLIT))
    java = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, a.rowsPerBlock, b.colsPerBlock)


def scatter(m: BlockMatrix) -> np.ndarray:
    """Transpose times matrix, a square of the number of columns."""
    return product(m.transpose(), m).toLocalMatrix().toArray()


def projected(m: BlockMatrix, onto: np.ndarray) -> DataFrame:
    """index, values: the rows of m times the local matrix."""
    spark = m.blocks.ctx
    local = Matrices.dense(*onto.shape, onto.flatten(order="F").tolist())
    right = BlockMatrix(spark.parallelize([((0, 0), local)], 1), *onto.shape)
    rows = callMLlibFunc("getIndexedRows", m.multiply(right).toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    rows = MLUtils.convertVectorColumnsToML(rows, "vector")
    return rows.select("index", vector_to_array("vector").alias("values"))


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: see the module."""
    rows = (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).alias("v"))
        .filter(finite("v"))
        .select("vec_id", grid("v").alias("x"))
    )
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fit = numbered(rows.select("x").distinct(), "whitening-fit")
    shape = fit.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("width")).first()
    n, width = shape["n"], shape["width"]
    if not n:
        return vectors.sparkSession.createDataFrame([], schema)
    if shape["least"] != width:
        raise ValueError("the vectors have several lengths")
    sums = [int(s) for s in fit.agg(*[F.sum(F.col("x")[i].cast("decimal(38,0)")) for i in range(width)]).first()]
    means = F.array(*[F.lit(s / n) for s in sums])
    centred = fit.select("index", F.zip_with("x", means, lambda a, b: a.cast("double") - b).alias("values"))
    blocks = block_matrix(centred, n, width)
    values, axes = np.linalg.eigh(scatter(blocks) / n)
    values, axes = values[::-1], axes[:, ::-1]
    trace = float(values.sum())
    kept = [i for i in range(min(components, width)) if values[i] > values[0] * width * np.finfo(float).eps]
    if not kept or values[0] <= 0:
        return vectors.sparkSession.createDataFrame([], schema)
    white = settle(projected(blocks, axes[:, kept] / np.sqrt(values[kept])), "whitening-rows")
    # rows were centred before the projection, so their covariance needs no further centring
    covariance = scatter(block_matrix(white, n, len(kept))) / n
    error = float(np.abs(covariance - np.eye(len(kept))).max())
    totals = F.array(*[F.lit(s).cast("long") for s in sums])
    gaps = F.zip_with("x", totals, lambda a, s: a * F.lit(n).cast("long") - s)
    by_vector = fit.join(white, "index").select(
        "x", "values", F.aggregate(gaps, F.lit(0).cast("long"), lambda total, g: total + g * g).alias("deviation")
    )
    explained = F.array(*[F.lit(float(values[i]) / trace) for i in kept])
    return (
        rows.join(by_vector, "x")
        .select("vec_id", "deviation", F.posexplode("values").alias("at", "whitened"))
        .select(
            "vec_id",
            (F.col("at") + 1).cast("int").alias("component"),
            F.lit(n).cast("long").alias("n"),
            "deviation",
            "whitened",
            explained[F.col("at")].alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
