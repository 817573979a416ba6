"""Whitening of embeddings with distributed block matrices.

Every entry c becomes the integer x = floor(1024 c) + 100000. The rows are numbered without gaps, centred
and indexed into a ``BlockMatrix`` A of MLlib; A transposed times A is the scatter matrix, of which only
d x d numbers reach the driver. Its eigenvectors (``numpy.linalg.eigh``) over the square roots of the
eigenvalues are the whitening matrix, and A times that matrix projects all rows.

What bounds memory: a block holds about ``BLOCK_BYTES``; the inner dimension of the product is split so
that a task holds ``BLOCKS_PER_SPLIT`` blocks of each side and sends on one d x d sum. MLlib numbers rows of
blocks in 32 bits and keeps the blocks' keys on the driver, so more than ``SLAB_ROWS`` rows are several
matrices, whose scatters are added up. Besides, the driver holds matrices of d x d. Nothing is cached: a lost
executor's blocks are made again from the stored rows.

Exact numbers stay integers until they are centred: S is a sum of longs, n x - S is a long, and its square
is summed as a decimal. ``deviation`` is null where the sum does not fit in a long.

Defined results: rows whose vector is null, empty or holds a null, NaN or infinite entry are dropped. Vectors
of another length than the most frequent one (the longer of equals) cannot share a covariance and are dropped
as well. Rows with equal or null ids stay and have a result each. A component whose eigenvalue is zero to
double precision (constant vectors, fewer rows than dimensions) cannot be scaled: its rows are returned with
a null ``whitened``, and ``identity_error`` leaves it out (null if none is left). ``explained`` is null if no
row differs from the mean. An empty table gives an empty result. Further columns of the input are not read,
whatever their names.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regchron.llm.common import read_table, stored

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
BLOCK_BYTES = 2 << 20
BLOCKS_PER_SPLIT = 8
SLAB_ROWS = 1 << 30

# A number of a row within its partition takes 33 bits in monotonically_increasing_id.
_ROW_BITS = 33

_SCHEMA = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, x): the integer vectors of all rows that take part."""
    entries = F.col(embedding).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), entries.alias("c"))
    finite = F.forall("c", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    rows = rows.where(F.col("c").isNotNull() & (F.size("c") > 0) & finite)
    return rows.select("vec_id", F.transform("c", lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))


def numbered(rows: DataFrame, label: str) -> DataFrame:
    """The rows stored, with ``index`` 0, 1, ... without gaps.

    Rows are numbered within their partition when they are stored; a window over one row per
    partition adds what lies before it.
    """
    kept = stored(rows.withColumn("mark", F.monotonically_increasing_id()), label)
    part = F.shiftright("mark", _ROW_BITS)
    sizes = kept.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    before = sizes.selectExpr("part", "sum(size) OVER (ORDER BY part) - size AS before")
    within = F.col("mark").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        kept.withColumn("part", part).join(F.broadcast(before), "part")
        .withColumn("index", F.col("before") + within).drop("part", "before", "mark")
    )


def block_matrices(rows: DataFrame, n: int, dim: int, slab: int) -> list[BlockMatrix]:
    """Rows (index, centred) as blocks, ``slab`` rows to a matrix; columns stay in one block."""
    made = []
    for first in range(0, n, slab):
        own = rows.where((F.col("index") >= first) & (F.col("index") < first + slab))
        vectors = own.select((F.col("index") - first).alias("index"), array_to_vector("centred").alias("vector"))
        indexed = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), min(slab, n - first), dim)
        made.append(indexed.toBlockMatrix(max(1, BLOCK_BYTES // (8 * dim)), dim))
    return made


def multiplied(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """The product; ``splits`` tasks share the inner dimension of each block of it."""
    made = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(made, left.rowsPerBlock, right.colsPerBlock)


def scatter(centred: BlockMatrix) -> np.ndarray:
    """Sum over rows of the outer product of a row with itself."""
    splits = max(1, -(-centred.numRowBlocks // BLOCKS_PER_SPLIT))
    total = multiplied(centred.transpose(), centred, splits).toLocalMatrix().toArray()
    return (total + total.T) / 2


def principal(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues and their unit vectors as columns; values that are zero to precision are 0."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    noise = len(covariance) * np.finfo(float).eps * max(float(values[0]), 0.0)
    return np.where(values > noise, values, 0.0), vectors


def projected(centred: BlockMatrix, whitening: np.ndarray) -> DataFrame:
    """(index, whitened): all rows times the whitening matrix."""
    context = centred.blocks.ctx
    columns = whitening.shape[1]
    block = DenseMatrix(whitening.shape[0], columns, whitening.ravel(order="F").tolist())
    right = BlockMatrix(context.parallelize([((0, 0), block)], 1), whitening.shape[0], columns)
    product = multiplied(centred, right, 1).toIndexedRowMatrix()
    rows = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
    return MLUtils.convertVectorColumnsToML(rows, "vector").select("index", vector_to_array("vector").alias("whitened"))


def whiten(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    components: int = COMPONENTS,
    slab: int = SLAB_ROWS,
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per row and component."""
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, embedding)
    lengths = rows.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("n"))
    found = lengths.orderBy(F.desc("n"), F.desc("dim")).first()
    if found is None:
        return spark.createDataFrame([], _SCHEMA)
    n, dim = found["n"], found["dim"]
    rows = numbered(rows.where(F.size("x") == dim), "vectors")
    sums = rows.select(F.posexplode("x").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("s"))
    total = F.array(*[F.lit(r["s"]).cast("bigint") for r in sums.orderBy("at").collect()])

    off = rows.withColumn("off", F.zip_with("x", total, lambda x, s: x * F.lit(n).cast("bigint") - s))
    square = lambda v: (v.cast("decimal(19,0)") * v.cast("decimal(19,0)")).cast("decimal(38,0)")
    zero = F.lit(0).cast("decimal(38,0)")
    deviation = F.aggregate("off", zero, lambda t, v: (t + square(v)).cast("decimal(38,0)"))
    centred = off.select(
        "index", "vec_id", deviation.try_cast("bigint").alias("deviation"),
        F.transform("off", lambda v: v / F.lit(float(n))).alias("centred"),
    )

    matrices = block_matrices(centred, n, dim, slab)
    covariance = sum(scatter(m) for m in matrices) / n
    values, directions = principal(covariance, components)
    known = values > 0
    scaled = directions / np.sqrt(np.where(known, values, 1.0))
    white = [
        projected(m, scaled).withColumn("index", F.col("index") + i * slab) for i, m in enumerate(matrices)
    ]
    white = reduce(DataFrame.union, white)
    result = stored(centred.select("index", "vec_id", "deviation").join(white, "index").drop("index"), "whitened")

    trace = float(np.trace(covariance))
    kept = np.flatnonzero(known).tolist()
    pairs = [(i, j) for i in kept for j in kept if i <= j]
    error = None
    if pairs:
        entry = F.col("whitened")
        spread = result.agg(*[F.covar_pop(entry[i], entry[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
        error = max(abs(spread[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    explained = F.array(*[F.lit(float(v) / trace if trace > 0 else None).cast("double") for v in values])
    scalable = F.array(*[F.lit(bool(k)) for k in known])
    return result.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "value")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        F.when(F.get(scalable, F.col("at")), F.col("value")).alias("whitened"),
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def op13(spark, sf_dir: str) -> DataFrame:
    """All embeddings, the first eight components."""
    return whiten(read_table(spark, sf_dir, "embeddings"))
