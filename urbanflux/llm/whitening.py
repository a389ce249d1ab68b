"""Whitening of embeddings by distributed block matrices.

Entries become whole numbers, so sums and deviations are exact. The centred rows are
indexed from 0 and dealt into blocks of a BlockMatrix C; C' C is the scatter, a small
matrix that is decomposed where it arrives. C times the matrix of the first scaled
eigenvectors projects all rows, and the same product of the result with itself shows
how far its covariance is from the identity.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanflux.llm.common import ranked, written_table

SCALE, SHIFT = 1024.0, 100_000
COMPONENTS = 8
#: Entries beyond this count as this, so that whole numbers stay exact in doubles.
LARGEST = float(1 << 40)
#: Rows of a block, and most columns of one.
BLOCK_ROWS, BLOCK_COLUMNS = 4096, 1024
#: Blocks whose products are summed in one task before the partial sums meet.
MIDDLE_BLOCKS = 8
#: Eigenvalues below this share of the greatest count as zero.
TINY = 1e-12


def usable(embedding: Column) -> Column:
    finite = F.forall(embedding, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    return embedding.isNotNull() & F.coalesce(finite, F.lit(False))


def whole(embedding: Column) -> Column:
    def entry(c: Column) -> Column:
        return F.floor(SCALE * F.greatest(F.least(c.cast("double"), F.lit(LARGEST)), F.lit(-LARGEST))).cast("long") + SHIFT

    return F.transform(embedding, entry)


def _blocks(rows: DataFrame, entries: Column, n: int, width: int) -> BlockMatrix:
    """``rows`` by their index, dealt into blocks."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector(entries).alias("vector")), "vector")
    return IndexedRowMatrix(vectors, n, width).toBlockMatrix(BLOCK_ROWS, min(width, BLOCK_COLUMNS))


def _product(left: BlockMatrix, right: BlockMatrix, middle: int) -> np.ndarray:
    """``left`` times ``right`` as a small local matrix.

    The blocks along the shared side are cut into ``middle`` groups whose products are
    made apart and then added; without that all blocks would meet in one task.
    """
    java = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, middle)
    return BlockMatrix(java, left.rowsPerBlock, right.colsPerBlock).toLocalMatrix().toArray()


def _local_blocks(spark, matrix: np.ndarray, rows: int, columns: int) -> BlockMatrix:
    blocks = []
    for i, top in enumerate(range(0, matrix.shape[0], rows)):
        for j, left in enumerate(range(0, matrix.shape[1], columns)):
            part = matrix[top : top + rows, left : left + columns]
            blocks.append(((i, j), DenseMatrix(part.shape[0], part.shape[1], part.ravel(order="F"))))
    return BlockMatrix(spark.sparkContext.parallelize(blocks, 1), rows, columns, *matrix.shape)


class Whitening:
    """Statistics of the fit list and the matrix that whitens centred rows."""

    def __init__(self, n: int, sums: list[int], scatter: np.ndarray, components: int):
        values, vectors = np.linalg.eigh((scatter + scatter.T) / (2 * n))
        order = np.argsort(-values, kind="stable")[:components]
        self.n, self.sums = n, sums
        self.trace = float(np.trace(scatter)) / n
        self.values = values[order]
        self.known = self.values > TINY * max(float(values[-1]), 0.0)
        scale = np.where(self.known, 1.0 / np.sqrt(np.where(self.known, self.values, 1.0)), 0.0)
        self.matrix = vectors[:, order] * scale


def deviation(x: Column, n: int, sums: Column) -> Column:
    """Sum of (n x - S)^2 over the dimensions, exact."""
    squares = F.zip_with(x, sums, lambda a, s: (F.lit(n) * a - s).cast("decimal(19,0)"))
    return F.aggregate(squares, F.lit(0).cast("decimal(38,0)"), lambda t, d: (t + d * d).cast("decimal(38,0)"))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation (decimal), whitened, explained and identity_error.

    ``vectors`` has vec_id and embedding; other columns are not read. Vectors that are
    null or hold null or non-finite entries take no part. Repeated and null vec_ids are
    rows of their own. A shorter vector counts as filled up with zero entries; entries
    beyond 2^40 count as 2^40. One row comes back for each remaining row and each of the
    first ``components`` eigenvectors (all, if there are fewer dimensions), numbered by
    falling eigenvalue. Along an eigenvector without variance whitened is null, and
    identity_error leaves it out (null if none is left); without any variance explained
    is null. An empty table, or one of empty vectors, gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(usable(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    width = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    padded = F.concat("embedding", F.array_repeat(F.lit(0).cast("float"), F.lit(width) - F.size("embedding")))
    rows = rows.select("vec_id", F.monotonically_increasing_id().alias("row"), whole(padded).alias("x"))
    rows = ranked(rows, [], ["row"], "place").select((F.col("place") - 1).alias("index"), "vec_id", "x")
    rows = written_table(rows, "indexed")
    per_entry = rows.select(F.posexplode("x").alias("entry", "value")).groupBy("entry").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("sum"), F.count("*").alias("n"))
    found = per_entry.orderBy("entry").collect() if width else []
    if not found:
        return _result(rows.filter("false"), rows.filter("false").select("index", F.lit(None).cast("array<double>").alias("y")), None, None)
    n, sums = found[0].n, [int(r["sum"]) for r in found]
    means = F.array(*[F.lit(float(s / n)) for s in sums])
    centred = F.zip_with("x", means, lambda a, m: a.cast("double") - m)
    blocks = _blocks(rows, centred, n, width)
    middle = max(1, -(-n // (BLOCK_ROWS * MIDDLE_BLOCKS)))
    fit = Whitening(n, sums, _product(blocks.transpose(), blocks, middle), components)
    projected = blocks.multiply(_local_blocks(spark, fit.matrix, min(width, BLOCK_COLUMNS), fit.matrix.shape[1]))
    white = projected.toIndexedRowMatrix().rows.map(lambda r: (r.index, r.vector.toArray().tolist()))
    white = written_table(spark.createDataFrame(white, "index long, y array<double>"), "whitened")
    again = _blocks(white, F.col("y"), n, fit.matrix.shape[1])
    gap = np.abs(_product(again.transpose(), again, middle) / n - np.eye(fit.matrix.shape[1]))[np.ix_(fit.known, fit.known)]
    return _result(rows, white, fit, float(gap.max()) if gap.size else None)


def _result(rows: DataFrame, white: DataFrame, fit: Whitening | None, error: float | None) -> DataFrame:
    whole_sum = "decimal(38,0)"
    if fit is None:
        n, far, shares, known = F.lit(None).cast("long"), F.lit(None).cast(whole_sum), F.array().cast("array<double>"), F.array().cast("array<boolean>")
    else:
        n, far = F.lit(fit.n).cast("long"), deviation(F.col("x"), fit.n, F.array(*[F.lit(s).cast("long") for s in fit.sums]))
        shares = F.array(*[F.lit(float(v / fit.trace) if fit.trace > 0 else None).cast("double") for v in fit.values])
        known = F.array(*[F.lit(bool(k)) for k in fit.known])
    joined = rows.select("index", "vec_id", far.alias("deviation")).join(white, "index")
    each = joined.select("vec_id", "deviation", F.posexplode("y").alias("at", "y"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), n.alias("n"), "deviation",
        F.when(F.get(known, F.col("at")), F.col("y")).alias("whitened"), F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
