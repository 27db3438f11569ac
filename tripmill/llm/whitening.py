"""Whitening of vectors with Spark's distributed block matrices.

Vectors become fixed-point longs, so their sums, and with them the centred rows, are
exact before the first rounding. Centred rows get consecutive indices and are laid out
as the blocks of a BlockMatrix; its transpose times itself is the scatter matrix, whose
eigenvectors, found locally, give the whitening matrix, and the block matrix times that
one projects all rows. The product of the projection with itself shows how far its
covariance is from the identity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import numbered, saved

FITS = 1 << 62  # what 64-bit sums may reach


@dataclass(frozen=True)
class Whitening:
    """Entries become floor(``scale`` * c) + ``shift``; ``components`` at most are returned.

    ``block_rows`` is the least number of rows of a block. It grows so that there are at
    most ``most_blocks``, as multiplying sends the blocks' places to the driver.
    ``largest`` is the absolute value beyond which an entry counts as non-finite: a
    fixed-point long would no longer hold it exactly.
    """

    components: int = 32
    scale: int = 64
    shift: int = 1_000_000
    block_rows: int = 1024
    most_blocks: int = 65_536
    largest: float = 2.0**44


def fixed_point(vectors: DataFrame, p: Whitening) -> DataFrame:
    """(vec_id, x) of the rows whose ``embedding`` is not null and holds finite numbers only."""
    c = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), c.alias("c"))
    # a comparison with NaN is true in Spark for "greater", so NaN is out as well; a null entry is not true
    fine = F.forall("c", lambda v: F.coalesce(F.abs(v) <= p.largest, F.lit(False)))
    x = F.transform("c", lambda v: F.floor(v * p.scale).cast("long") + p.shift)
    return rows.filter(F.col("c").isNotNull() & fine).select("vec_id", x.alias("x"))


def _padded(lists: list, width: int, p: Whitening) -> np.ndarray:
    """Rows of equal width; an entry that a vector lacks is the fixed point of 0."""
    out = np.full((len(lists), width), p.shift, np.int64)
    for row, values in zip(out, lists):
        row[: len(values)] = values
    return out


def _partial_sums(width: int, p: Whitening):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * width, 0
        for batch in batches:
            x = _padded(batch.column(0).to_numpy(zero_copy_only=False), width, p)
            total = [a + b for a, b in zip(total, x.astype(object).sum(axis=0))] if len(x) else total
            n += len(x)
        if n:
            rows = [pa.array([-1, *range(width)], pa.int32()), pa.array([Decimal(v) for v in (n, *total)], pa.decimal128(38, 0))]
            yield pa.RecordBatch.from_arrays(rows, names=["dim", "total"])

    return run


def sums(fixed: DataFrame, width: int, p: Whitening) -> tuple[int, list[int]]:
    """The number of vectors and their exact sum by dimension; a task sends one row a dimension."""
    rows = fixed.select("x").mapInArrow(_partial_sums(width, p), "dim int, total decimal(38,0)")
    found = {r.dim: int(r.total) for r in rows.groupBy("dim").agg(F.sum("total").alias("total")).collect()}
    return found.get(-1, 0), [found.get(k, 0) for k in range(width)]


def _block_of_rows(width: int, n: int, total: list[int], p: Whitening):
    """One row a block: its vectors' ids, their exact deviations n * x - S squared and summed, and x - S / n."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row")
        x = _padded(rows["x"].to_list(), width, p)
        exact = np.int64 if n * int(np.abs(x).max(initial=1)) + max(map(abs, total), default=0) < FITS else object
        apart = x.astype(exact) * n - np.array(total, exact)
        if exact is np.int64 and int(np.abs(apart).max(initial=0)) ** 2 * max(width, 1) >= FITS:
            squares = (apart.astype(object) ** 2).sum(axis=1)
        else:
            squares = (apart**2).sum(axis=1)
        centred = (apart / n).astype(np.float64)
        return pd.DataFrame(
            {
                "block": [int(rows["block"].iloc[0])],
                "ids": [rows["vec_id"].tolist()],
                "deviations": [[Decimal(int(v)) for v in squares]],
                "centred": [np.asfortranarray(centred).tobytes(order="F")],
            }
        )

    return run


def _matrix(blocks: DataFrame, block_rows: int, width: int, n: int) -> BlockMatrix:
    """Saved blocks (block, centred) as a distributed matrix of one column of blocks."""

    def entry(row) -> tuple:
        values = np.frombuffer(row.centred, np.float64)
        return (row.block, 0), DenseMatrix(len(values) // width, width, values)

    return BlockMatrix(blocks.select("block", "centred").rdd.map(entry), block_rows, width, n, width)


def _own_product(matrix: BlockMatrix, splits: int, width: int) -> np.ndarray:
    """Transpose times matrix. The rows meet in ``splits`` tasks, whose small products are added up."""
    turned = matrix.transpose()
    # the Scala method has the number of splits as a second argument, its Python wrapper lacks it
    product = turned._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, width, width).toLocalMatrix().toArray()


def whitening_matrix(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Columns that whiten, the share of the variance of each, and how many of them have any.

    Components without variance, as of fewer vectors than dimensions, get a column of zeros.
    """
    values, columns = np.linalg.eigh((covariance + covariance.T) / 2)
    values, columns = values[::-1], columns[:, ::-1]
    whole, size = float(np.trace(covariance)), len(values)
    some = values > max(whole, 0.0) * size * 1e-13
    scale = np.where(some, 1 / np.sqrt(np.where(some, values, 1.0)), 0.0)
    k = min(components, size)
    shares = np.where(some, values, 0.0) / (whole or 1.0)
    return (columns * scale)[:, :k], shares[:k], int(some[:k].sum())


def _expanded(n: int, shares: np.ndarray, error: float):
    """From a block's ids and projection to one row a vector and component."""
    k = len(shares)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, deviations, values in zip(*(batch.column(c) for c in range(3))):
                rows = len(ids)
                z = np.frombuffer(values.as_py(), np.float64).reshape(k, rows).T
                place = pa.array(np.repeat(np.arange(rows), k))
                size = rows * k
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values.take(place),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                        pa.array(np.full(size, n, np.int64)),
                        deviations.values.take(place),
                        pa.array(np.ascontiguousarray(z).ravel()),
                        pa.array(np.tile(shares, rows)),
                        pa.array(np.full(size, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


RESULT = (
    "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
)


def whitened(vectors: DataFrame, p: Whitening = Whitening()) -> DataFrame:
    """One row for each usable row of ``vectors`` (vec_id, embedding) and component.

    Columns: vec_id, component (from 1, by falling variance), n, deviation (exact, as a
    decimal of 38 digits), whitened, explained, identity_error. Rows whose vector is null
    or holds a null or non-finite entry have no result and no part in the fit; an entry
    beyond ``largest`` counts as non-finite. A vector shorter than the longest has zeros
    for what it lacks. Rows that repeat are vectors of their own, also those without an
    id. A component without variance whitens to 0, explains 0 and has no part in
    identity_error, which is 0 where no component varies. No usable rows, or none with an
    entry, give no rows. Other columns are not read.

    The driver holds matrices of the vectors' width only, and one place a block.
    """
    spark = vectors.sparkSession
    fixed = numbered(fixed_point(vectors, p), "row")
    fixed = fixed.select(F.col("row"), "vec_id", "x")
    width = fixed.agg(F.max(F.size("x"))).first()[0] or 0
    if not width:
        return spark.createDataFrame([], RESULT)
    n, total = sums(fixed, width, p)
    block_rows = max(p.block_rows, -(-n // p.most_blocks))
    count = -(-n // block_rows)
    keyed = fixed.withColumn("block", F.floor(F.col("row") / block_rows).cast("int"))
    form = "block int, ids array<long>, deviations array<decimal(38,0)>, centred binary"
    blocks = saved(keyed.groupBy("block").applyInPandas(_block_of_rows(width, n, total, p), form))

    rows = _matrix(blocks, block_rows, width, n)
    scatter = _own_product(rows, count, width)
    whitening, shares, able = whitening_matrix(scatter / n, p.components)
    k = len(shares)
    turn = DenseMatrix(width, k, np.asfortranarray(whitening).ravel(order="F"))
    matrix = BlockMatrix(spark.sparkContext.parallelize([((0, 0), turn)], 1), width, k, width, k)
    projected = rows.multiply(matrix).blocks.map(lambda b: (b[0][0], bytearray(b[1].toArray().tobytes(order="F"))))
    projected = saved(spark.createDataFrame(projected, "block int, centred binary"))

    covariance = _own_product(_matrix(projected, block_rows, k, n), count, k) / n
    error = float(np.abs(covariance - np.eye(k))[:able, :able].max(initial=0.0))
    both = blocks.select(F.col("block").alias("own"), "ids", "deviations").join(projected, F.expr("own = block"))
    return both.select("ids", "deviations", "centred").mapInArrow(_expanded(n, shares, error), RESULT)
