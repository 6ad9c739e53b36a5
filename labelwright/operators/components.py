"""Principal components of tables of any width, by block Krylov iteration.

A scan multiplies the covariance matrix with a block of directions: each task centres its rows,
projects them on the block and adds up their products with the projections. The blocks, made
orthogonal to one another, span the space in which the components are sought, so a few scans
are enough even if the spectrum is flat, and the error of every component is known from the
products without a further scan. The driver holds a few blocks of as many numbers as there are
columns, never a matrix of columns by columns.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

EXTRA = 8
TOLERANCE = 1e-6
MOST_SCANS = 40
RESTART = 16


@dataclass(frozen=True)
class Components:
    """Axes by falling variance (component, column) and how well they are known.

    ``residual`` is the largest error |C v - s v| of an axis relative to the largest variance,
    ``skew`` the largest deviation of the axes from orthonormal ones.
    """

    mean: np.ndarray
    axes: np.ndarray
    variances: np.ndarray
    total_variance: float
    rows: int
    residual: float
    skew: float

    @property
    def ratios(self) -> list[float]:
        return [float(v / self.total_variance) if self.total_variance else 0.0 for v in self.variances]

    def project(self, x: Column) -> Column:
        """The array of a row's coordinates on the axes."""
        literal = lambda v: F.array(*[F.lit(float(a)) for a in v])
        centred = F.zip_with(x, literal(self.mean), lambda a, m: a - m)
        dot = lambda axis: F.aggregate(F.zip_with(centred, literal(axis), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        return F.array(*[dot(axis) for axis in self.axes])


def _summed(vectors: DataFrame, per_batch, size: int) -> np.ndarray:
    """Sum of an array over the rows (x), by task and then by position."""

    def add(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += per_batch(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["i", "v"])

    rows = vectors.mapInArrow(add, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(size)
    out[rows.column("i").to_numpy()] = rows.column("v").to_numpy()
    return out


def principal_components(vectors: DataFrame, k: int, tolerance: float = TOLERANCE, extra: int = EXTRA, seed: int = 0) -> Components:
    """The first k components of rows (x array<double>) without missing values.

    ``vectors`` is read once per scan; store it first if it is costly. Variances are those of a
    sample (n - 1). Stops at the tolerance, or after ``MOST_SCANS`` scans with the residual reached.
    """
    vectors = vectors.select(F.col("x").cast("array<double>").alias("x"))
    shape = vectors.agg(F.count("*").alias("n"), F.min(F.size("x")).alias("low"), F.max(F.size("x")).alias("high")).first()
    rows, dims = shape["n"], shape["low"]
    if not rows or dims != shape["high"] or k < 1 or k > dims:
        raise ValueError(f"components need rows of one length of at least {k}")
    mean = _summed(vectors, lambda x: x.sum(axis=0), dims) / rows
    total = float(_summed(vectors, lambda x: np.array([((x - mean) ** 2).sum()]), 1)[0]) / max(rows - 1, 1)
    context = vectors.sparkSession.sparkContext
    width = min(dims, k + extra)

    def times(block: np.ndarray) -> np.ndarray:
        """Covariance matrix times a block."""
        shared = context.broadcast((mean, block))

        def per_batch(x):
            m, b = shared.value
            centred = x - m
            return (centred.T @ (centred @ b)).ravel()

        out = _summed(vectors, per_batch, dims * block.shape[1]).reshape(dims, -1) / max(rows - 1, 1)
        shared.unpersist()
        return out

    block = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, width)))[0]
    basis, images = np.zeros((dims, 0)), np.zeros((dims, 0))
    for _ in range(MOST_SCANS):
        image = times(block)
        basis, images = np.hstack([basis, block]), np.hstack([images, image])
        inner = basis.T @ images
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        turn, values = turn[:, ::-1][:, :k], values[::-1][:k]
        axes = basis @ turn
        residual = float(np.linalg.norm(images @ turn - axes * values, axis=0).max() / max(values[0], 1e-300))
        if residual <= tolerance or basis.shape[1] >= dims or values[0] <= 0:
            break
        if basis.shape[1] >= RESTART * width:
            images, basis = images @ turn, axes
        fresh = image - basis @ (basis.T @ image)
        fresh -= basis @ (basis.T @ fresh)
        left, size, _ = np.linalg.svd(fresh, full_matrices=False)
        block = left[:, size > 1e-12 * max(size[0], 1e-300)][:, : dims - basis.shape[1]]
        # Directions that rounding has left along the basis are taken out once more.
        block = np.linalg.qr(block - basis @ (basis.T @ block))[0]
        if not block.shape[1]:
            break
    axes *= np.where(axes[np.abs(axes).argmax(axis=0), np.arange(k)] < 0, -1.0, 1.0)
    skew = float(np.abs(axes.T @ axes - np.eye(k)).max())
    return Components(mean, axes.T.copy(), np.maximum(values, 0.0), total, rows, residual, skew)
