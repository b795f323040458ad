"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

Vectors become whole numbers, so their sums are exact and rows are centred before anything is multiplied. Let X be the
centred rows. A step takes a direction v, forms X v in one distributed pass and X' u in another, where u is X v made
orthogonal to all earlier u and of length one, and v's successor is X' u made orthogonal to all earlier v. The lengths
that come off are the two diagonals of a small matrix; its singular vectors turn the directions into the components,
its singular values are their deviations times the root of the row count.

The long vectors u are never stored: each is X p for a short p, so a task makes them anew from its rows, together with
their inner products with a new one. What a pass brings back is a few numbers for each dimension and step, added up by
Spark; what it sends are the short vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantflow.session import cut_table

from .common import fresh

#: Whole numbers: floor of SCALE times an entry, plus SHIFT.
SCALE, SHIFT = 64, 1_000_000

#: Entries of this size and beyond have no whole number that sums could hold.
LARGEST = 2.0**61

#: Entries that one numpy step works on.
BLOCK_ENTRIES = 1 << 19

#: Up to this many dimensions all steps are made, so that equal deviations get all their directions.
FULL_STEPS = 512

#: Residual relative to the largest deviation at which a component counts as found, and below which there is no direction.
FOUND, NOTHING = 1e-13, 1e-11


class Whitening(NamedTuple):
    """Centred basis of ``n`` rows: exact sums of the dimensions, components as rows, their variances and shares."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float


def usable(vector: Column) -> Column:
    """Whether a vector and all its entries are there, finite and have a whole number."""
    return F.coalesce(F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < LARGEST / SCALE)), F.lit(False))


def whole(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)


def blocks(batches: Iterator[pa.RecordBatch], column: str, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Pieces of the batches with their whole numbers as a matrix; a short vector is filled up with zero entries."""
    rows = max(1, BLOCK_ENTRIES // max(width, 1))
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            piece = batch.slice(start, rows)
            lists = piece.column(column)
            offsets = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
            sizes = np.diff(offsets)
            if (sizes == width).all():
                yield piece, flat.reshape(len(sizes), width)
            else:
                x = np.full((len(sizes), width), SHIFT, np.int64)
                x[np.arange(width) < sizes[:, None]] = flat
                yield piece, x


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Rows minus the mean, whole part and fraction taken off apart."""
    base = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n / n for s in sums])
    return (x - base).astype(np.float64) - rest


def squares(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sums over the dimensions of ``(n * x - sum)`` squared, exact."""
    base = x - np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], object)
    largest = (int(np.abs(base).max(initial=0)) + 1) * n
    kind = np.int64 if x.shape[1] * largest * largest < 1 << 63 else object
    spread = base.astype(kind) * n - rest.astype(kind)
    return (spread * spread).sum(1, dtype=kind).tolist()


def total(rows: DataFrame, column: str, width: int, size: int, of: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """Sum over all rows of ``of(block)``, an array of ``size``: summed in the tasks, then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = 0
        for _, x in blocks(batches, column, width):
            out = out + of(x)
        if not isinstance(out, int):
            value = pa.array(out) if kind == "double" else pa.array(list(map(Decimal, out.tolist())), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), value], names=["at", "value"])

    parts = rows.select(column).mapInArrow(run, f"at int, value {kind}")
    found = {r["at"]: r["value"] for r in parts.groupBy("at").agg(F.sum("value").alias("value")).collect()}
    return np.array([found.get(i, 0) for i in range(size)], np.float64 if kind == "double" else object)


def orthogonal(v: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        v = v - basis.T @ (basis @ v)
    return v


def bidiagonalise(rows: DataFrame, column: str, width: int, n: int, sums: list[int], components: int, size: float) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (as rows) and singular values of the centred rows; ``size`` is the root of their sum of squares."""
    rng = np.random.default_rng(12_345)
    directions, short, images = (np.zeros((0, width)) for _ in range(3))
    alphas: list[float] = []
    betas: list[float] = []

    def another() -> np.ndarray:
        v = orthogonal(rng.standard_normal(width), directions)
        return v / np.linalg.norm(v)

    v = another()
    while True:
        k = len(directions)

        def with_earlier(x: np.ndarray, v=v, short=short) -> np.ndarray:
            y = centred(x, n, sums)
            z = y @ v
            return np.append((y @ short.T).T @ z, z @ z)

        found = total(rows, column, width, k + 1, with_earlier)
        shares, square = found[:k], found[k]
        p = v - short.T @ shares
        length = float(np.sqrt(max(square - shares @ shares, 0.0)))
        alpha, image = 0.0, np.zeros(width)
        if length > NOTHING * size:
            p = p / length

            def back(x: np.ndarray, p=p, short=short) -> np.ndarray:
                y = centred(x, n, sums)
                u = y @ p
                return np.concatenate([(y @ short.T).T @ u, [u @ u], u @ y])

            found = total(rows, column, width, k + 1 + width, back)
            # What rounding left of the earlier u is taken off as well.
            shares, square, image = found[:k], found[k], found[k + 1 :]
            left = float(np.sqrt(max(square - shares @ shares, 0.0)))
            p, image = (p - short.T @ shares) / left, (image - images.T @ shares) / left
            alpha = length * left
        else:
            p = np.zeros(width)
        directions, short, images = np.vstack([directions, v]), np.vstack([short, p]), np.vstack([images, image])
        alphas.append(alpha)
        k += 1
        w = orthogonal(image - alpha * v, directions) if k < width else np.zeros(width)
        beta = float(np.linalg.norm(w))
        if k < width and beta <= NOTHING * size:
            beta, v = 0.0, another()
        elif k < width:
            v = w / beta
        betas.append(beta)
        enough = k == width
        if enough or (width > FULL_STEPS and k >= components and k % 8 == 0):
            left_vectors, values, right = np.linalg.svd(np.diag(alphas) + np.diag(betas[:-1], 1))
            rest = beta * np.abs(left_vectors[-1, :components])
            if enough or (rest <= FOUND * values[0]).all():
                return right @ directions, values


def fit(rows: DataFrame, column: str, n: int, components: int) -> Whitening:
    """Fit on all rows of a written table whose ``column`` holds whole numbers."""
    width = rows.agg(F.max(F.size(column)).alias("width")).first()["width"] or 0
    none = Whitening(n, [0] * width, np.zeros((0, width)), np.zeros(0), np.zeros(0), 0.0)
    if not n or not width:
        return none
    added = total(rows, column, width, width, lambda x: x.astype(object).sum(0) if np.abs(x).max() >> 40 else x.sum(0), "decimal(38,0)")
    sums = [int(s) for s in added]
    square = float(total(rows, column, width, 1, lambda x: np.array([np.square(centred(x, n, sums)).sum()]))[0])
    if not square:
        return none._replace(sums=sums)
    basis, values = bidiagonalise(rows, column, width, n, sums, components, float(np.sqrt(square)))
    count = min(components, int((values > NOTHING * values[0]).sum()))
    basis, variances = basis[:count], np.square(values[:count]) / n

    def moments(x: np.ndarray) -> np.ndarray:
        w = centred(x, n, sums) @ basis.T / np.sqrt(variances)
        return np.append((w.T @ w).ravel(), w.sum(0))

    found = total(rows, column, width, count * count + count, moments) / n
    mean = found[count * count :]
    covariance = found[: count * count].reshape(count, count) - np.outer(mean, mean)
    error = float(np.abs(covariance - np.eye(count)).max())
    return Whitening(n, sums, basis, variances, variances * n / square, error)


def whiten(vectors: DataFrame, column: str = "embedding", components: int = 32) -> DataFrame:
    """Rows with a usable vector, whitened: the projections of the centred whole numbers over the components' deviations.

    Keeps all other columns and adds ``n`` (rows fitted), ``deviation`` (exact sum over the dimensions of the squared
    ``n * x - sum``, decimal), ``whitened`` and ``explained`` (an entry per component, by falling variance, at most
    ``components``) and ``identity_error`` (largest entry of the whitened rows' covariance minus the identity). Columns
    of these names are replaced.

    Vectors that are null or hold null, infinite or not-a-number entries, or entries of 2^55 and more, are left out. A
    vector shorter than the longest is filled up with entries of zero. Directions without any variance are no
    components, so equal rows alone have none and empty lists. Repeated rows and null ids count like others; an empty
    table gives no rows.
    """
    made = ["n", "deviation", "whitened", "explained", "identity_error"]
    x = fresh("_x", vectors.columns)
    keep = [c for c in vectors.columns if c.lower() not in {column.lower(), *made}]
    table = cut_table(vectors.where(usable(F.col(column))).select(*keep, whole(F.col(column)).alias(x)))
    rows = table.df
    model = fit(rows, x, table.rows, components)
    width = len(model.sums)
    schema = T.StructType([*rows.select(*keep).schema, *T.StructType.fromDDL("deviation decimal(38,0), whitened array<double>")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        onto = (model.components / np.sqrt(model.variances)[:, None]).T
        for piece, numbers in blocks(batches, x, width):
            w = centred(numbers, model.n, model.sums) @ onto
            offsets = np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]
            made = [
                pa.array(list(map(Decimal, squares(numbers, model.n, model.sums))), pa.decimal128(38, 0)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(w.ravel())),
            ]
            yield pa.RecordBatch.from_arrays([*map(piece.column, keep), *made], names=[*keep, "deviation", "whitened"])

    shares = F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>")
    return rows.mapInArrow(run, schema).select(
        *keep, F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", shares.alias("explained"),
        F.lit(model.identity_error).alias("identity_error"))
