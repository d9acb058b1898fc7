"""Whitening of embeddings onto principal components found by spectral divide and conquer.

The covariance is a matrix of the width of the vectors, however many there are. It is split on the
driver: the polar factor of the covariance, shifted to the middle of its spectrum, has the
eigenvalues 1 and -1, so half its sum with the identity projects onto the space of the larger
eigenvalues. Bases of that space and of its complement give two smaller matrices, which are split
in turn, down to single components. Polar factors come from the dynamically weighted Halley
iteration in its QR form, which needs no inverse and six or seven steps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import written

SCALE = 256
COMPONENTS = 4
EPS = float(np.finfo(float).eps)
# From here on doubles do not name every integer.
LARGEST = 2**53
# Places of the shift around the mean eigenvalue, in standard deviations, until one splits.
SHIFTS = (0.0, 0.05, -0.05, 0.13, -0.13, 0.29, -0.29, 0.41, -0.41, 0.61, -0.61, 0.83, -0.83)


def polar(a: np.ndarray) -> np.ndarray:
    """Symmetric orthogonal polar factor of a symmetric matrix."""
    n = len(a)
    x, eye = a / np.linalg.norm(a), np.eye(n)
    # Below the smallest singular value, if it can be had; a bound that is too small costs a step.
    r = np.linalg.qr(x, mode="r")
    low = EPS
    if np.abs(np.diag(r)).min() > EPS:
        low = max(EPS, min(1.0, 1 / (np.sqrt(n) * np.linalg.norm(np.linalg.inv(r), 1))))
    for _ in range(40):
        gap = np.cbrt(4 * (1 - low**2) / low**4)
        root = np.sqrt(1 + gap)
        a0 = root + 0.5 * np.sqrt(max(0.0, 8 - 4 * gap + 8 * (2 - low**2) / (low**2 * root)))
        b0 = (a0 - 1) ** 2 / 4
        c0 = a0 + b0 - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c0) * x, eye]))
        new = (b0 / c0) * x + (a0 - b0 / c0) / np.sqrt(c0) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        step, x = np.linalg.norm(new - x), new
        low = min(1.0, low * (a0 + b0 * low**2) / (1 + c0 * low**2))
        if step < 1e-8 and 1 - low < 1e-12:  # the iteration is cubic
            break
    return x


def halves(a: np.ndarray, scale: float) -> np.ndarray | tuple[np.ndarray, np.ndarray] | None:
    """Bases of the spaces of the larger and the smaller eigenvalues; None if these do not differ.

    Eigenvalues nearer than the rounding of matrices of norm ``scale`` count as the same.
    """
    n = len(a)
    mean, eye = np.trace(a) / n, np.eye(n)
    deviation = np.linalg.norm(a - mean * eye) / np.sqrt(n)
    if deviation <= 4 * EPS * scale:
        return None
    for shift in SHIFTS:
        # Eigenvalues that differ lie on both sides of their mean. One that is hit has no side.
        upper = (polar(a - (mean + shift * deviation) * eye) + eye) / 2
        k = round(float(np.trace(upper)))
        if not 0 < k < n or np.linalg.norm(upper @ upper - upper) > 1e-9:
            continue
        q, _ = np.linalg.qr(upper @ np.random.default_rng(n).standard_normal((n, k)))
        q, _ = np.linalg.qr(upper @ q, mode="complete")
        large, small = q[:, :k], q[:, k:]
        if np.linalg.norm(small.T @ a @ large) <= 100 * n * EPS * scale:
            return large, small
    return None


def components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (as columns) of a symmetric matrix."""
    scale, todo, found = float(np.linalg.norm(a)), [np.eye(len(a))], []
    while todo:
        basis = todo.pop()
        # Always from the whole matrix, so rounding does not add up on the way down.
        own = basis.T @ a @ basis
        split = halves((own + own.T) / 2, scale) if basis.shape[1] > 1 else None
        if split is None:
            found.append(basis)
        else:
            todo += [np.linalg.qr(basis @ half)[0] for half in split]
    vectors = np.hstack(found) if found else np.zeros((0, 0))
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _integers(batch: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows whose vector is usable, its width, and all their entries times SCALE, rounded down."""
    column = batch.column(at)
    width = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    value = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(batch)), width)
    finite = np.isfinite(value)
    good = pc.is_valid(column).to_numpy(zero_copy_only=False).copy()
    good[row[~finite]] = False
    x = np.floor(SCALE * value[good[row]]) + 0.0
    if len(x) and np.abs(x).max() >= LARGEST:
        raise ValueError(f"entries of {LARGEST // SCALE} and more cannot be turned into exact integers")
    return np.flatnonzero(good), width[good], x.astype(np.int64)


def _lists(width: np.ndarray, x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *width]), pa.int32()), pa.array(x))


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), width)


def column_sums(fit: DataFrame, width: int) -> list[int]:
    """Exact sums of the columns of (x)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * width
        for batch in batches:
            x = _matrix(batch, width)
            # Halves of 32 bits cannot leave 64 bits in one batch.
            high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
            total = [t + (h << 32) + v for t, h, v in zip(total, high, low, strict=True)]
        own = pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), own], names=["dim", "total"])

    sums = fit.mapInArrow(add, "dim int, total decimal(38,0)").groupBy("dim").agg(F.sum("total").alias("total"))
    return [int(r["total"]) for r in sums.orderBy("dim").collect()]


def _row_sums(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in parts:
        rows = batch.column(1).flatten().to_numpy().reshape(len(batch), -1)
        for dim, row in zip(batch.column(0).to_pylist(), rows, strict=True):
            total[dim] = total[dim] + row if dim in total else row.copy()
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()))], names=["dim", "row"])


def products(fit: DataFrame, width: int, of: Callable[[np.ndarray], np.ndarray], out: int) -> np.ndarray:
    """Sum over the rows of (x) of y y', for y of width ``out`` from each block of rows.

    A task adds up its rows; the tasks' matrices are added up line by line, each line in one task.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((out, out))
        for batch in batches:
            y = of(_matrix(batch, width))
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(out), pa.int32()), pa.array(list(total))], names=["dim", "row"])

    parts = fit.mapInArrow(add, "dim int, row array<double>")
    lines = parts.repartition("dim").mapInArrow(_row_sums, "dim int, row array<double>").collect()
    return np.array([r["row"] for r in sorted(lines)]).reshape(-1, out)


class Whitening(NamedTuple):
    """``weights`` take x - sums / n to the components that have a direction; null ones have none."""

    n: int
    sums: list[int]
    weights: np.ndarray
    explained: list[float | None]
    identity_error: float | None


def fit_whitening(
    vectors: DataFrame, column: str = "embedding", keep: int = COMPONENTS
) -> tuple[Whitening, DataFrame]:
    """The whitening of the distinct integer vectors of a table, and these as (x), written."""

    def integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, width, x = _integers(batch, 0)
            yield pa.RecordBatch.from_arrays([_lists(width, x)], names=["x"])

    every = vectors.select(F.col(f"`{column}`").alias("v")).mapInArrow(integers, "x array<long>")
    fit = written(every.dropDuplicates(["x"]), "whitening-fit")
    n, least, most = fit.agg(F.count(F.lit(1)), F.min(F.size("x")), F.max(F.size("x"))).first()
    if least != most:
        raise ValueError(f"vectors of {least} and of {most} entries in one table")
    if not n or not most:
        return Whitening(n, [], np.zeros((0, 0)), [], None), fit
    sums = column_sums(fit, most)
    mean = np.array([s / n for s in sums])
    covariance = products(fit, most, lambda x: x - mean, most) / n
    values, directions = components((covariance + covariance.T) / 2)
    trace = float(np.trace(covariance))
    explained = [max(0.0, float(e)) / trace if trace > 0 else None for e in values[:keep]]
    real = int((values[:keep] > most * EPS * values[0]).sum()) if trace > 0 else 0
    weights = directions[:, :real] / np.sqrt(values[:real])
    error = None
    if real:
        ones = products(fit, most, lambda x: np.hstack([(x - mean) @ weights, np.ones((len(x), 1))]), real + 1)
        centre = ones[-1, :real] / n
        second = products(fit, most, lambda x: (x - mean) @ weights - centre, real) / n
        error = float(np.abs(second - np.eye(real)).max())
    return Whitening(n, sums, weights, explained, error), fit


def whiten(
    vectors: DataFrame, key: str = "vec_id", column: str = "embedding", keep: int = COMPONENTS
) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): one row per vector and component.

    Vectors that are null, or hold null or non-finite entries, take no part. The others become
    integers, SCALE times the entry rounded down; the fit is over the distinct ones. ``deviation``
    is the exact sum of squares of n x - sums, as decimal(38,0). At most ``keep`` components come
    back, fewer for narrower vectors; where the vectors do not vary along one, ``whitened`` is null
    (and so is ``explained``, if they do not vary at all).

    Null and repeated keys are kept, equal vectors each give their rows. An empty table, or one
    of vectors without entries, gives no rows. Vectors of different widths, and entries
    whose multiple is no exact integer in double precision, raise ValueError. Other columns are
    ignored.

    The table is read twice, its distinct vectors shuffle once. A matrix of the width of the vectors
    comes from each task to the driver's fit; what is sent to all tasks is ``keep`` such vectors.
    """
    model, _ = fit_whitening(vectors, column, keep)
    n, width, c = model.n, len(model.sums), len(model.explained)
    kind = vectors.select(F.col(f"`{key}`")).schema[0].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, far = np.array([s / n for s in model.sums]), max(map(abs, model.sums), default=0)
        for batch in batches:
            good, _, x = _integers(batch, 1)
            if not c or not len(good):
                continue
            x = x.reshape(-1, width)
            if width * (n * int(np.abs(x).max()) + far) ** 2 < 2**63:
                exact = ((n * x - np.array(model.sums)) ** 2).sum(axis=1).tolist()
            else:
                exact = ((n * x.astype(object) - np.array(model.sums, object)) ** 2).sum(axis=1).tolist()
            white = np.full((len(x), c), np.nan)
            white[:, : model.weights.shape[1]] = (x - mean) @ model.weights
            rows = len(x) * c
            each = np.repeat(np.arange(len(x)), c)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(good[each])),
                    pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(rows, n, np.int64)),
                    pa.array([Decimal(v) for v in exact], pa.decimal128(38, 0)).take(pa.array(each)),
                    pa.array(white.ravel(), from_pandas=True),
                    pa.array(model.explained * len(x), pa.float64()),
                    pa.array([model.identity_error] * rows, pa.float64()),
                ],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    rows = vectors.select(F.col(f"`{key}`").alias("id"), F.col(f"`{column}`").alias("v"))
    return rows.mapInArrow(apply, schema).withColumnRenamed("id", key)
