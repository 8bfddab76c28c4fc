"""Whitening of embeddings along their leading components.

Entries become whole numbers, so that sums over all vectors are exact. Each distinct vector counts once in the
fit. Spark adds up the means and then the products of centred vectors, block by block; only the matrix of
dimension x dimension numbers comes to the driver, whatever the number of vectors. There it is brought to
tridiagonal form by Householder reflections; Sturm counts and bisection find its leading eigenvalues, inverse
iteration their vectors, with those of a cluster of close eigenvalues made orthogonal to one another. The
components, dimension x 4 numbers, go back to all tasks, which project every vector.

Defined cases. Vectors that are null or hold a null or non-finite entry are left out. Where lengths differ, only
vectors of the most frequent length (the longer of equally frequent ones) are taken. Repeated rows are projected
each on its own; a null id stays null. Of equal eigenvalues any orthonormal set of components may come out. A
component along which nothing varies (at most 1e-13 of the largest eigenvalue) has ``whitened`` 0 and is no part
of the identity error. Entries beyond 64 bits become the nearest 64-bit number; ``deviation`` is null where it
would not fit in 64 bits. An empty table gives no rows. Columns besides the two named ones are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clickloom.session import materialise, ship

COMPONENTS = 4
SCALE = 256
_FLAT = 1e-13
_EPS = np.finfo(float).eps


def householder(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, off-diagonal and orthogonal ``q`` with a = q t q' for a symmetric matrix."""
    a, d = np.array(a, float), len(a)
    q = np.eye(d)
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        alpha = -np.copysign(np.linalg.norm(x), x[0])
        x[0] -= alpha
        length = np.linalg.norm(x)
        if length == 0:
            continue
        v = x / length
        # a <- h a h for the reflection h = 1 - 2 v v' of the last rows and columns.
        p = a[k + 1 :, k + 1 :] @ v
        w = 2 * (p - (v @ p) * v)
        a[k + 1 :, k + 1 :] -= np.outer(v, w) + np.outer(w, v)
        a[k + 1, k] = a[k, k + 1] = alpha
        a[k + 2 :, k] = a[k, k + 2 :] = 0.0
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def count_below(diagonal: np.ndarray, off: np.ndarray, x: float) -> int:
    """How many eigenvalues of the tridiagonal matrix are less than ``x``: the negative pivots of t - x."""
    least = np.finfo(float).tiny * max(1.0, float(np.max(off * off, initial=0.0)))
    pivot, count = 1.0, 0
    for i, value in enumerate(diagonal):
        pivot = value - x - (off[i - 1] ** 2 / pivot if i else 0.0)
        if abs(pivot) < least:
            pivot = -least
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, each to the last bits by bisection."""
    d = len(diagonal)
    reach = np.abs(np.concatenate([off, [0.0]])) + np.abs(np.concatenate([[0.0], off]))
    bottom, top = float(np.min(diagonal - reach)), float(np.max(diagonal + reach))
    slack = 2 * _EPS * max(abs(bottom), abs(top)) + np.finfo(float).tiny
    out = []
    for k in range(count):
        # The eigenvalue with d - 1 - k others below it.
        low, high = bottom - slack, top + slack
        while True:
            middle = low + (high - low) / 2
            if not low < middle < high or high - low <= _EPS * max(abs(low), abs(high)):
                break
            if count_below(diagonal, off, middle) <= d - 1 - k:
                low = middle
            else:
                high = middle
        out.append(low + (high - low) / 2)
    return np.array(out)


def _solve(diagonal: np.ndarray, off: np.ndarray, right: np.ndarray, least: float) -> np.ndarray:
    """Solution of the tridiagonal system by elimination with row exchanges; pivots near zero are ``least``."""
    d = len(diagonal)
    main, upper, second, b = diagonal.copy(), np.append(off, 0.0), np.zeros(d), right.copy()
    for i in range(d - 1):
        under = off[i]
        if abs(under) > abs(main[i]):
            first = (main[i], upper[i], second[i], b[i])
            main[i], upper[i], second[i], b[i] = under, main[i + 1], upper[i + 1], b[i + 1]
            factor = first[0] / main[i]
            main[i + 1], upper[i + 1] = first[1] - factor * upper[i], first[2] - factor * second[i]
            b[i + 1] = first[3] - factor * b[i]
        else:
            if abs(main[i]) < least:
                main[i] = least
            factor = under / main[i]
            main[i + 1] -= factor * upper[i]
            b[i + 1] -= factor * b[i]
    if abs(main[-1]) < least:
        main[-1] = least
    x = np.zeros(d)
    for i in range(d - 1, -1, -1):
        x[i] = b[i]
        if i + 1 < d:
            x[i] -= upper[i] * x[i + 1]
        if i + 2 < d:
            x[i] -= second[i] * x[i + 2]
        x[i] /= main[i]
        largest = abs(x[i])
        if largest > 1e100:  # the length does not matter, only the direction
            x /= largest
            b /= largest
    return x


def vectors_of(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, steps: int = 5) -> np.ndarray:
    """Unit eigenvectors (columns) of the tridiagonal matrix by inverse iteration from repeatable starts."""
    d = len(diagonal)
    size = max(float(np.max(np.abs(diagonal))), float(np.max(np.abs(off), initial=0.0)), np.finfo(float).tiny)
    random = np.random.default_rng(7)
    out: list[np.ndarray] = []
    start, shift = 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * size:
            start = k  # a new cluster
        # Equal eigenvalues get shifts that differ a little.
        shift = min(value, shift - 10 * _EPS * size)
        x = random.standard_normal(d)
        for _ in range(steps):
            x = _solve(diagonal - shift, off, x / np.linalg.norm(x), _EPS * size)
            for _ in range(2):
                for other in out[start:]:
                    x -= (other @ x) * other
        out.append(x / np.linalg.norm(x))
    return np.stack(out, 1)


def leading_components(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns."""
    diagonal, off, q = householder(matrix)
    values = leading_values(diagonal, off, count)
    vectors = q @ vectors_of(diagonal, off, values)
    return values, vectors / np.linalg.norm(vectors, axis=0)


def whole(entry: Column) -> Column:
    """floor(256 c) of an entry as a 64-bit number."""
    scaled = F.floor(F.lit(float(SCALE)) * entry.cast("double"))
    return scaled.cast("bigint")


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, x`` of the vectors without null or non-finite entries."""
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    named = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"))
    return named.where(F.col("embedding").isNotNull() & finite).select("vec_id", F.transform("embedding", whole).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    width = len(column[0]) if len(column) else 0
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _sum_up(df: DataFrame, add: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum of ``add``, a matrix, over blocks of ``x``: one for each task, whose rows Spark brings together."""
    ship(df.sparkSession)
    exact = add(np.zeros((0, shape[1]), np.int64)).dtype.kind == "i"
    kind = "decimal(38,0)" if exact else "double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, np.int64 if exact else float)
        for batch in batches:
            if batch.num_rows:
                total += add(_matrix(batch.column("x")))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(shape[0])), pa.array(list(total))], names=["row", "cells"])

    def join(parts: pa.Table) -> pa.Table:
        cells = _matrix(parts.column("cells").combine_chunks())
        total = (cells.astype(object) if exact else cells).sum(0)
        joined = pa.array([[Decimal(int(c)) for c in total]], pa.list_(pa.decimal128(38))) if exact else pa.array([total])
        return pa.table({"row": parts.column("row")[:1], "cells": joined})

    parts = df.select("x").mapInArrow(run, f"row bigint, cells array<{'bigint' if exact else 'double'}>")
    joined = parts.groupBy("row").applyInArrow(join, f"row bigint, cells array<{kind}>")
    out = np.zeros(shape, object if exact else float)
    for row in joined.collect():
        out[row["row"]] = [int(c) for c in row["cells"]] if exact else row["cells"]
    return out


def totals(fit: DataFrame, d: int) -> list[int]:
    """The exact sums of all dimensions, from those of the upper and lower 32 bits of the entries."""
    halves = _sum_up(fit, lambda x: np.stack([(x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)]), (2, d))
    return [int(high) * (1 << 32) + int(low) for high, low in zip(*halves)]


def _covariance(fit: DataFrame, n: int, width: int, project: Callable[[np.ndarray], np.ndarray], d: int) -> np.ndarray:
    """Covariance of the projected fit vectors, centred before multiplying."""

    def first(x: np.ndarray) -> np.ndarray:
        return np.pad(project(x).sum(0), (0, d - width))

    mean = _sum_up(fit, first, (1, d))[0, :width] / n

    def second(x: np.ndarray) -> np.ndarray:
        y = project(x) - mean
        return np.pad(y.T @ y, ((0, 0), (0, d - width)))

    return _sum_up(fit, second, (width, d))[:, :width] / n


def whiten(vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """For each usable vector and component ``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    spark = vectors.sparkSession
    ship(spark)
    schema = f"vec_id {dict(vectors.dtypes)[vec_id]}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    usable_rows = usable(vectors, vec_id, embedding)
    lengths = usable_rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("d")).first()
    if lengths is None or not lengths["d"]:
        return spark.createDataFrame([], schema)
    d = lengths["d"]
    rows = usable_rows.where(F.size("x") == d)
    fit = materialise(rows.select("x").distinct())
    n = fit.count()
    sums = totals(fit, d)
    centre = np.array([s / n for s in sums])
    covariance = _covariance(fit, n, d, lambda x: x - centre, d)
    values, axes = leading_components((covariance + covariance.T) / 2, min(components, d))
    trace = float(np.trace(covariance))
    varied = values > _FLAT * max(values[0], 0.0)
    scale = np.where(varied, 1 / np.sqrt(np.where(varied, values, 1.0)), 0.0)
    turn = axes * scale
    k = len(values)
    error = np.abs(_covariance(fit, n, k, lambda x: (x - centre) @ turn, d) - np.eye(k))
    identity_error = float(np.max(error[np.ix_(varied, varied)], initial=0.0))
    explained = values / trace if trace > 0 else np.zeros(k)
    whole_sums = np.array(sums, object)
    largest = max(map(abs, sums))

    def deviations(x: np.ndarray) -> list[int | None]:
        # Rows whose exact result fits in 64 bits are far within them by an estimate in floating point.
        away = n * x.astype(float) - whole_sums.astype(float)
        rough = (away * away).sum(1)
        small = (rough < 2.0**62) & (np.abs(x).max(1).astype(float) * n < 2.0**62) & (largest < 2**62)
        out: list[int | None] = [None] * len(x)
        if small.any():
            exact = n * x[small] - whole_sums.astype(np.int64)
            for at, value in zip(np.flatnonzero(small), (exact * exact).sum(1)):
                out[at] = int(value)
        for at in np.flatnonzero(~small):
            value = sum((n * int(c) - s) ** 2 for c, s in zip(x[at], sums))
            out[at] = value if value < 1 << 63 else None
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, m = _matrix(batch.column("x")), batch.num_rows
            away = pa.array(deviations(x), pa.int64())
            ids, white = batch.column("vec_id"), (x - centre) @ turn
            for j in range(k):
                columns = [ids, pa.array(np.full(m, j + 1, np.int32)), pa.array(np.full(m, n)), away, pa.array(white[:, j]), pa.array(np.full(m, explained[j])), pa.array(np.full(m, identity_error))]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
