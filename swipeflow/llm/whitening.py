"""Embedding whitening: principal components of the centred covariance, and every vector projected on them.

Steps, each a Spark pass over the kept rows except the eigen-decomposition of one d x d matrix:

1. Rows whose vector is null or holds a null or non-finite entry are dropped; each entry c becomes the long
   ``x = floor(SCALE * c) + OFFSET``. The kept rows are written once to the shared folder.
2. n and the per-dimension sums S: every task sums its rows exactly (integers), the partial sums are added
   up per dimension by a grouped aggregation, so only d numbers reach the driver.
3. The centred covariance ``V = sum((x - S/n)(x - S/n)^T) / n``: every task forms the Gram matrix of its
   centred rows with numpy, the partial matrices are summed per entry by a grouped aggregation (d^2
   numbers reach the driver, bounded by the dimension, not by the rows).
4. On the driver, for the d x d matrix V: Householder tridiagonalisation ``V = Q T Q^T``; the leading
   eigenvalues of T by bisection on Sturm counts (the number of negative pivots of ``T - s I``), each to the
   width of a double; for each of them the eigenvector of T by inverse iteration, orthogonalised against
   the vectors of its cluster (eigenvalues within ``CLUSTER`` of each other, relative to the norm of T)
   at each step; the component is ``Q y``, made unit and signed so that its largest entry is positive.
5. The projection ``W = components / sqrt(e)`` (d x k numbers) and the mean travel with the tasks; each
   task projects its rows. A pass of the same kind measures the covariance of the whitened values.

Components are those among the first ``COMPONENTS`` whose eigenvalue is above ``RANK`` times the largest
one (a zero eigenvalue cannot be whitened). deviation is ``sum((n x - S)^2)`` in exact integers.

Edge cases: rows with a null vec_id are kept; null vectors, null or non-finite entries drop the row; an
empty table or one without a kept row gives an empty result; a single kept row (or identical rows) gives
no component and so no rows; repeated rows are kept each; vectors of different lengths raise ValueError;
other columns are left behind, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeflow.llm.tables import saved

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
RANK = 1e-12
CLUSTER = 1e-3
STEPS = 6


def kept(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id, x (array of longs) for every row with a whole finite vector."""
    v = F.col(column)
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return vectors.filter(v.isNotNull() & ~bad).select(
        F.col("vec_id"), F.transform(v, lambda c: F.floor(F.lit(SCALE) * c.cast("double")) + F.lit(OFFSET)).alias("x"))


def _matrix(series: pd.Series) -> np.ndarray:
    return np.array([np.asarray(row, dtype=np.int64) for row in series]) if len(series) else np.zeros((0, 0), np.int64)


def _sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total, n, width = None, 0, set()
    for batch in batches:
        x = _matrix(batch["x"])
        if not len(x):
            continue
        width.add(x.shape[1])
        part = x.sum(axis=0)
        if total is not None and len(part) != len(total):
            raise ValueError("vectors of different lengths")
        total = part if total is None else total + part
        n += len(x)
    if total is not None:
        yield pd.DataFrame({"dim": np.arange(len(total)), "s": total, "n": n, "width": [min(width)] * len(total),
                            "widest": [max(width)] * len(total)})


def _gram(mean: np.ndarray, projection: np.ndarray | None = None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = len(mean) if projection is None else projection.shape[1]
        total = np.zeros((size, size))
        for batch in batches:
            x = _matrix(batch["x"])
            if not len(x):
                continue
            centred = x - mean
            if projection is not None:
                centred = centred @ projection
            total += centred.T @ centred
        i, j = np.triu_indices(size)
        yield pd.DataFrame({"i": i, "j": j, "g": total[i, j]})
    return run


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Householder reduction of a symmetric matrix: diagonal, off-diagonal and Q with a = Q T Q^T."""
    a = np.array(a, dtype=float)
    n = len(a)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1:, k]
        norm = np.linalg.norm(x)
        if norm == 0.0:
            continue
        alpha = -norm if x[0] >= 0 else norm
        v = x.copy()
        v[0] -= alpha
        length = np.linalg.norm(v)
        if length == 0.0:
            continue
        v /= length
        a[k + 1:, :] -= 2.0 * np.outer(v, v @ a[k + 1:, :])
        a[:, k + 1:] -= 2.0 * np.outer(a[:, k + 1:] @ v, v)
        q[:, k + 1:] -= 2.0 * np.outer(q[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def below(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues of the tridiagonal matrix lie below each shift."""
    tiny = np.finfo(float).tiny * 4
    pivot = diagonal[0] - shifts
    count = (pivot < 0).astype(int)
    for i in range(1, len(diagonal)):
        pivot = np.where(pivot == 0.0, tiny, pivot)
        pivot = diagonal[i] - shifts - off[i - 1] ** 2 / pivot
        count += pivot < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, largest first, each bisected until its interval is one double wide."""
    n = len(diagonal)
    reach = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    low = np.full(k, float(np.min(diagonal - reach)))
    high = np.full(k, float(np.max(diagonal + reach)))
    width = max(abs(low[0]), abs(high[0]), np.finfo(float).tiny)
    low, high = low - width * 1e-12, high + width * 1e-12
    index = n - 1 - np.arange(k)  # eigenvalue number, ascending
    for _ in range(200):
        middle = (low + high) / 2
        done = (middle <= low) | (middle >= high)
        if done.all():
            break
        above = below(diagonal, off, middle) > index
        high = np.where(~done & above, middle, high)
        low = np.where(~done & ~above, middle, low)
    return (low + high) / 2


def eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix by inverse iteration, columns in the order of values."""
    n = len(diagonal)
    t = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    scale = max(float(np.abs(t).sum(axis=1).max()), np.finfo(float).tiny)
    vectors = np.zeros((n, len(values)))
    start = np.sin(np.arange(1, n + 1) * 0.7071) + 1.0 / np.sqrt(n)
    for m, value in enumerate(values):
        cluster = [c for c in range(m) if abs(values[c] - value) <= CLUSTER * scale]
        shift = value + scale * np.finfo(float).eps * 8
        y = start / np.linalg.norm(start)
        for _ in range(STEPS):
            try:
                y = np.linalg.solve(t - shift * np.eye(n), y)
            except np.linalg.LinAlgError:
                shift += scale * np.finfo(float).eps * 64
                continue
            for c in cluster:
                y -= (vectors[:, c] @ y) * vectors[:, c]
            y /= np.linalg.norm(y)
        vectors[:, m] = y
    return vectors


def components(covariance: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The leading eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix."""
    diagonal, off, q = tridiagonal(covariance)
    values = leading_eigenvalues(diagonal, off, min(k, len(diagonal)))
    vectors = q @ eigenvectors(diagonal, off, values)
    vectors /= np.linalg.norm(vectors, axis=0)
    largest = np.argmax(np.abs(vectors), axis=0)
    vectors *= np.where(vectors[largest, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    return values, vectors


def _summed(table: DataFrame, size: int) -> np.ndarray:
    matrix = np.zeros((size, size))
    for i, j, g in table.groupBy("i", "j").agg(F.sum("g").alias("g")).collect():
        matrix[i, j] = matrix[j, i] = g
    return matrix


def _projected(n: int, sums: np.ndarray, projection: np.ndarray, explained: np.ndarray, identity_error: float):
    mean = sums / n

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _matrix(batch["x"])
            if not len(x):
                continue
            spread = n * x - sums
            if np.abs(spread).max() ** 2 * x.shape[1] < 2 ** 62:
                deviation = (spread ** 2).sum(axis=1)
            else:
                deviation = np.array([sum(int(v) ** 2 for v in row) for row in spread], dtype=object)
            whitened = (x - mean) @ projection
            k = projection.shape[1]
            yield pd.DataFrame({
                "vec_id": np.repeat(batch["vec_id"].to_numpy(), k), "component": np.tile(np.arange(1, k + 1), len(x)),
                "n": n, "deviation": np.repeat(deviation, k).astype(np.int64), "whitened": whitened.ravel(),
                "explained": np.tile(explained, len(x)), "identity_error": identity_error})
    return run


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(vectors: DataFrame, column: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every kept row and component."""
    spark = vectors.sparkSession
    rows = saved(kept(vectors, column).withColumn("vec_id", F.col("vec_id").cast("long")), "whitening-rows")
    sums = rows.select("x").mapInPandas(_sums, "dim int, s long, n long, width int, widest int").groupBy("dim").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n"), F.min("width").alias("width"), F.max("widest").alias("widest")).collect()
    empty = spark.createDataFrame([], SCHEMA)
    if not sums:
        return empty
    sums = sorted(sums)
    if sums[0]["width"] != sums[0]["widest"]:
        raise ValueError("vectors of different lengths")
    n = int(sums[0]["n"])
    total = np.array([int(r["s"]) for r in sums], dtype=np.int64)
    mean = total / n
    size = len(total)
    covariance = _summed(rows.select("x").mapInPandas(_gram(mean), "i int, j int, g double"), size) / n
    values, vectors_ = components(covariance, k)
    keep = values > RANK * max(values.max(initial=0.0), 0.0)
    if not keep.any() or values.max(initial=0.0) <= 0.0:
        return empty
    values, vectors_ = values[keep], vectors_[:, keep]
    projection = vectors_ / np.sqrt(values)
    check = _summed(rows.select("x").mapInPandas(_gram(mean, projection=projection), "i int, j int, g double"), len(values)) / n
    identity_error = float(np.abs(check - np.eye(len(values))).max())
    explained = values / float(np.trace(covariance))
    return rows.mapInPandas(_projected(n, total, projection, explained, identity_error), SCHEMA)
