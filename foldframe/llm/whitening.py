"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

An entry c becomes the integer x = floor(64 c) + 1,000,000. The rows Z = x - S/n (S: exact sums of the n rows) are
centred before anything is multiplied, from the exact integer n*x - S. The bidiagonalisation alternates the products Z v
and Z'u: a step sends one v to the rows, each task computes t = Z v for its rows, the products U't with all earlier left
vectors and Z't, and returns their sums; nothing as long as the table is stored or moved. A left vector is never kept
either: u_j = Z p_j for a short p_j, so a task makes the earlier left vectors from its rows again (one matrix product)
and takes the new one's part along them away: full reorthogonalisation on the left, repeated with a second product where
the first took most of the vector away. On the right the vectors are short and are reorthogonalised twice where they are.
After as many steps as a row has entries (a vanishing vector is replaced by a new direction, so repeated singular values
are found as often as they occur) the singular vectors of the small bidiagonal matrix give components and deviations.

Defined results: rows with a null vector, or with null or non-finite entries, are dropped, and so are rows whose vector
has not the most frequent number of entries (missing entries count as null). Repeated rows count and are returned as
often as they occur; a null id is returned as null. Components whose deviation is zero to double precision cannot be
whitened and are left out, so one row, equal rows and an empty table give no rows. An entry whose integer, or a
``deviation`` that does not fit 64 bits ends the job with an error. Other columns are ignored, whatever their names.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import ready, written
from .vectors import EXACT, matrix, of_usual_size, scaled, task_sums, usable

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
#: A new left vector of less than this share of Z v is reorthogonalised a second time.
AGAIN = 0.1
#: Rows that are expanded into one batch of results.
OUT_ROWS = 1024


def integers(batch_column: pa.Array, size: int) -> np.ndarray:
    return scaled(matrix(batch_column, size), SCALE) + SHIFT


class Centre:
    """The exact centre of the rows: n and the sums of each entry."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """n*x - S, exactly (Python integers where 64 bits might not do)."""
        big = max([abs(s) for s in self.sums] + [self.n * int(np.abs(x).max(initial=0))])
        kind = np.int64 if big < 1 << 62 else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.offsets(x).astype(np.float64) / self.n

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """Sum over the entries of (n*x - S)^2, exactly."""
        a = self.offsets(x)
        if a.dtype == object or (a.size and a.shape[1] * float(np.abs(a).max()) ** 2 >= EXACT):
            total = (a.astype(object) ** 2).sum(axis=1)
            if any(t >= 1 << 63 for t in total):
                raise ValueError("a deviation does not fit a 64-bit integer")
            return total.astype(np.int64)
        return (a * a).sum(axis=1)


def centre(vectors: DataFrame, size: int) -> Centre:
    def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(size + 1, np.int64)
        for b in batches:
            total[:size] += integers(b.column(1), size).sum(axis=0)
            total[size] += b.num_rows
        return total

    sums = task_sums(vectors, partial, size + 1, exact=True)
    return Centre(sums[size], sums[:size])


def products(vectors: DataFrame, size: int, at: Centre, v: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """(U't, t't, Z't) for t = Z v and U = Z p, over all rows."""
    k = p.shape[1]

    def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(k + 1 + size)
        for b in batches:
            z = at.rows(integers(b.column(1), size))
            t = z @ v
            total[:k] += (z @ p).T @ t
            total[k] += t @ t
            total[k + 1:] += z.T @ t
        return total

    s = np.array(task_sums(vectors, partial, k + 1 + size))
    return s[:k], float(s[k]), s[k + 1:]


def bidiagonalised(vectors: DataFrame, size: int, at: Centre, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(V, B): Z V = U B with orthonormal columns of V (``size`` of them) and B upper bidiagonal."""
    steps = min(size, at.n)
    rng = np.random.default_rng(seed)
    V, P, S = np.zeros((size, 0)), np.zeros((size, 0)), np.zeros((size, 0))  # S: Z'u for each u
    B = np.zeros((steps, steps))
    largest = 0.0

    def new_direction() -> np.ndarray:
        w = rng.standard_normal(size)
        for _ in range(2):
            w -= V @ (V.T @ w)
        return w / np.linalg.norm(w)

    v = new_direction()
    for k in range(steps):
        c, tt, zt = products(vectors, size, at, v, P)
        largest = max(largest, np.sqrt(tt))
        nothing = size * np.finfo(float).eps * largest
        p, s, alpha = v - P @ c, zt - S @ c, np.sqrt(max(0.0, tt - c @ c))
        if nothing < alpha < AGAIN * np.sqrt(tt):  # what is left is small against what was taken: once more
            p /= alpha
            c, tt, zt = products(vectors, size, at, p, P)
            p, s, alpha = alpha * (p - P @ c), alpha * (zt - S @ c), alpha * np.sqrt(max(0.0, tt - c @ c))
        if alpha <= nothing:  # Z v lies among the earlier left vectors
            p, s, alpha = np.zeros(size), np.zeros(size), 0.0
        else:
            p, s = p / alpha, s / alpha
        V, B[k, k] = np.column_stack((V, v)), alpha
        P, S = np.column_stack((P, p)), np.column_stack((S, s))
        if k + 1 < steps:
            w = s - alpha * v
            before = np.linalg.norm(s)
            for _ in range(2):
                w -= V @ (V.T @ w)
            beta = np.linalg.norm(w)
            if beta > size * np.finfo(float).eps * max(largest, before):
                B[k, k + 1], v = beta, w / beta
            else:
                v = new_direction()
    return V, B


def components(vectors: DataFrame, size: int, at: Centre, many: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(W, e, explained): unit eigenvectors of the covariance as columns, by falling eigenvalue; their shares of the trace."""
    V, B = bidiagonalised(vectors, size, at)
    if not B.size:
        return np.zeros((size, 0)), np.zeros(0), np.zeros(0)
    _, sigma, right = np.linalg.svd(B)
    W = V @ right.T
    some = sigma > size * np.finfo(float).eps * sigma[0] if sigma[0] > 0 else np.zeros(len(sigma), bool)
    keep = np.flatnonzero(some)[:many]
    e = sigma ** 2 / at.n
    return W[:, keep], e[keep], e[keep] / max(e.sum(), np.finfo(float).tiny)


def identity_error(vectors: DataFrame, size: int, at: Centre, to: np.ndarray) -> float:
    """Largest absolute entry of the whitened rows' covariance (divisor n) minus the identity."""
    m = to.shape[1]

    def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(m + m * m)
        for b in batches:
            w = at.rows(integers(b.column(1), size)) @ to
            total[:m] += w.sum(axis=0)
            total[m:] += (w.T @ w).ravel()
        return total

    s = np.array(task_sums(vectors, partial, m + m * m)) / at.n
    return float(np.abs(s[m:].reshape(m, m) - np.outer(s[:m], s[:m]) - np.eye(m)).max())


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", many: int = COMPONENTS) -> DataFrame:
    """One row for each usable row and component: ``id_col, component, n, deviation, whitened, explained, identity_error``."""
    d = ready(rows).select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{vector_col}`").alias("_vector"))
    vectors, size = of_usual_size(written(usable(d, "_vector"), "vectors"), "_vector")
    struct = T.StructType([T.StructField(id_col, d.schema["_id"].dataType), *T.StructType.fromDDL(
        "component int, n long, deviation long, whitened double, explained double, identity_error double").fields])
    schema = to_arrow_schema(struct)
    at = centre(vectors, size) if size else Centre(0, [])
    W, e, explained = components(vectors, size, at, many) if at.n else (np.zeros((size, 0)),) + (np.zeros(0),) * 2
    m = W.shape[1]
    if not m:
        return vectors.sparkSession.createDataFrame([], struct)
    to = W / np.sqrt(e)
    error = identity_error(vectors, size, at, to)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, OUT_ROWS):
                b = batch.slice(i, OUT_ROWS)
                x = integers(b.column(1), size)
                n = b.num_rows * m
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), m))), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), b.num_rows)),
                    pa.array(np.full(n, at.n)), pa.array(np.repeat(at.deviation(x), m)), pa.array((at.rows(x) @ to).ravel()),
                    pa.array(np.tile(explained, b.num_rows)), pa.array(np.full(n, error))], schema=schema)

    return vectors.mapInArrow(run, struct)
