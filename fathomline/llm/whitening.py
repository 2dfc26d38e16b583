"""Whitening of embeddings by shifted Cholesky QR (Fukaya, Kannan, Nakatsukasa, Yamamoto and Yanagisawa, 2020).

A pass over the rows forms the Gram matrix of the centred rows after the triangular solves so far; its Cholesky factor,
of a slightly shifted matrix where the rows may be dependent, is the next solve. The composed factor R has
X'X = R'GR with the last Gram matrix G, so the singular values and right vectors of G^(1/2) R are those of the rows.
Nothing but d x d matrices reaches the driver, and rows are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import landed, pick

#: An entry c is used as floor(SCALE * c) + SHIFT; entries beyond +-LARGEST / SCALE count as that.
SCALE, SHIFT, LARGEST = 1024, 100_000, float(1 << 61)
COMPONENTS = 8
#: Gram passes end when the orthogonalised rows are this close to orthonormal, or after so many.
ORTHONORMAL, PASSES = 1e-9, 6
#: A direction with less than this share of the largest variance has none.
NO_VARIANCE = 1e-20
_LOW = (1 << 32) - 1
_LONG = (1 << 63) - 1


def usable_rows(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """id, x: the rows of finite vectors, with their entries as whole numbers, as a landed table.

    A vector that is null, empty, or holds a null, NaN or infinite entry is dropped, and so are vectors of another length
    than most have (of equally frequent lengths the longest stays). Repeated rows and null ids stay.
    """
    rows = pick(vectors, {"id": (id_column, "long"), "v": (vector_column, "array<double>")})
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform("v", lambda c: (F.floor(F.least(F.greatest(c * float(SCALE), F.lit(-LARGEST)), F.lit(LARGEST))) + SHIFT))
    rows = landed(rows.filter(F.col("v").isNotNull() & (F.size("v") > 0) & F.coalesce(finite, F.lit(False)))
                  .select("id", whole.alias("x")), "whole-vectors")
    usual = rows.groupBy(F.size("x").alias("d")).count().agg(F.max_by("d", F.struct("count", "d"))).first()[0]
    return rows.filter(F.size("x") == (usual or 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _added(rows: DataFrame, per_batch, length: int, kind: type) -> np.ndarray:
    """Sums over all rows of vectors that `per_batch` makes of a matrix: added in a task, then by position by Spark."""
    def partial(batches):
        total = np.zeros(length, kind)
        for batch in batches:
            if batch.num_rows:
                total += per_batch(_matrix(batch.column("x")))
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.from_numpy_dtype(kind)))], ["t"])

    name = "long" if kind is np.int64 else "double"
    parts = rows.select("x").mapInArrow(partial, f"t array<{name}>")
    sums = parts.select(F.posexplode("t").alias("at", "t")).groupBy("at").agg(F.sum("t").alias("t")).collect()
    found = np.zeros(length, object if kind is np.int64 else kind)
    for r in sums:
        found[r["at"]] = r["t"]
    return found


@dataclass(frozen=True)
class Whitening:
    """Rows n, exact sums per dimension, and the leading components by falling variance (population, divisor n)."""

    n: int
    sums: tuple[int, ...]
    #: One unit vector a column; variance 0 where a direction has none.
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float | None

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of whole-number rows; NaN along a direction without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.variances > 0, ((x - self.mean) @ self.components) / np.sqrt(self.variances), np.nan)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - S)^2, exact; None where a long can't hold it."""
        reach = max((abs(s) for s in self.sums), default=0) + self.n * int(np.abs(x).max(initial=0))
        if reach < 1 << 62:
            apart = self.n * x - np.array(self.sums, np.int64)
            if x.shape[1] * int(np.abs(apart).max(initial=0)) ** 2 <= _LONG:
                return (apart * apart).sum(axis=1).tolist()
        apart = self.n * x.astype(object) - np.array(self.sums, object)
        return [s if s <= _LONG else None for s in (int((row * row).sum()) for row in apart)]


def _cholesky(gram: np.ndarray, n: int, error: float) -> np.ndarray:
    """Upper triangular factor; of the shifted matrix where the rows may be dependent, with the shift of the method."""
    d = len(gram)
    least = np.linalg.eigvalsh(gram)[0]
    if least <= d * error:
        gram = gram + 11 * (n * d + d * (d + 1)) * (np.finfo(float).eps / 2) * np.linalg.norm(gram, 2) * np.eye(d)
    return np.linalg.cholesky(gram).T


def fit(rows: DataFrame, count: int = COMPONENTS) -> Whitening:
    """The first `count` components of rows of `usable_rows` (as many as there are dimensions, if fewer).

    One pass for the sums, usually three for Gram matrices and one that measures the covariance of the whitened rows.
    No rows give a Whitening without components. Equal variances keep any basis of their plane.
    """
    first = rows.select(F.size("x").alias("d")).first()
    if first is None:
        return Whitening(0, (), np.zeros((0, 0)), np.zeros(0), np.zeros(0), None)
    d = first["d"]

    def sums_of(x: np.ndarray) -> np.ndarray:  # two halves, so that no sum of longs overflows
        return np.concatenate([[len(x)], (x >> 32).sum(axis=0), (x & _LOW).sum(axis=0)])

    found = [int(v) for v in _added(rows, sums_of, 2 * d + 1, np.int64)]
    n, sums = found[0], tuple((high << 32) + low for high, low in zip(found[1:d + 1], found[d + 1:]))
    mean = np.array([s / n for s in sums])

    def gram_after(solve: np.ndarray | None) -> np.ndarray:
        def products(x: np.ndarray) -> np.ndarray:
            q = x - mean
            if solve is not None:
                # Rows times the inverse of the triangular factor, from a solve with its transpose.
                q = np.linalg.solve(solve.T, q.T).T
            return (q.T @ q).ravel()
        g = _added(rows, products, d * d, np.float64).reshape(d, d)
        return (g + g.T) / 2

    gram, factor = gram_after(None), np.eye(d)
    if np.trace(gram) > 0:
        for at in range(PASSES):
            values = np.linalg.eigvalsh(gram)
            if at and all(abs(v - 1) <= ORTHONORMAL or v <= ORTHONORMAL for v in values):
                break
            factor = _cholesky(gram, n, np.finfo(float).eps * max(values[-1], 0)) @ factor
            gram = gram_after(factor)
    values, vectors = np.linalg.eigh(gram)
    _, singular, right = np.linalg.svd(np.sqrt(np.maximum(values, 0))[:, None] * (vectors.T @ factor))
    variances, total = singular ** 2 / n, float((singular ** 2 / n).sum())
    variances = np.where(variances > NO_VARIANCE * variances[0], variances, 0.0)[:count]
    model = Whitening(n, sums, right[:count].T, variances,
                      variances / total if total else np.full(len(variances), np.nan), None)
    held = np.flatnonzero(variances > 0)
    if not len(held):
        return model

    def moments(x: np.ndarray) -> np.ndarray:
        w = model.project(x)[:, held]
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    k = len(held)
    measured = _added(rows, moments, k + k * k, np.float64) / n
    covariance = measured[k:].reshape(k, k) - np.outer(measured[:k], measured[:k])
    error = float(np.abs(covariance - np.eye(k)).max())
    return Whitening(n, sums, model.components, variances, model.explained, error)


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """id, n, deviation and the list of whitened coordinates of every row of `usable_rows`.

    Coordinates along a direction without variance are null; without rows the result is empty.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def of(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"))
                w = shared.value.project(x)
                flat = pa.array(w.ravel(), pa.float64(), mask=np.isnan(w).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), flat)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array([shared.value.n] * len(w), pa.int64()),
                     pa.array(shared.value.deviations(x), pa.int64()), lists], ["id", "n", "deviation", "whitened"])

    return rows.mapInArrow(of, "id long, n long, deviation long, whitened array<double>")
