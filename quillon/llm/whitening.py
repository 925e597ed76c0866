"""Whitening of embeddings: leading components of a distributed covariance, by an eigensolver of our own.

1. The fit list is every distinct quantised vector once. Tasks send, of their part of it, sums for each dimension, added in
   Spark as integers (exact); then products of the vectors after the mean is taken off, one row a pair of dimensions, added
   in Spark. What reaches the driver has dims * (dims + 1) / 2 rows, whatever the table: dims is bounded by MAX_DIMS.
2. On the driver the covariance is made tridiagonal by Householder reflections; the leading eigenvalues are found by
   bisection on Sturm counts (how many lie above a bound); their vectors by inverse iteration, made orthogonal within
   clusters of close eigenvalues, and taken back through the reflections.
3. The mean and the scaled components, dims * components numbers, are broadcast and every row is projected in batches.
4. The covariance of the whitened fit list is measured by two more passes, its mean and then its centred products.

Results for odd input: vectors that are null or hold null or non-finite entries, or one beyond 2^40 / scale, take no part; the dimension is the most
frequent length of the others (ties: the longer), vectors of other lengths and empty ones take no part; components whose
eigenvalue is below 1e-12 of the trace cannot be scaled and are left out, so an empty table, one distinct vector or constant
dimensions give fewer components or no rows; repeated vectors count once in the fit and each gives its rows; null ids are
kept; a deviation beyond 64 bits is null; further columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm._common import read, stored

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: dims squared must fit the driver.
MAX_DIMS = 2048
#: Quantised entries are smaller than this.
LARGEST = 2.0**40
#: Eigenvalues below this share of the trace are rounding errors.
LEAST_SHARE = 1e-12


def quantised(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """floor(scale * c) + shift of each entry as a long."""
    return F.transform(vector, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")) + F.lit(shift))


def _finite(vector: Column, scale: int) -> Column:
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) * float(scale) >= LARGEST)
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, bad)


def usable(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> tuple[DataFrame, int]:
    """The stored rows that take part (id, x: quantised entries) and their dimension (0 for none)."""
    v = F.col(f"`{vector_col}`")
    good = vectors.select(F.col(f"`{id_col}`").alias("id"), v.alias("v")).filter(_finite(F.col("v"), scale))
    rows = stored(good.select("id", quantised(F.col("v"), scale, shift).alias("x")), "vectors")
    lengths = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    if not lengths:
        return rows, 0
    dims = lengths[0]["dims"]
    if dims > MAX_DIMS:
        raise ValueError(f"{dims} dimensions, at most {MAX_DIMS}")
    return rows.filter(F.size("x") == dims), dims


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    """Column x of a batch, one vector a row."""
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dims)


def _summed(rows: DataFrame, made, *, exact: bool = False) -> dict:
    """{place: sum over all batches of what `made` returns for one}; a task sends one row a place. exact: integers of any size."""
    kind = "decimal(38,0)" if exact else "double"

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                some = made(b).astype(object) if exact else made(b)
                total = some if total is None else total + some
        if total is not None:
            at = np.arange(len(total), dtype=np.int64)
            value = pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0)) if exact else pa.array(total)
            yield pa.RecordBatch.from_pydict({"at": pa.array(at), "value": value})

    sums = rows.mapInArrow(part, f"at long, value {kind}").groupBy("at").agg(F.sum("value").alias("value"))
    return dict(sums.collect())


def _products(rows: DataFrame, centred, width: int) -> np.ndarray:
    """The sum over all rows of the outer products of centred(batch), a matrix of rows by width."""
    upper = np.triu_indices(width)

    def made(b: pa.RecordBatch) -> np.ndarray:
        y = centred(b)
        return (y.T @ y)[upper]

    sums = _summed(rows, made)
    out = np.zeros((width, width))
    out[upper] = [sums[k] for k in range(len(upper[0]))]
    return out + np.triu(out, 1).T


def moments(fit: DataFrame, dims: int) -> tuple[int, list[int], np.ndarray]:
    """n, the exact sum of each dimension and the covariance (divisor n) of the rows of fit (column x)."""
    made = lambda b: np.append(_matrix(b, dims).sum(axis=0), b.num_rows)
    sums = _summed(fit, made, exact=True)
    n, totals = int(sums[dims]), [int(sums[k]) for k in range(dims)]
    whole, part = mean_of(n, totals)
    return n, totals, _products(fit, lambda b: (_matrix(b, dims) - whole) - part, dims) / n


def mean_of(n: int, totals: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The mean of each dimension as whole part and rest, so that no digit is lost where it is taken off."""
    return np.array([s // n for s in totals], dtype=np.int64), np.array([(s % n) / n for s in totals])


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, second diagonal and the orthogonal q with q.T @ a @ q tridiagonal, by Householder reflections."""
    a, n = np.array(a, dtype=float), len(a)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1 :, k]
        v = x.copy()
        v[0] += np.copysign(np.linalg.norm(x), x[0])
        length = np.linalg.norm(v)
        if length == 0.0:
            continue
        v /= length
        low = a[k + 1 :, k:]
        low -= 2.0 * np.outer(v, v @ low)
        right = a[k:, k + 1 :]
        right -= 2.0 * np.outer(right @ v, v)
        q[:, k + 1 :] -= 2.0 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), (np.diag(a, 1) + np.diag(a, -1)) / 2.0, q


def count_above(d: np.ndarray, e: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many eigenvalues of a tridiagonal matrix lie above each bound: the positive pivots of its shifted factors."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    pivot = d[0] - bounds
    above = (pivot > 0).astype(np.int64)
    for k in range(1, len(d)):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = d[k] - bounds - e[k - 1] ** 2 / pivot
        above += pivot > 0
    return above


def leading_values(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The k greatest eigenvalues, falling, each bisected until its bounds are neighbouring numbers or nearly so."""
    reach = np.abs(np.append(e, 0.0)) + np.abs(np.append(0.0, e))
    span = max(np.max(np.abs(d) + reach), np.finfo(float).tiny)
    low, high = np.full(k, np.min(d - reach) - span * 1e-15), np.full(k, np.max(d + reach) + span * 1e-15)
    for _ in range(200):
        middle = (low + high) / 2.0
        if np.all((middle <= low) | (middle >= high) | (high - low < span * 1e-17)):
            break
        more = count_above(d, e, middle) > np.arange(k)
        low, high = np.where(more, middle, low), np.where(more, high, middle)
    return (low + high) / 2.0


def _solve(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """(tridiagonal - shift) y = b by elimination with row exchanges; a pivot below `least` is replaced by it."""
    n = len(d)
    diagonal, first, second = d - shift, np.append(e, 0.0), np.zeros(n)
    y = b.copy()
    for k in range(n - 1):
        below = e[k]
        if abs(below) > abs(diagonal[k]):
            diagonal[k], first[k], second[k], under, after = below, diagonal[k + 1], first[k + 1], diagonal[k], first[k]
            y[k], y[k + 1] = y[k + 1], y[k]
            factor = under / diagonal[k]
            diagonal[k + 1], first[k + 1] = after - factor * first[k], -factor * second[k]
        else:
            pivot = diagonal[k] if abs(diagonal[k]) > least else least
            diagonal[k] = pivot
            factor = below / pivot
            diagonal[k + 1] -= factor * first[k]
        y[k + 1] -= factor * y[k]
    for k in range(n - 1, -1, -1):
        pivot = diagonal[k] if abs(diagonal[k]) > least else least
        if k + 1 < n:
            y[k] -= first[k] * y[k + 1]
        if k + 2 < n:
            y[k] -= second[k] * y[k + 2]
        y[k] /= pivot
    return y


def tridiagonal_vectors(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors, one a column, by inverse iteration; close eigenvalues are one cluster and made orthogonal."""
    n = len(d)
    norm = max(np.max(np.abs(d)), np.max(np.abs(e), initial=0.0), np.finfo(float).tiny)
    least, close = np.finfo(float).eps * norm, 1e-3 * norm
    out, begin = np.zeros((n, len(values))), 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > close:
            begin = j
        apart = value - (j - begin) * 2.0 * least  # equal shifts would give equal vectors
        y = 1.0 + 0.5 * np.sin(np.arange(1.0, n + 1) * (j + 1))
        for _ in range(6):
            for _ in range(2):
                y -= out[:, begin:j] @ (out[:, begin:j].T @ y)
            length = np.linalg.norm(y)
            y = _solve(d, e, apart, y / length, least)
        for _ in range(2):
            y -= out[:, begin:j] @ (out[:, begin:j].T @ y)
            y /= np.linalg.norm(y)
        out[:, j] = y
    return out


def leading_components(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to k falling eigenvalues that can be told from 0 and their unit eigenvectors, one a column."""
    if len(covariance) == 0 or not np.trace(covariance) > 0:
        return np.zeros(0), np.zeros((len(covariance), 0))
    size = np.max(np.abs(covariance))
    d, e, q = tridiagonal(covariance / size)
    values = leading_values(d, e, min(k, len(d)))
    values = values[values > LEAST_SHARE * d.sum()]
    vectors = q @ tridiagonal_vectors(d, e, values)
    return values * size, vectors / np.linalg.norm(vectors, axis=0)


@dataclass
class Whitener:
    """What a fit keeps: a few numbers for each dimension and component."""

    n: int = 0
    totals: list[int] = field(default_factory=list)
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    explained: np.ndarray = field(default_factory=lambda: np.zeros(0))
    identity_error: float = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows, a column for each component."""
        whole, part = mean_of(self.n, self.totals)
        return ((x - whole) - part) @ (self.vectors / np.sqrt(self.values))

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - totals)^2, exact; None beyond 64 bits."""
        totals = np.array(self.totals, dtype=object)
        whole, _ = mean_of(self.n, self.totals)
        reach = (int(np.abs(x - whole).max(initial=0)) + 1) * self.n
        if reach * reach * x.shape[1] < 2**63:
            rest = np.array([s % self.n for s in self.totals], dtype=np.int64)
            return (((x - whole) * self.n - rest) ** 2).sum(axis=1).tolist()
        exact = ((x.astype(object) * self.n - totals) ** 2).sum(axis=1)
        return [v if v < 2**63 else None for v in exact]


def fit(rows: DataFrame, dims: int, components: int = COMPONENTS) -> Whitener:
    """Learn from the distinct vectors of rows (column x, `dims` entries)."""
    if dims == 0:
        return Whitener()
    distinct = stored(rows.select("x").distinct(), "fit")
    n, totals, covariance = moments(distinct, dims)
    values, vectors = leading_components(covariance, components)
    out = Whitener(n, totals, values, vectors, values / np.trace(covariance) if len(values) else values)
    if len(values):
        shared = rows.sparkSession.sparkContext.broadcast(out)
        sums = _summed(distinct, lambda b: shared.value.project(_matrix(b, dims)).sum(axis=0))
        mean = np.array([sums[k] / n for k in range(len(values))])
        found = _products(distinct, lambda b: shared.value.project(_matrix(b, dims)) - mean, len(values)) / n
        out.identity_error = float(np.max(np.abs(found - np.eye(len(values)))))
    return out


def whiten(rows: DataFrame, model: Whitener, dims: int) -> DataFrame:
    """id, component (from 1), n, deviation, whitened, explained and identity_error for each row (id, x) and component."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kind = rows.schema["id"].dataType.simpleString()

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k = len(m.values)
        for b in batches:
            if k == 0 or b.num_rows == 0:
                continue
            x = _matrix(b, dims)
            row = pa.array(np.repeat(np.arange(b.num_rows), k))
            yield pa.RecordBatch.from_pydict(
                {
                    "id": b.column("id").take(row),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), b.num_rows)),
                    "n": pa.array(np.full(b.num_rows * k, m.n, dtype=np.int64)),
                    "deviation": pa.array(m.deviation(x), pa.int64()).take(row),
                    "whitened": pa.array(m.project(x).ravel()),
                    "explained": pa.array(np.tile(m.explained, b.num_rows)),
                    "identity_error": pa.array(np.full(b.num_rows * k, m.identity_error)),
                }
            )

    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return rows.select("id", "x").mapInArrow(part, schema)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, dims = usable(read(spark, sf_dir, "embeddings"))
    return whiten(rows, fit(rows, dims), dims).withColumnRenamed("id", "vec_id")
