"""Operator 13: embedding whitening by spectrum slicing.

Every entry c of a vector becomes the integer floor(64 c) + 1000000. One pass
counts the vectors and sums each dimension, a second one sums the products of
the entries less the rounded means; both are sums of integers, exact whatever
the order of the tasks, so the covariance is rounded once, at its last
division. ``spectrum`` takes its leading eigenvectors apart on the driver, where
only a matrix of a vector's dimensions arrives. Two more passes project all
vectors: one for the covariance of the results, one for the results.

A task holds one Arrow batch and a matrix of sums; partial sums meet by matrix
entry, after every task has added up its own, so nothing is ever grouped by
what the vectors hold.

Defined results: rows whose vector is null, empty, or holds a null or
non-finite entry are dropped; a shorter vector counts as one with entries 0
behind it; repeated rows are vectors of their own; a null id stays null;
entries saturate beyond 2^61; a deviation that no long can hold is null;
components without variance (to double precision) can't be whitened and are
left out, so vectors that are all alike, or a single one, give no rows, nor
does an empty table. Columns other than the two named are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from protoclass.llm.common import in_worker, table
from protoclass.llm.spectrum import leading

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Vectors worked on at a time.
ROWS_AT_ONCE = 1024
_MOST = 1 << 61
_HALF = 60
#: An eigenvalue below this share of the largest, a dimension, is rounding.
_NO_VARIANCE = 1e-14


class Whitening(NamedTuple):
    """What the fit has found; its size depends on the dimensions alone."""

    n: int
    centre: list[int]  # rounded means
    rest: list[int]  # n times the mean, less n times the centre, exactly
    values: np.ndarray  # eigenvalues
    vectors: np.ndarray  # columns
    trace: float


def integers(column: pa.ListArray, dim: int | None = None) -> np.ndarray:
    """The integer matrix of clean vectors, of ``dim`` columns (None: the longest's)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    with np.errstate(over="ignore"):
        x = np.clip(np.floor(SCALE * flat), -_MOST, _MOST).astype(np.int64) + OFFSET
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    dim = int(lengths.max(initial=0)) if dim is None else dim
    if len(lengths) and (lengths == dim).all():
        return x.reshape(len(lengths), dim)
    out = np.full((len(lengths), dim), OFFSET, np.int64)
    out[np.arange(dim) < lengths[:, None]] = x
    return out


def _sums(m: np.ndarray) -> list[int]:
    """Exact column sums."""
    if not m.size:
        return [0] * m.shape[1]
    if m.dtype != object and max(abs(int(m.min())), abs(int(m.max()))) * len(m) >= 1 << 62:
        m = m.astype(object)
    return [int(s) for s in m.sum(axis=0)]


def _centred(x: np.ndarray, centre: list[int]) -> np.ndarray:
    """x less the centre, exactly: long integers, or Python's where those don't suffice."""
    far = max((abs(c) for c in centre), default=0)
    if x.size and far + max(abs(int(x.min())), abs(int(x.max()))) >= 1 << 62:
        return x.astype(object) - np.array(centre, object)
    return x - np.array(centre, np.int64)


def _products(z: np.ndarray) -> np.ndarray:
    """z'z, exactly, as Python integers."""
    if not z.size:
        return np.zeros((z.shape[1], z.shape[1]), object)
    top = max(abs(int(z.min())), abs(int(z.max())))
    if top * top * len(z) < 1 << 53:  # exact in floating point
        f = z.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    if z.dtype != object and top * top * len(z) < 1 << 63:
        return (z.T @ z).astype(object)
    z = z.astype(object)
    return z.T @ z


def _clean(rows: DataFrame, vector: str) -> DataFrame:
    """``rows`` of usable vectors, as doubles in ``vector``."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.withColumn(vector, v).filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(False)))


def _added(total: np.ndarray | None, m: np.ndarray) -> np.ndarray:
    """Sum of two matrices of Python integers, the smaller one with zeros around it."""
    if total is None or total.shape == m.shape:
        return m if total is None else total + m
    out = np.zeros(np.maximum(total.shape, m.shape), object)
    for part in (total, m):
        out[: part.shape[0], : part.shape[1]] += part
    return out


def _totals(rows: DataFrame, per_block: Callable[[np.ndarray], np.ndarray], dim: int | None) -> dict[tuple[int, int], int]:
    """Exact sums over all vectors of a matrix of Python integers that a block of them gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in (b.slice(a, ROWS_AT_ONCE) for b in batches for a in range(0, b.num_rows, ROWS_AT_ONCE)):
            total = _added(total, per_block(integers(b.column(0), dim)))
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array([v >> _HALF for v in total.flat], pa.int64()),
                 pa.array([v & ((1 << _HALF) - 1) for v in total.flat], pa.int64())], names=["i", "j", "high", "low"])

    parts = rows.mapInArrow(in_worker("embedding_whitening", run), "i int, j int, high bigint, low bigint")
    sums = parts.groupBy("i", "j").agg(F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    # As many rows as the matrix has entries.
    return {(r.i, r.j): (int(r.high) << _HALF) + int(r.low) for r in sums.collect()}


def covariance(n: int, rest: list[int], products: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance (divisor n), each entry rounded once."""
    d = len(rest)
    v = np.empty((d, d))
    for i in range(d):
        for j in range(d):
            v[i, j] = (n * products[i, j] - rest[i] * rest[j]) / (n * n)
    return v


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Mean and leading eigenpairs of the vectors (the only column of ``rows``); None without any."""
    sums = _totals(rows, lambda x: np.array([[len(x)] * x.shape[1], _sums(x - OFFSET)], object), None)
    if not sums:
        return None
    dim = 1 + max(j for _, j in sums)
    n = sums[0, 0]
    # Less the offset, so that entries that some vectors lack add nothing.
    totals = [sums[1, j] + n * OFFSET for j in range(dim)]
    centre = [(2 * s + n) // (2 * n) for s in totals]
    rest = [s - n * c for s, c in zip(totals, centre, strict=True)]
    products = _totals(rows, lambda x: _products(_centred(x, centre)), dim)
    v = covariance(n, rest, products)
    values, vectors = leading(v, components)
    real = values > _NO_VARIANCE * dim * max(float(values[0]), 0.0)
    return Whitening(n, centre, rest, values[real], vectors[:, real], float(np.trace(v)))


def _whitened(w: Whitening, z: np.ndarray) -> np.ndarray:
    y = z.astype(np.float64) - np.array([r / w.n for r in w.rest])
    return (y @ w.vectors) / np.sqrt(w.values)


def _deviations(w: Whitening, z: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exactly."""
    if not z.size:
        return []
    top = w.n * max(abs(int(z.min())), abs(int(z.max()))) + max(map(abs, w.rest))
    if top * top * z.shape[1] < 1 << 63:
        return (np.square(w.n * z - np.array(w.rest, np.int64)).sum(axis=1)).tolist()
    exact = np.square(w.n * z.astype(object) - np.array(w.rest, object)).sum(axis=1)
    return [int(e) if e < 1 << 63 else None for e in exact]


def identity_error(rows: DataFrame, w: Whitening) -> float:
    """Largest absolute entry of the results' covariance less the identity."""
    k = len(w.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for b in (b.slice(a, ROWS_AT_ONCE) for b in batches for a in range(0, b.num_rows, ROWS_AT_ONCE)):
            y = _whitened(w, _centred(integers(b.column(0), len(w.centre)), w.centre))
            total += np.vstack((y.T @ y, y.sum(axis=0)))
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], names=["i", "j", "v"])

    sums = rows.mapInArrow(in_worker("embedding_whitening", run), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    total = np.zeros((k + 1, k))
    for r in sums.collect():  # a row for each entry of the matrix
        total[r.i, r.j] = r.v / w.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


_OUT = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """key, component, n, deviation, whitened, explained, identity_error for every vector and component."""
    spark = rows.sparkSession
    clean = _clean(rows.select(F.col(key).cast("bigint").alias(key), F.col(vector).alias(vector)), vector)
    vectors = clean.select(vector)
    w = fit(vectors, components)
    schema = f"`{key}` bigint, {_OUT}"
    if w is None or not len(w.values):
        return spark.createDataFrame([], schema)
    error = identity_error(vectors, w)
    k = len(w.values)
    explained = w.values / w.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(a, ROWS_AT_ONCE) for b in batches for a in range(0, b.num_rows, ROWS_AT_ONCE)):
            z = _centred(integers(b.column(1), len(w.centre)), w.centre)
            each = np.repeat(np.arange(b.num_rows), k)
            total = k * b.num_rows
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), b.num_rows)), pa.array(np.full(total, w.n)),
                 pa.array(_deviations(w, z), pa.int64()).take(pa.array(each)), pa.array(_whitened(w, z).ravel()), pa.array(np.tile(explained, b.num_rows)),
                 pa.array(np.full(total, error))],
                names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return clean.mapInArrow(in_worker("embedding_whitening", run), schema)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
