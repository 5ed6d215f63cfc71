"""Whitening of embeddings by shifted CholeskyQR (operator 12).

The distinct vectors, less their mean, are a tall matrix A.  A pass sums the
Gram matrix of its rows; the Cholesky factor R1 of that (with a shift on the
diagonal, so that a near-singular Gram matrix has one) gives nearly orthogonal
rows by a triangular solve in the tasks.  Two more passes over those rows give
R2 and R3, and Q = A / (R3 R2 R1) is orthogonal to double precision, however
ill-conditioned A is.  The singular values and right vectors of R = R3 R2 R1
are those of A, so only d x d numbers ever reach the driver, whatever the
number of rows; d is the length of a vector.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut, released

SCALE = 256
COMPONENTS = 4
#: Gram passes: a shifted one and two that finish the orthogonalisation.
PASSES = 3
#: Components with less than this share of the largest singular value are rounding noise: such directions have no variance.
RANK_TOLERANCE = 1e-12


@dataclass(frozen=True)
class Whitening:
    """The fit: ``n`` distinct vectors of length ``dim`` with sums ``sums``; ``directions`` (dim x k) and ``values`` of the components."""

    n: int
    dim: int
    sums: tuple[int, ...]
    directions: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float | None = None


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * c)`` of every entry, as long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))


def usable(vectors: DataFrame, id_column: str, vector_column: str, scale: int = SCALE) -> DataFrame:
    """id, x of the rows whose vector is not null or empty, has no null or non-finite entry and has the commonest length (of ties the smallest)."""
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("v")).filter(F.size("v") > 0)
    rows = rows.filter(~F.exists("v", lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == F.lit(float("inf")))))
    lengths = rows.groupBy(F.size("v").alias("dim")).count()
    common = lengths.agg(F.max_by("dim", F.struct("count", -F.col("dim"))).alias("dim")).first()["dim"]
    return rows.filter(F.size("v") == F.lit(common)).select("id", quantised(F.col("v"), scale).alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _summed(rows: DataFrame, size: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all ``rows`` (x) of ``part`` (rows of a batch -> ``size`` numbers): one partial sum a task, added by place in a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                got = part(matrix(batch.column(0)))
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["place", "value"])

    sums = rows.select("x").mapInArrow(released(run), "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    out = np.zeros(size)
    for place, value in sums.collect():  # ``size`` rows, whatever the number of vectors
        out[place] = value
    return out


def _exact_sums(rows: DataFrame, dim: int) -> tuple[int, tuple[int, ...]]:
    """Number of ``rows`` (x) and the sum of each entry, exact: high and low halves are summed apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0))
                n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        columns = [pa.array(np.arange(dim, dtype=np.int32)), pa.array(high), pa.array(low), pa.array(np.full(dim, n, np.int64))]
        yield pa.RecordBatch.from_arrays(columns, names=["place", "high", "low", "n"])

    wide = rows.select("x").mapInArrow(released(run), "place int, high bigint, low bigint, n bigint")
    wide = wide.groupBy("place").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low", "n")]).collect()
    sums, n = [0] * dim, 0
    for r in wide:
        sums[r["place"]], n = (int(r["high"]) << 32) + int(r["low"]), int(r["n"])
    return n, tuple(sums)


def _solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """``rows`` times the inverses of the upper triangular ``factors``, first to last."""
    for r in factors:
        rows = np.linalg.solve(r.T, rows.T).T
    return rows


def fit(distinct: DataFrame, components: int = COMPONENTS, passes: int = PASSES) -> Whitening | None:
    """The whitening of ``distinct`` (x, one row for each different vector); None where there is no row."""
    first = distinct.select(F.size("x").alias("dim")).first()
    if first is None:
        return None
    dim = first["dim"]
    n, sums = _exact_sums(distinct, dim)
    mean = np.array([s / n for s in sums])
    spread = _summed(distinct, dim, lambda x: ((x - mean) ** 2).sum(axis=0))
    if not spread.any():
        return Whitening(n, dim, sums, np.eye(dim)[:, :components], np.zeros(min(dim, components)), 0.0)
    # Rows are divided by their root mean square length, so that no product overflows or vanishes.
    unit = float(np.sqrt(spread.sum() / n))
    factors: list[np.ndarray] = []
    for k in range(passes):
        done = list(factors)
        gram = _summed(distinct, dim * dim, lambda x: (lambda q: (q.T @ q).ravel())(_solved((x - mean) / unit, done))).reshape(dim, dim)
        if k == 0:
            gram[np.diag_indices(dim)] += 11 * (n * dim + dim * (dim + 1)) * np.finfo(float).eps * np.trace(gram)
        factors.append(_cholesky(gram))
    r = np.linalg.multi_dot(factors[::-1]) if len(factors) > 1 else factors[0]
    _, singular, right = np.linalg.svd(r)
    values = (singular * unit) ** 2 / n
    values[singular < RANK_TOLERANCE * singular[0]] = 0.0
    directions = right[:components].T
    signs = np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(directions.shape[1])])
    found = Whitening(n, dim, sums, directions * signs, values[:components], float(spread.sum() / n))
    alive = found.values > 0
    k = int(alive.sum())
    if not k:
        return found

    def moments(x: np.ndarray) -> np.ndarray:
        w = whitened(found, x)[:, alive]
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    got = _summed(distinct, k + k * k, moments)
    centre = got[:k] / n
    covariance = got[k:].reshape(k, k) / n - np.outer(centre, centre)
    error = float(np.abs(covariance - np.eye(k)).max())
    return Whitening(n, dim, sums, found.directions, found.values, found.trace, error)


def _cholesky(gram: np.ndarray) -> np.ndarray:
    """Upper triangular R with R'R = ``gram``; directions that hold nothing get a one on the diagonal, so that they stay as they are."""
    scale = np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1.0))
    even = gram / np.outer(scale, scale)
    for shift in (0.0, 1e-14, 1e-12, 1e-10, 1e-8):
        try:
            return np.linalg.cholesky(even + (shift + (np.diag(even) == 0)) * np.eye(len(even))).T * scale
        except np.linalg.LinAlgError:
            continue
    raise np.linalg.LinAlgError("the Gram matrix has no Cholesky factor")


def whitened(found: Whitening, x: np.ndarray) -> np.ndarray:
    """Rows of ``x`` less the mean, projected on the components, over their standard deviations; NaN where a component has no variance."""
    mean = np.array([s / found.n for s in found.sums])
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(found.values > 0, (x - mean) @ found.directions / np.sqrt(found.values), np.nan)


def deviations(found: Whitening, x: np.ndarray) -> list[int | None]:
    """Sum of ``(n * x - S) ** 2`` over the entries of each row, exact; None where it exceeds a long."""
    sums = np.array(found.sums, dtype=object)
    most = max(int(x.max()), -int(x.min())) * found.n + max(abs(s) for s in found.sums)
    if most * most * found.dim < 1 << 63:
        return ((found.n * x - sums.astype(np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((found.n * x.astype(object) - sums) ** 2).sum(axis=1)
    return [int(e) if e < 1 << 63 else None for e in exact]


def whiten(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each usable vector and component.

    Vectors that are null or empty or hold null or non-finite entries are
    dropped, and so are those of another length than the commonest one.  The
    fit takes each distinct ``floor(scale * c)`` vector once; repeated rows
    and rows of null id all get their results.  There are as many components
    as entries where those are fewer.  A component without variance has
    whitened null and explained 0 (null where no component has any), and
    identity_error covers the others; it is null where there are none.  A
    deviation above the largest long is null.  No usable vectors give no rows.
    Components of equal variance are any basis of their plane; the largest
    entry of a component is positive.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = cut(usable(vectors, id_column, vector_column, scale))
    found = fit(cut(rows.select("x").distinct()), components)
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if found is None:
        return spark.createDataFrame([], schema)
    k = found.directions.shape[1]
    explained = [float(v / found.trace) if found.trace > 0 else None for v in found.values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            x = matrix(batch.column(1))
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(size), k)))
            w = whitened(found, x).ravel()
            columns = [
                ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)), pa.array(np.full(size * k, found.n)),
                pa.array([d for d in deviations(found, x) for _ in range(k)], pa.int64()), pa.array(w, mask=np.isnan(w)),
                pa.array(explained * size, pa.float64()), pa.array([found.identity_error] * (size * k), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.replace(",", "").split()[::2])

    return rows.mapInArrow(released(run), schema.replace("vec_id bigint", f"vec_id {dict(rows.dtypes)['id']}")).withColumnRenamed("vec_id", id_column)
