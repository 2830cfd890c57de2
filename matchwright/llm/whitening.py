"""Whitening of embeddings: pivoted Cholesky, then Jacobi on its factor.

Vectors become integers, so that sums are exact and a row's distance from the
mean is too. The centred scatter of the distinct vectors is added up over the
partitions; what reaches the driver is that one matrix, whose size is the
dimension's alone. There its pivoted Cholesky factor, a triangle, takes
one-sided Jacobi rotations of its columns until they are orthogonal (Veselić
and Hari, Numer. Math. 56, 1989): their squared lengths are the scatter's
eigenvalues, and the columns, at length one, its eigenvectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchwright.llm.batches import map_slices
from matchwright.sources.staging import stage_table

SCALE, SHIFT = 64.0, 1_000_000
COMPONENTS = 16
SWEEPS = 60


def integer_rows(vectors: pa.ListArray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which rows take part, and each one's long entries, floor(64 c) + 1000000."""
    out, fine = [], np.zeros(len(vectors), bool)
    flat = pc.cast(vectors.flatten(), pa.float64())
    values = flat.to_numpy(zero_copy_only=False)  # null entries become NaN
    good = np.isfinite(values)
    sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    valid = vectors.is_valid().to_numpy(zero_copy_only=False)
    for i, (end, size) in enumerate(zip(ends.tolist(), sizes.tolist())):
        own = slice(end - size, end)
        if valid[i] and good[own].all():
            scaled = np.floor(SCALE * values[own])
            if size and np.abs(scaled).max() >= 2.0**62:
                raise OverflowError("an entry is too large for a long")
            fine[i] = True
            out.append(scaled.astype(np.int64) + SHIFT)
    return fine, out


def integer_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, size, x): the remaining rows, ``x`` as little-endian longs."""
    spread = df.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    kind = spread.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine, rows = integer_rows(batch.column("vector"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").filter(pa.array(fine)),
                    pa.array(list(map(len, rows)), pa.int32()),
                    pa.array([r.astype("<i8").tobytes() for r in rows], pa.binary()),
                ],
                ["key", "size", "x"],
            )

    return spread.mapInArrow(run, f"key {kind}, size int, x binary")


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, dims)


def _long_sum(rows: np.ndarray) -> list[int]:
    """Column sums that cannot overflow."""
    high, low = rows >> 32, rows & 0xFFFFFFFF
    return [(int(h) << 32) + int(b) for h, b in zip(high.sum(axis=0), low.sum(axis=0))]


def sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Rows, and the exact sum of each dimension; partitions are added up first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dims
        for batch in batches:
            n += batch.num_rows
            total = [a + b for a, b in zip(total, _long_sum(_matrix(batch.column("x"), dims)))]
        if n:
            values = pa.array([Decimal(v) for v in [n, *total]], pa.decimal128(38, 0))
            places = pa.array(range(dims + 1), pa.int32())
            yield pa.RecordBatch.from_arrays([places, values], ["place", "value"])

    parts = fit.select("x").mapInArrow(run, "place int, value decimal(38,0)")
    total = dict(parts.groupBy("place").agg(F.sum("value")).collect())
    found = [int(total.get(i) or 0) for i in range(dims + 1)]
    return found[0], found[1:]


def centred(rows: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """x - S/n, the whole part of S/n taken off before anything is rounded."""
    base = np.array([s // n for s in total], np.int64)
    rest = np.array([(s % n) / n for s in total])
    return (rows - base).astype(np.float64) - rest


def moments(fit: DataFrame, dims: int, width: int, make) -> np.ndarray:
    """Sum over all rows of y'y, for the rows of ``width`` that ``make`` gives.

    Each partition hands over one matrix, in rows; equal rows are added up
    by tasks of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scatter, any_rows = np.zeros((width, width)), False
        for batch in batches:
            y = make(_matrix(batch.column("x"), dims))
            scatter += y.T @ y
            any_rows = any_rows or batch.num_rows > 0
        if any_rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(width), pa.int32()), pa.array(list(scatter), pa.list_(pa.float64()))],
                ["row", "own"],
            )

    def add(group: pa.Table) -> pa.Table:
        own = group.column("own").combine_chunks()
        total = own.flatten().to_numpy().reshape(-1, width).sum(axis=0)
        return pa.table(
            {"row": group.column("row").slice(0, 1), "own": pa.array([total], pa.list_(pa.float64()))}
        )

    schema = "row int, own array<double>"
    found = fit.select("x").mapInArrow(run, schema).groupBy("row").applyInArrow(add, schema).collect()
    out = np.zeros((width, width))
    for row, own in found:
        out[row] = own
    return (out + out.T) / 2


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order): a[order][:, order] = L L', the largest pivot left first.

    L has as many columns as there are pivots above rounding.
    """
    a = a.copy()
    size = len(a)
    order = np.arange(size)
    factor = np.zeros((size, size))
    least = size * np.finfo(float).eps * max(a.diagonal().max(initial=0), 0)
    for k in range(size):
        p = k + int(np.argmax(a.diagonal()[k:]))
        if not a[p, p] > least:
            return factor[:, :k], order
        for m in (a, factor):
            m[[k, p]] = m[[p, k]]
        a[:, [k, p]] = a[:, [p, k]]
        order[[k, p]] = order[[p, k]]
        factor[k, k] = np.sqrt(a[k, k])
        factor[k + 1 :, k] = a[k + 1 :, k] / factor[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, order


def orthogonal_columns(factor: np.ndarray) -> np.ndarray:
    """One-sided Jacobi: the columns, rotated in pairs until all are orthogonal.

    A sweep is a round robin, whose pairs of one round touch no column twice
    and are rotated together.
    """
    g = factor.copy()
    size = g.shape[1]
    if size < 2:
        return g
    ring = list(range(size + size % 2))  # an odd one out rests
    tight = size * np.finfo(float).eps
    for _ in range(SWEEPS):
        worst = 0.0
        for _ in range(len(ring) - 1):
            half = len(ring) // 2
            pairs = np.array(list(zip(ring[:half], reversed(ring[half:]))))
            i, j = pairs[(pairs < size).all(axis=1)].T
            x, y = g[:, i], g[:, j]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            scale = np.sqrt(xx * yy)
            cosine = np.abs(xy) / np.where(scale > 0, scale, 1)
            worst = max(worst, cosine.max(initial=0))
            turn = cosine > tight
            zeta = (yy - xx) / np.where(turn, 2 * xy, 1)
            t = np.where(turn, np.where(zeta < 0, -1, 1) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta)), 0)
            c = 1 / np.sqrt(1 + t * t)
            g[:, i], g[:, j] = c * x - c * t * y, c * t * x + c * y
            ring = [ring[0], ring[-1], *ring[1:-1]]
        if worst <= tight:
            break
    return g


def components(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, of rank many.

    The largest entry of each vector is positive, so the sign is one and the
    same wherever the job is run.
    """
    factor, order = pivoted_cholesky(scatter)
    g = np.empty_like(factor)
    g[order] = orthogonal_columns(factor)
    length = np.sqrt((g * g).sum(axis=0))
    by = np.argsort(-length, kind="stable")
    g, length = g[:, by], length[by]
    vectors = g / length
    if vectors.size:
        top = np.abs(vectors).argmax(axis=0)
        vectors *= np.sign(vectors[top, np.arange(vectors.shape[1])])
    return length**2, vectors


@dataclass(frozen=True)
class Whitening:
    """What the fit list says; nothing of it grows with the rows."""

    dims: int
    n: int
    total: list[int]
    eigenvalues: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float

    def apply(self, rows: np.ndarray) -> np.ndarray:
        return centred(rows, self.n, self.total) @ self.vectors / np.sqrt(self.eigenvalues)

    def deviations(self, rows: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2, exact."""
        base = np.array([s // self.n for s in self.total], np.int64)
        rest = [s % self.n for s in self.total]
        away = rows - base
        most = (int(np.abs(away).max(initial=0)) + 1) * self.n
        if most * most * max(self.dims, 1) < 1 << 62:
            scaled = away * self.n - np.array(rest, np.int64)
            return (scaled * scaled).sum(axis=1).tolist()
        return [
            sum((int(a) * self.n - r) ** 2 for a, r in zip(row, rest)) for row in away.tolist()
        ]


def commonest_size(rows: DataFrame) -> int | None:
    """The length that most vectors have (of equally many, the greatest)."""
    found = rows.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    return found["size"] if found else None


def fit_whitening(rows: DataFrame, most: int = COMPONENTS) -> Whitening | None:
    """From (size, x) rows, each distinct vector once; None without vectors."""
    dims = commonest_size(rows)
    if not dims:
        return None
    fit = stage_table(rows.where(F.col("size") == dims).select("x").distinct(), "distinct-vectors")
    n, total = sums(fit, dims)
    scatter = moments(fit, dims, dims, lambda x: centred(x, n, total)) / n
    values, vectors = components(scatter)
    found = Whitening(
        dims, n, total, values[:most], vectors[:, :most], values[:most] / scatter.trace(), 0.0
    )
    width = len(found.eigenvalues)
    error = 0.0
    if width:
        white = moments(fit, dims, width, found.apply) / n
        error = float(np.abs(white - np.eye(width)).max())
    return Whitening(*(getattr(found, f) for f in list(Whitening.__dataclass_fields__)[:-1]), error)


def whiten(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS
) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error).

    One row per remaining vector and component, by falling eigenvalue from 1.
    ``deviation`` is a decimal: it is exact, and with very many rows past a
    long. Rows whose vector is null or holds null or non-finite entries take
    no part, nor do vectors of another length than most have; null keys and
    repeated rows are rows like any other (equal vectors are fitted once);
    entries past 2^56 raise. There are as many components as the covariance
    has rank, ``most`` at most: none for a single distinct vector, whose rows
    are then left out, as in an empty table, and for vectors of no entries.
    Equal eigenvalues have some basis of their space, the same for all rows.
    Other columns are dropped. The fit holds a matrix of the dimension's square.
    """
    rows = integer_vectors(df, key, vector)
    fit = fit_whitening(rows, most)
    kind = rows.schema["key"].dataType.simpleString()
    schema = (
        f"key {kind}, component int, n long, deviation decimal(38,0),"
        " whitened double, explained double, identity_error double"
    )
    if fit is None:
        empty = df.sparkSession.createDataFrame([], schema)
        return empty.withColumnRenamed("key", key)
    width = len(fit.eigenvalues)

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = _matrix(batch.column("x"), fit.dims)
            times = len(x) * width
            by_row = pa.array(np.repeat(np.arange(len(x)), width))
            exact = pa.array(list(map(Decimal, fit.deviations(x))), pa.decimal128(38, 0))
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(by_row),
                    pa.array(np.tile(np.arange(1, width + 1), len(x)), pa.int32()),
                    pa.array(np.full(times, fit.n), pa.int64()),
                    exact.take(by_row),
                    pa.array(fit.apply(x).ravel(), pa.float64()),
                    pa.array(np.tile(fit.explained, len(x)), pa.float64()),
                    pa.array(np.full(times, fit.identity_error), pa.float64()),
                ],
                names=[part.split()[0] for part in schema.split(", ")],
            )

        return work

    own = rows.where(F.col("size") == fit.dims)
    return map_slices(own, "x", schema, make).withColumnRenamed("key", key)
