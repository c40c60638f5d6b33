"""Embeddings whitened by their leading principal components.

Vectors become integers, x = floor(scale * c) + shift, so sums are exact. One pass takes
the sums of every dimension, a second one the covariance: each task centres its vectors
and multiplies them, and adds up a matrix of its own; the tasks' rows are summed by
dimension in Spark. What reaches the driver is one matrix of dimensions times dimensions,
whatever the number of vectors.

There the matrix is brought to tridiagonal form by Householder reflections; Sturm counts
(how many eigenvalues lie below a number) and bisection give its leading eigenvalues;
inverse iteration gives their vectors, those of a cluster of near eigenvalues made
orthogonal to each other on every step; and the reflections turn them back. The projection,
dimensions times components, goes to the tasks with the code. Another pass over the
whitened rows measures how far their covariance is from the identity.

No step groups vectors, so equal vectors, however many, never meet in a task.

Rows whose vector is null or has a null, a NaN or an infinite entry are dropped, and so are
those with an entry beyond 2^46, whose x would be no exact double. Vectors have as many
dimensions as most of them have (of equally frequent numbers the larger); others are
dropped. Components whose eigenvalue is no more than rounding error of the largest one
cannot be whitened and are left out, so equal vectors only, a single vector or an empty
table give no rows. Null and repeated ids and repeated rows are kept. A deviation beyond
64 bits is null. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.sizing import written

_FURTHEST = float(1 << 46)
_CLUSTER = 1e-3
_EPS = float(np.finfo(np.float64).eps)


@dataclass(frozen=True)
class Whitening:
    """What was learned: sums of each dimension, covariance, leading eigenvalues, components as columns."""
    n: int
    sums: tuple[int, ...]
    covariance: np.ndarray
    values: np.ndarray
    components: np.ndarray

    @property
    def explained(self) -> np.ndarray:
        return self.values / np.trace(self.covariance)


# --- The symmetric eigenproblem on the driver --------------------------------
def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal and side diagonal of a similar matrix, and the Householder reflections that lead to it."""
    a = np.array(matrix, np.float64)
    n = len(a)
    reflections = []
    for k in range(n - 2):
        v = a[k + 1:, k].copy()
        size = np.linalg.norm(v)
        if size == 0 or not np.any(v[1:]):
            continue
        v[0] += size if v[0] >= 0 else -size
        v /= np.linalg.norm(v)
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        p -= (v @ p) * v
        rest -= 2 * (np.outer(v, p) + np.outer(p, v))
        column = a[k + 1:, k]
        column -= 2 * (v @ column) * v
        a[k, k + 1:] = column
        reflections.append((k + 1, v))
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def below(diagonal: np.ndarray, side: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues of the tridiagonal matrix lie below each shift."""
    squares = side * side
    least = max(np.max(np.abs(diagonal), initial=0.0), np.max(np.abs(side), initial=0.0), 1e-300) * _EPS * _EPS
    q = diagonal[0] - shifts
    count = (q < 0).astype(np.int64)
    for k in range(1, len(diagonal)):
        q = np.where(np.abs(q) < least, -least, q)
        q = diagonal[k] - shifts - squares[k - 1] / q
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, side: np.ndarray, most: int) -> np.ndarray:
    """The `most` largest eigenvalues, falling: all brackets are halved side by side until no double lies inside."""
    n = len(diagonal)
    reach = np.concatenate([[0], np.abs(side)]) + np.concatenate([np.abs(side), [0]])
    low, high = np.min(diagonal - reach), np.max(diagonal + reach)
    room = _EPS * max(abs(low), abs(high)) * n + 1e-300
    ranks = n - 1 - np.arange(most)
    lows, highs = np.full(most, low - room), np.full(most, high + room)
    while True:
        middle = lows + (highs - lows) / 2
        if np.all((middle <= lows) | (middle >= highs)):
            return middle
        under = below(diagonal, side, middle) <= ranks
        lows, highs = np.where(under, middle, lows), np.where(under, highs, middle)


def _solve(diagonal: np.ndarray, side: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """The solution for a shifted tridiagonal matrix by elimination with row exchanges; pivots are `least` at least."""
    n = len(diagonal)
    main, up, up2, x = diagonal - shift, np.append(side, 0.0), np.zeros(n), right.copy()
    for k in range(n - 1):
        low = side[k]
        if abs(main[k]) >= abs(low):
            if abs(main[k]) < least:
                main[k] = least
            f = low / main[k]
            main[k + 1] -= f * up[k]
            x[k + 1] -= f * x[k]
        else:
            f = main[k] / low
            main[k], up[k], up2[k], main[k + 1], next_up = low, main[k + 1], up[k + 1], up[k] - f * main[k + 1], up[k + 1]
            up[k + 1] = -f * next_up
            x[k], x[k + 1] = x[k + 1], x[k] - f * x[k + 1]
    if abs(main[-1]) < least:
        main[-1] = least
    for k in range(n - 1, -1, -1):
        if k + 1 < n:
            x[k] -= up[k] * x[k + 1]
        if k + 2 < n:
            x[k] -= up2[k] * x[k + 2]
        x[k] /= main[k]
    return x


def vectors(diagonal: np.ndarray, side: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix for its leading eigenvalues, as columns.

    A value starts a cluster unless it lies near the one before it. Within a cluster the
    start of each iteration differs, shifts are kept apart by rounding error, and every
    iterate is made orthogonal to the vectors already found.
    """
    n, found = len(diagonal), np.zeros((len(diagonal), len(values)))
    norm = max(np.max(np.abs(diagonal)), np.max(np.abs(side), initial=0.0), 1e-300)
    draw, first, shift = np.random.default_rng(1), 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > _CLUSTER * norm:
            first = j
        shift = min(value, shift - 10 * _EPS * norm) if j > first else value
        x = draw.uniform(0.5, 1.0, n) * draw.choice([-1.0, 1.0], n)
        kept = found[:, first:j]
        for _ in range(6):
            for _ in range(2):
                x -= kept @ (kept.T @ x)
            x /= np.linalg.norm(x)
            x = _solve(diagonal, side, shift, x, _EPS * norm)
            x /= np.linalg.norm(x)
        for _ in range(2):
            x -= kept @ (kept.T @ x)
        found[:, j] = x / np.linalg.norm(x)
    return found


def leading(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    scale = np.max(np.abs(matrix))
    diagonal, side, reflections = tridiagonal(matrix / scale)
    values = leading_values(diagonal, side, min(most, len(matrix)))
    made = vectors(diagonal, side, values)
    for begin, v in reversed(reflections):
        made[begin:] -= 2 * np.outer(v, v @ made[begin:])
    return values * scale, made


# --- Passes over the vectors --------------------------------------------------
def _usable(vectors_: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have a usable vector, and those vectors as a matrix."""
    lengths = pc.fill_null(pc.list_value_length(vectors_), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == dims)
    flat = vectors_.take(pa.array(rows)).flatten().cast(pa.float64(), safe=False)
    values = flat.to_numpy(zero_copy_only=False).reshape(len(rows), dims)  # nulls are NaN
    with np.errstate(invalid="ignore"):
        good = np.all(np.abs(values) < _FURTHEST, axis=1)
    return rows[good], values[good]


def _integers(values: np.ndarray, scale: int, shift: int) -> np.ndarray:
    return np.floor(values * scale).astype(np.int64) + shift


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """x - S / n: the whole part is taken off as integers, so no digit is lost."""
    whole = np.array([s // n for s in sums], np.int64)
    part = np.array([(s % n) / n for s in sums])
    return (x - whole) - part


def _summed(tasks: DataFrame, dims: int) -> np.ndarray:
    """The sum of matrices, given as their rows (i, values) for each task: summed by row and column in Spark."""
    cells = tasks.select("i", F.posexplode("values").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    total = np.zeros((dims, dims))
    for batch in cells.toArrow().to_batches():
        i, j, v = (batch.column(k).to_numpy() for k in range(3))
        total[i, j] = v
    return total


def _products(rows: DataFrame, matrix_of, dims: int) -> DataFrame:
    """For each task the rows of the sum of products of what `matrix_of` makes of its batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            y = matrix_of(batch)
            total += y.T @ y
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(dims, dtype=np.int32)), "values": pa.array(list(total), pa.list_(pa.float64()))})
    return rows.mapInArrow(run, "i int, values array<double>")


def dimensions(rows: DataFrame, vector_col: str) -> int:
    """The most frequent length of a vector; of equally frequent ones the larger."""
    counted = rows.where(F.size(vector_col) > 0).groupBy(F.size(vector_col).alias("dims")).count()
    first = counted.orderBy(F.desc("count"), F.desc("dims")).first()
    return first["dims"] if first else 0


def fit(rows: DataFrame, vector_col: str = "embedding", most: int = 32, scale: int = 64, shift: int = 1_000_000) -> Whitening | None:
    """Sums, covariance and leading components of all usable vectors; None where there is nothing to whiten."""
    rows = rows.select(F.col(vector_col).alias("vector"))
    dims = dimensions(rows, "vector")
    if not dims:
        return None

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, values = _usable(batch.column("vector"), dims)
            x = _integers(values, scale, shift)
            # halves of 32 bits, whose sums over a batch fit
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            yield pa.RecordBatch.from_pydict({
                "n": pa.array(np.full(dims, len(kept))), "i": pa.array(np.arange(dims, dtype=np.int32)), "high": pa.array(high), "low": pa.array(low)})

    whole = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    sums = rows.mapInArrow(add, "n long, i int, high long, low long").groupBy("i").agg(F.sum("n").alias("n"), *whole).collect()
    n = sums[0]["n"] if sums else 0
    if not n:
        return None
    totals = tuple((int(r["high"]) << 32) + int(r["low"]) for r in sorted(sums, key=lambda r: r["i"]))

    def centred(batch: pa.RecordBatch) -> np.ndarray:
        return _centred(_integers(_usable(batch.column("vector"), dims)[1], scale, shift), n, totals)

    covariance = _summed(_products(rows, centred, dims), dims) / n
    covariance = (covariance + covariance.T) / 2
    if not covariance.any():
        return None
    values, components = leading(covariance, min(most, dims))
    real = values > max(dims, 8) * 8 * _EPS * values[0]
    return Whitening(n, totals, covariance, values[real], components[:, real])


def _deviation(x: np.ndarray, n: int, sums: tuple[int, ...]) -> pa.Array:
    """The sum over dimensions of (n * x - S)^2, exact; null beyond 64 bits."""
    whole = np.array([s // n for s in sums], np.int64)
    part = np.array([s % n for s in sums], object)
    off = x - whole
    largest = (float(np.abs(off).max(initial=0)) + 1.0) * n
    if largest * largest * len(sums) < 2.0 ** 62:
        scaled = off * n - part.astype(np.int64)
        return pa.array((scaled * scaled).sum(axis=1), pa.int64())
    scaled = off.astype(object) * n - part
    exact = (scaled * scaled).sum(axis=1)
    return pa.array([int(v) if v < 1 << 63 else None for v in exact], pa.int64())


def transform(rows: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding",
              scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """One row a usable vector: id, deviation, and its whitened coordinates, one a component."""
    n, sums, dims = model.n, model.sums, len(model.sums)
    projection = model.components / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, values = _usable(batch.column("vector"), dims)
            if not len(kept):
                continue
            x = _integers(values, scale, shift)
            made = _centred(x, n, sums) @ projection
            ends = np.arange(len(kept) + 1, dtype=np.int32) * made.shape[1]
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id").take(pa.array(kept)), "deviation": _deviation(x, n, sums),
                "whitened": pa.ListArray.from_arrays(pa.array(ends), pa.array(made.ravel()))})

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).mapInArrow(
        run, f"id {kind}, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, model: Whitening) -> float:
    """The largest entry by amount of the covariance of whitened rows minus the identity, measured over all of them."""
    k = len(model.values)

    def with_one(batch: pa.RecordBatch) -> np.ndarray:
        made = batch.column("whitened").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
        return np.hstack([made, np.ones((len(made), 1))])

    total = _summed(_products(whitened.select("whitened"), with_one, k + 1), k + 1) / model.n
    mean = total[k, :k]
    return float(np.max(np.abs(total[:k, :k] - np.outer(mean, mean) - np.eye(k))))


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 32,
           scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """One row a usable vector and component: id, component, n, deviation, whitened, explained, identity_error."""
    schema = f"id {rows.schema[id_col].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit(rows, vector_col, most, scale, shift)
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    made = written(transform(rows, model, id_col, vector_col, scale, shift), "whitened")
    error = identity_error(made, model)
    share = F.array(*[F.lit(float(e)) for e in model.explained])
    return made.select("id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        share[F.col("place")].alias("explained"), F.lit(error).alias("identity_error"))
