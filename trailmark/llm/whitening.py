"""Whitening of vectors by Jacobi-Davidson, without ever forming the covariance.

Entries become integers ``floor(scale * c)``, and the covariance is taken over the distinct integer vectors.  Its leading eigenvectors
come from a block Jacobi-Davidson iteration on the driver, which holds a few vectors of the embedding's width and nothing that
grows with the rows.  All it asks of the cluster is the product of the covariance with a block of vectors:

    V B = 1/n * sum over rows of (x - mean) ((x - mean)' B)

Each task centres its rows, multiplies, and returns sums of the block's size.  One such pass serves all wanted pairs at once:

* Rayleigh-Ritz in the subspace gives approximate pairs and their residuals;
* a pair whose residual has reached double precision is locked;
* for each other wanted pair the correction equation, projected against the locked and the pair's own vector, is solved roughly
  by a few steps of MINRES, the pairs in step with each other;
* the corrections, made orthogonal, widen the subspace, which is cut back to its best vectors when it is full.

Before the result stands, a random direction and its images under a few powers of the covariance are taken in, so that a
pair that the start had missed would show and be refined like the others.

Defined cases: a row whose vector is null or holds a null or non-finite entry is dropped; a shorter vector counts as
ending in zeros, an empty one as all zeros; repeated rows each get their values; equal eigenvalues give any basis of their space, the
same for all rows; a component whose eigenvalue is zero within rounding (fewer distinct vectors or dimensions than components) is left
out, so a table with fewer than two distinct vectors, or none, gives no rows; ``deviation`` is null where it exceeds a long; other columns
are not returned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.config import work_table

SEED = 20_240_511
INNER = 6  # steps of MINRES per correction
WIDTH = 32  # vectors in the subspace before it is cut back
ROUNDS = 200
ENTRIES = 1 << 18  # of a matrix a task holds at a time
PROBES = 4  # powers of the covariance that the random direction is taken through
TOLERANCE = 64 * np.finfo(float).eps  # of a residual, relative to the largest eigenvalue and the root of the width

Multiply = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Whitening:
    """Eigenvectors (columns), eigenvalues, the exact sums, the number of distinct vectors, and what was measured."""

    vectors: np.ndarray
    values: np.ndarray
    sums: list[int]
    count: int
    trace: float
    identity_error: float
    scale: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.count for s in self.sums])


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    bad = lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf"))
    return vector.isNotNull() & ~F.coalesce(F.exists(vector, bad), F.lit(False))


def integers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as an integer matrix, short ones ending in zeros."""
    lengths = np.asarray(pc.list_value_length(column))
    flat = np.asarray(column.flatten())
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _parts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a matrix of doubles stays at a few megabytes, however wide."""
    rows = max(1, ENTRIES // width)
    for whole in batches:
        for start in range(0, whole.num_rows, rows):
            yield whole.slice(start, rows)


def _sums(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """A task's exact sums by dimension."""
    total = [0] * width
    for batch in _parts(batches, width):
        x = _matrix(batch.column(0), width)
        # Halves of the numbers add up without overflow.
        high, low = (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)
        total = [t + (int(a) << 32) + int(b) for t, a, b in zip(total, high, low)]
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(width), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], names=["dim", "total"])


def _products(batches: Iterator[pa.RecordBatch], mean: np.ndarray, block: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's share of the covariance times a block, and of the sum of squares by dimension."""
    total = np.zeros((len(mean), block.shape[1] + 1))
    for batch in _parts(batches, len(mean)):
        x = _matrix(batch.column(0), len(mean)) - mean
        total[:, :-1] += x.T @ (x @ block)
        total[:, -1] += (x * x).sum(0)
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(len(mean)), pa.int32()), *[pa.array(c) for c in total.T]], names=["dim", *[f"s{i}" for i in range(total.shape[1])]])


def _spread(batches: Iterator[pa.RecordBatch], mean: np.ndarray, axes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's share of the covariance of what is whitened."""
    total = np.zeros((axes.shape[1], axes.shape[1]))
    for batch in _parts(batches, len(mean)):
        w = (_matrix(batch.column(0), len(mean)) - mean) @ axes
        total += w.T @ w
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(len(total)), pa.int32()), *[pa.array(c) for c in total.T]], names=["dim", *[f"s{i}" for i in range(len(total))]])


def _gathered(parts: DataFrame, width: int) -> np.ndarray:
    """Sums over all tasks, by dimension; no more rows reach the driver than there are dimensions."""
    names = [c for c in parts.columns if c != "dim"]
    out = np.zeros((width, len(names)))
    for row in parts.groupBy("dim").agg(*[F.sum(c).alias(c) for c in names]).collect():
        out[row["dim"]] = row[1:]
    return out


def covariance_times(fit: DataFrame, mean: np.ndarray, n: int) -> Multiply:
    """The covariance of ``fit`` as a function of a block of vectors; the last column returned holds the variances."""

    def multiply(block: np.ndarray) -> np.ndarray:
        schema = "dim int, " + ", ".join(f"s{i} double" for i in range(block.shape[1] + 1))
        return _gathered(fit.mapInArrow(lambda it: _products(it, mean, block), schema), len(mean)) / n

    return multiply


def _orthogonal(new: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Columns of ``new`` made orthonormal to ``basis`` and each other; what lies in their span is left out."""
    kept = basis
    for t in new.T:
        size = np.linalg.norm(t)
        for _ in range(3):
            t = t - kept @ (kept.T @ t)
        left = np.linalg.norm(t)
        if size > 0 and left > 1e-10 * size:
            t = t / left
            t = t - kept @ (kept.T @ t)
            kept = np.column_stack([kept, t / np.linalg.norm(t)])
    return kept[:, basis.shape[1]:]


class _Minres:
    """MINRES for (P (A - shift) P) t = right, one step at a time so that several can share a pass; P removes ``out``."""

    def __init__(self, shift: float, right: np.ndarray, out: np.ndarray):
        self.shift, self.out = shift, out
        v = self._project(right)
        self.beta = np.linalg.norm(v)
        self.live = self.beta > 0
        self.v, self.before = (v / self.beta if self.live else v), np.zeros_like(v)
        self.solution, self.w, self.w_before = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
        self.rest, self.start, self.c, self.s, self.c_before, self.s_before, self.over = self.beta, self.beta, 1.0, 0.0, 1.0, 0.0, 0.0

    def _project(self, x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - self.out @ (self.out.T @ x)
        return x

    def step(self, image: np.ndarray) -> None:
        """``image`` is A times the current vector ``v``."""
        u = self._project(image - self.shift * self.v) - self.over * self.before
        alpha = self.v @ u
        u = u - alpha * self.v
        below = np.linalg.norm(u)
        # The new column of the tridiagonal matrix, turned by the last two rotations and by its own.
        far, near = self.s_before * self.over, self.c_before * self.over
        middle, corner = self.c * near + self.s * alpha, -self.s * near + self.c * alpha
        size = np.hypot(corner, below)
        if size <= np.finfo(float).tiny:
            self.live = False
            return
        self.c_before, self.s_before, self.c, self.s = self.c, self.s, corner / size, below / size
        w = (self.v - far * self.w_before - middle * self.w) / size
        self.w_before, self.w = self.w, w
        self.solution = self.solution + self.c * self.rest * w
        self.rest *= -self.s
        self.over, self.before = below, self.v
        # Krylov space used up, or solved well enough for a step outwards.
        if below <= 1e-14 * self.start or abs(self.rest) <= 1e-4 * self.start:
            self.live = False
        else:
            self.v = u / below


def _corrections(multiply: Multiply, pairs: list[tuple[float, np.ndarray, np.ndarray]], locked: np.ndarray, steps: int) -> np.ndarray:
    """Rough solutions of the projected correction equations of several (value, vector, residual), in step."""
    solvers = [_Minres(value, -residual, np.column_stack([locked, vector])) for value, vector, residual in pairs]
    for _ in range(steps):
        live = [s for s in solvers if s.live]
        if not live:
            break
        images = multiply(np.column_stack([s.v for s in live]))
        for i, s in enumerate(live):
            s.step(images[:, i])
    return np.column_stack([s.solution for s in solvers])


def leading_pairs(multiply: Multiply, width: int, wanted: int, rng: np.random.Generator | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors of a symmetric, positive semidefinite operator on ``width`` dimensions.

    ``multiply`` may return further columns, which are ignored.  Pairs with a value of zero within rounding are left out.
    """
    rng = rng or np.random.default_rng(SEED)
    wanted = min(wanted, width)
    basis = _orthogonal(rng.standard_normal((width, min(width, wanted + 2))), np.zeros((width, 0)))
    image = multiply(basis)[:, :basis.shape[1]]
    probes, stalled, best = 0, 0, np.inf
    for _ in range(ROUNDS):
        inner = basis.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        vectors, images = basis @ turn, image @ turn
        residuals = images[:, :wanted] - vectors[:, :wanted] * values[:wanted]
        sizes = np.linalg.norm(residuals, axis=0)
        bound = TOLERANCE * max(values[0], 0.0) * np.sqrt(width)
        done = sizes <= bound
        # Rounding can hold a residual a little above the bound: give up on it once it has stopped falling.
        stalled = 0 if sizes.max() < 0.5 * best else stalled + 1
        best = min(best, sizes.max())
        close = sizes <= 100 * bound
        if basis.shape[1] == width or done.all() or (stalled > 8 and close.all()):
            if basis.shape[1] == width or probes >= PROBES:
                break
            # What the start may have missed shows in the powers of the covariance times a random direction.
            new = image[:, -1:] if probes else rng.standard_normal((width, 1))
            probes += 1
        else:
            open_pairs = [(values[i], vectors[:, i], residuals[:, i]) for i in np.flatnonzero(~done)]
            new = _corrections(multiply, open_pairs, vectors[:, :wanted][:, done], INNER)
        if basis.shape[1] + new.shape[1] > max(WIDTH, 3 * wanted):
            keep = 2 * wanted + 2
            basis, image = vectors[:, :keep], images[:, :keep]
            new = new - basis @ (basis.T @ new)
        fresh = _orthogonal(new, basis)
        if not fresh.shape[1]:
            fresh = _orthogonal(rng.standard_normal((width, 1)), basis)
        basis = np.column_stack([basis, fresh])
        image = np.column_stack([image, multiply(fresh)[:, :fresh.shape[1]]])
    else:
        raise ArithmeticError("the eigenvectors have not converged")
    positive = values[:wanted] > max(values[0], 0.0) * width * np.finfo(float).eps
    return values[:wanted][positive], vectors[:, :wanted][:, positive]


def fit_whitening(vectors: DataFrame, vector: str, components: int, scale: int) -> Whitening | None:
    """Learn from the distinct integer vectors of all usable rows; nothing where there is no spread."""
    x = vectors.select(F.col(vector).alias("v")).filter(usable(F.col("v")))
    width = x.agg(F.max(F.size("v"))).first()[0] or 0
    if not width:
        return None
    # Zeros at the end do not tell vectors apart.
    padded = F.concat(integers(F.col("v"), scale), F.array_repeat(F.lit(0).cast("long"), width - F.size("v")))
    fit = work_table(x.select(padded.alias("x")).distinct(), "whitening-fit")
    n = fit.count()
    if n < 2:
        return None
    sums = [0] * width
    for row in fit.mapInArrow(lambda it: _sums(it, width), "dim int, total decimal(38,0)").groupBy("dim").agg(F.sum("total")).collect():
        sums[row[0]] = int(row[1])
    mean = np.array([s / n for s in sums])
    multiply = covariance_times(fit, mean, n)
    trace = float(multiply(np.zeros((width, 1)))[:, -1].sum())
    if not trace > 0:
        return None
    values, axes = leading_pairs(multiply, width, components)
    scaled = axes / np.sqrt(values)
    schema = "dim int, " + ", ".join(f"s{i} double" for i in range(len(values)))
    spread = _gathered(fit.mapInArrow(lambda it: _spread(it, mean, scaled), schema), len(values)) / n
    error = float(np.abs(spread - np.eye(len(values))).max())
    return Whitening(axes, values, sums, n, trace, error, scale)


def _deviation(x: np.ndarray, sums: list[int], n: int) -> list[int | None]:
    """Sum of (n * x - S)^2, exact; nothing where it exceeds a long."""
    if x.size and float(np.abs(x).max()) * n + max(map(abs, sums)) < (2.0**62 / x.shape[1]) ** 0.5:
        d = n * x - np.array(sums, np.int64)
        return (d * d).sum(1).tolist()
    exact = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    return [e if e < 1 << 63 else None for e in exact]


def _apply(batches: Iterator[pa.RecordBatch], key: str, w: dict) -> Iterator[pa.RecordBatch]:
    mean, axes = w["mean"], w["axes"]
    m = axes.shape[1]
    for batch in _parts(batches, len(mean)):
        x = _matrix(batch.column(1), len(mean))
        # One row at a time in the same order of additions, whatever shares its batch: equal vectors get equal values.
        centred = x - mean
        white = np.stack([(centred * a).sum(1) for a in axes.T], 1)
        deviation = pa.array(_deviation(x, w["sums"], w["n"]), pa.int64())
        row = pa.array(np.repeat(np.arange(len(x)), m))
        rows = len(x) * m
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(row), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(x))),
             pa.array(np.full(rows, w["n"], np.int64)), deviation.take(row), pa.array(white.reshape(-1)),
             pa.array(np.tile(w["explained"], len(x))), pa.array(np.full(rows, w["error"]))],
            names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
        )


def whiten(vectors: DataFrame, fitted: Whitening | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row for each usable row and component; the fitted values travel as plain arrays of the vectors' width."""
    kind = vectors.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], schema)
    plain = {
        "mean": fitted.mean, "axes": fitted.vectors / np.sqrt(fitted.values), "sums": fitted.sums, "n": fitted.count,
        "explained": fitted.values / fitted.trace, "error": fitted.identity_error,
    }
    rows = vectors.select(F.col(key), F.col(vector).alias("whitened_v")).filter(usable(F.col("whitened_v")))
    rows = rows.select(F.col(key), integers(F.col("whitened_v"), fitted.scale).alias("whitened_x"))
    return rows.mapInArrow(lambda it: _apply(it, key, plain), schema)


def op12_query(embeddings: DataFrame) -> DataFrame:
    """Four components of all embeddings, by the integer vectors of the contract."""
    return whiten(embeddings, fit_whitening(embeddings, "embedding", 4, 256))
