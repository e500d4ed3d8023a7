"""Whitening by contour integration over the spectrum of a covariance.

Entries become integers, so sums and cross products of the fit list (each distinct vector once) are
exact: they are centred by the rounded mean before they are multiplied, added as integers, and the
rest of the mean is taken out in integers too. The covariance is small (dimensions squared) and the
only thing that reaches the driver.

Its leading eigenvectors come from FEAST. Inertia counts (signs of the pivots of a symmetric
factorisation) cut the upper end of the spectrum into intervals of few eigenvalues. On each, a
quadrature of solves with the covariance shifted by points of a circle around the interval filters
a block of vectors, and Rayleigh-Ritz in that block gives the pairs; they must be as many as the
inertia counts say, or the block grows and the interval is done again.

Defined cases: rows whose vector is null or empty, or holds null or non-finite entries, are dropped,
and so are vectors of another length than most (of two as common, the longer length is kept). Entries
saturate at 2^61. Directions without variance (an eigenvalue not above the
rounding of the largest) have no component, so a single distinct vector gives no rows, as does an
empty table. A deviation beyond a 64-bit integer is null. Repeated rows and null ids stay; other
columns are not looked at. Components of equal eigenvalues are any orthonormal base of their space.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lodegate.llm.context import materialize, prepare

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
PER_INTERVAL = 8
NODES = 16
_EXACT = 1 << 53  # integers up to this are exact in a double
_LARGEST = float(1 << 61)


# --- Eigenvalues on an interval ---------------------------------------------------------------


def above(matrix: np.ndarray, point: float) -> int:
    """How many eigenvalues of a symmetric matrix lie above ``point``: positive pivots of its factorisation.

    Each step eliminates the largest diagonal entry, or a pair of rows where an entry beside the
    diagonal is much larger; a pair has one eigenvalue of each sign.
    """
    a = matrix - point * np.eye(len(matrix))
    floor = np.finfo(float).tiny
    positive = 0
    while len(a):
        k = int(np.argmax(np.abs(np.diag(a))))
        beside = np.abs(a - np.diag(np.diag(a)))
        i, j = np.unravel_index(int(np.argmax(beside)), beside.shape)
        if abs(a[k, k]) >= 0.64 * beside[i, j]:
            positive += a[k, k] > 0
            rest = np.delete(np.arange(len(a)), k)
            if abs(a[k, k]) > floor:
                a = a[np.ix_(rest, rest)] - np.outer(a[rest, k], a[rest, k]) / a[k, k]
            else:
                a = a[np.ix_(rest, rest)]
        else:
            positive += 1
            rest, pair = np.delete(np.arange(len(a)), [i, j]), [i, j]
            sides = a[np.ix_(rest, pair)]
            a = a[np.ix_(rest, rest)] - sides @ np.linalg.solve(a[np.ix_(pair, pair)], sides.T)
    return positive


def _filtered(matrix: np.ndarray, low: float, high: float, block: np.ndarray, nodes: int) -> np.ndarray:
    """The block projected onto the eigenvectors of (low, high), up to the error of the quadrature.

    The contour integral of the resolvent over a circle, by Gauss-Legendre points of its upper half;
    the lower half gives the conjugates.
    """
    centre, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(nodes)
    projected = np.zeros_like(block)
    for angle, weight in zip((points + 1) * np.pi / 2, weights):
        step = radius * np.exp(1j * angle)
        solved = np.linalg.solve((centre + step) * np.eye(len(matrix)) - matrix, block.astype(complex))
        projected += weight / 2 * (step * solved).real
    return projected


def pairs_within(matrix: np.ndarray, low: float, high: float, count: int, nodes: int = NODES) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues in (low, high), rising, and their eigenvectors as columns."""
    size = len(matrix)
    scale = np.abs(matrix).max() * size
    width = min(size, 2 * count + 4)
    while True:
        block = np.random.default_rng(count).standard_normal((size, width))
        for _ in range(12):
            base, _ = np.linalg.qr(_filtered(matrix, low, high, block, nodes))
            values, inner = np.linalg.eigh(base.T @ matrix @ base)
            vectors = base @ inner
            wanted = (values > low) & (values < high)
            misses = np.linalg.norm(matrix @ vectors[:, wanted] - vectors[:, wanted] * values[wanted], axis=0)
            if wanted.sum() == count and (misses <= 64 * np.finfo(float).eps * scale).all():
                return values[wanted], vectors[:, wanted]
            block = vectors
        if width == size:
            raise ArithmeticError(f"{wanted.sum()} eigenvalues found in ({low}, {high}), {count} by inertia")
        width = min(size, 2 * width)


def intervals(matrix: np.ndarray, wanted: int, per_interval: int = PER_INTERVAL) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues) that hold at least the ``wanted`` largest, from the highest down.

    An interval is halved while it holds more than ``per_interval``, unless it is as narrow as rounding.
    """
    size = len(matrix)
    radius = float(np.abs(matrix).sum(axis=1).max()) or 1.0
    least = 1e-11 * radius
    done, open_ = [], [(-1.01 * radius, 1.01 * radius, size, 0)]
    found = 0
    while open_ and found < wanted:
        low, high, of_low, of_high = open_.pop()
        if of_low == of_high:
            continue
        if of_low - of_high <= per_interval or high - low <= least:
            done.append((low, high, of_low - of_high))
            found += of_low - of_high
            continue
        middle = (low + high) / 2
        at = above(matrix, middle)
        open_ += [(low, middle, of_low, at), (middle, high, at, of_high)]
    return done


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and their eigenvectors as columns."""
    wanted = min(wanted, len(matrix))
    if not wanted:
        return np.zeros(0), np.zeros((len(matrix), 0))
    parts = [pairs_within(matrix, low, high, count)[1] for low, high, count in intervals(matrix, wanted)]
    # Intervals that meet between close eigenvalues share rounding; one more projection over all of them settles it.
    base, _ = np.linalg.qr(np.concatenate(parts, axis=1))
    values, inner = np.linalg.eigh(base.T @ matrix @ base)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], (base @ inner)[:, order]


# --- Exact sums over the table -----------------------------------------------------------------


def _vectors(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Integer vectors of the usable rows, and which rows those are."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy(zero_copy_only=False))
    usable = column.is_valid().to_numpy(zero_copy_only=False) & (sizes == dims)
    rows = np.flatnonzero(usable)
    if not rows.size:
        return np.zeros((0, dims), np.int64), rows
    starts = column.offsets.to_numpy(zero_copy_only=False)[rows]
    entries = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become nan
    picked = entries[starts[:, None] + np.arange(dims)]
    finite = np.isfinite(picked).all(axis=1)
    scaled = np.floor(picked[finite] * SCALE) + SHIFT
    return np.clip(scaled, -_LARGEST, _LARGEST).astype(np.int64), rows[finite]


def _packed(dims: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, _ = _vectors(batch.column(0), dims)
            yield pa.RecordBatch.from_arrays([pa.array([row.tobytes() for row in whole], pa.binary())], names=["vector"])

    return run


def _unpacked(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.int64).reshape(-1, dims)


def _entry_sums(dims: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Number of vectors (at -1) and sum of each entry, exact, as decimals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = 0, [0] * dims
        for batch in batches:
            whole = _unpacked(batch.column(0), dims)
            count += len(whole)
            high, low = whole >> 32, whole & 0xFFFFFFFF
            sums = [s + (int(h) << 32) + int(l) for s, h, l in zip(sums, high.sum(axis=0), low.sum(axis=0))]
        yield _long_sums([-1, *range(dims)], [count, *sums])

    return run


def _long_sums(at: list[int], values: list[int]) -> pa.RecordBatch:
    """Whole numbers of any size as (place, digit of 2^48, value), so that sums of values stay in 64 bits."""
    places, powers, digits = [], [], []
    for place, value in zip(at, values):
        power = 0
        while value:
            value, digit = divmod(value, 1 << 48)
            if value == -1:
                value, digit = 0, digit - (1 << 48)
            places.append(place), powers.append(power), digits.append(digit)
            power += 1
    return pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(powers, pa.int32()), pa.array(digits, pa.int64())], names=["place", "power", "digit"])


def _added(parts: DataFrame) -> dict[int, int]:
    out: dict[int, int] = {}
    for row in parts.groupBy("place", "power").agg(F.sum(F.col("digit").cast("decimal(38,0)")).alias("digit")).collect():
        out[row["place"]] = out.get(row["place"], 0) + (int(row["digit"]) << (48 * row["power"]))
    return out


def exact_products(x: np.ndarray) -> list[list[int]]:
    """x.T @ x of integers, exact: by doubles where they suffice, else by limbs of them."""
    size = int(np.abs(x).max(initial=0))
    dims = x.shape[1]
    if len(x) * size * size < _EXACT:
        return [[int(v) for v in row] for row in x.astype(float).T @ x.astype(float)]
    step = 1 << 20
    out = [[0] * dims for _ in range(dims)]
    limbs, rest = [], x.copy()
    while (rest != 0).any():
        limbs.append(((rest + step // 2) % step) - step // 2)
        rest = (rest - limbs[-1]) // step
    for p, a in enumerate(limbs):
        for q, b in enumerate(limbs):
            for low in range(0, len(x), 1 << 14):  # 2^14 products of 2^38 at most
                part = a[low : low + (1 << 14)].astype(float).T @ b[low : low + (1 << 14)].astype(float)
                for i in range(dims):
                    for j in range(dims):
                        out[i][j] += int(part[i, j]) << (20 * (p + q))
    return out


def _product_sums(dims: int, centre: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [[0] * dims for _ in range(dims)]
        for batch in batches:
            x = _unpacked(batch.column(0), dims)
            if len(x):
                x = x - np.array(centre, dtype=np.int64)
                total = [[s + v for s, v in zip(sums, new)] for sums, new in zip(total, exact_products(x))]
        yield _long_sums([i * dims + j for i in range(dims) for j in range(i, dims)], [total[i][j] for i in range(dims) for j in range(i, dims)])

    return run


# --- Fit and transform -------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # as columns
    explained: np.ndarray
    error: float = 0.0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self._off_mean(x) @ self.vectors / np.sqrt(self.values)

    def _off_mean(self, x: np.ndarray) -> np.ndarray:
        whole = [divmod(s, self.n) for s in self.sums]
        near = x - np.array([q for q, _ in whole], dtype=np.int64)
        return near.astype(float) - np.array([r / self.n for _, r in whole])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over the entries of (n x - sum)^2; exact."""
        small = max(int(np.abs(x).max(initial=0)) * self.n, max(map(abs, self.sums), default=0))
        off = [self.n * int(v) - s for row in x for v, s in zip(row, self.sums)] if small >= 1 << 61 else None
        if off is None:
            wide = x * self.n - np.array(self.sums, dtype=np.int64)
            if len(self.sums) * float(np.abs(wide).max(initial=0)) ** 2 < float(1 << 62):
                return (wide * wide).sum(axis=1).tolist()
            off = wide.reshape(-1).tolist()
        dims = len(self.sums)
        sums = [sum(v * v for v in off[k : k + dims]) for k in range(0, len(off), dims)]
        return [s if s < 1 << 63 else None for s in sums]


def common_length(rows: DataFrame, column: str) -> int:
    """The length that most vectors have; of equally common ones the longest. 0 without vectors."""
    lengths = rows.select(F.size(column).alias("size")).filter("size > 0").groupBy("size").count()
    first = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    return first["size"] if first else 0


def covariance(distinct: DataFrame, dims: int) -> tuple[int, list[int], np.ndarray, float]:
    """Number of vectors, exact sums, covariance with divisor n, and its trace."""
    sums = _added(distinct.mapInArrow(_entry_sums(dims), "place int, power int, digit long"))
    n = sums.get(-1, 0)
    if not n:
        return 0, [], np.zeros((0, 0)), 0.0
    sums = [sums.get(k, 0) for k in range(dims)]
    centre = [round(Fraction(s, n)) for s in sums]
    products = _added(distinct.mapInArrow(_product_sums(dims, centre), "place int, power int, digit long"))
    rest = [s - n * c for s, c in zip(sums, centre)]
    exact = {(i, j): Fraction(n * products.get(i * dims + j, 0) - rest[i] * rest[j], n * n) for i in range(dims) for j in range(i, dims)}
    matrix = np.array([[float(exact[min(i, j), max(i, j)]) for j in range(dims)] for i in range(dims)])
    return n, sums, matrix, float(sum(exact[i, i] for i in range(dims)))


def _moments(fitted: Whitening) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums of the whitened entries (row -1) and of their products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(fitted.values)
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = fitted.whitened(_unpacked(batch.column(0), len(fitted.sums)))
            total[0] += w.sum(axis=0)
            total[1:] += w.T @ w
        place = np.arange(total.size)
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(total.reshape(-1), pa.float64())], names=["place", "value"])

    return run


def fit(rows: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a table's vectors, None where no direction has variance."""
    vectors = rows.select(F.col(f"`{column}`").cast("array<double>").alias("embedding"))
    dims = common_length(vectors, "embedding")
    if not dims:
        return None
    distinct = materialize(vectors.mapInArrow(_packed(dims), "vector binary").distinct(), "fit-list")
    n, sums, matrix, trace = covariance(distinct, dims)
    if not n or trace <= 0:
        return None
    values, directions = leading(matrix, components)
    kept = values > len(matrix) * np.finfo(float).eps * values[0]
    values, directions = values[kept], directions[:, kept]
    fitted = Whitening(n, sums, values, directions, values / trace)
    k = len(values)
    sums_ = distinct.mapInArrow(_moments(fitted), "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    total = np.zeros((k + 1) * k)
    for row in sums_:
        total[row["place"]] = row["value"]
    mean, products = total[:k] / n, total[k:].reshape(k, k) / n
    error = float(np.abs(products - np.outer(mean, mean) - np.eye(k)).max())
    return Whitening(n, sums, values, directions, values / trace, error)


def _applied(fitted: Whitening) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(fitted.values)
        for batch in batches:
            x, rows = _vectors(batch.column(1), len(fitted.sums))
            ids = batch.column(0).take(pa.array(np.repeat(rows, k)))
            many = len(rows) * k
            columns = [
                ids, pa.array(np.tile(np.arange(1, k + 1), len(rows)), pa.int32()), pa.array(np.full(many, fitted.n), pa.int64()),
                pa.array(fitted.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), k))),
                pa.array(fitted.whitened(x).reshape(-1), pa.float64()), pa.array(np.tile(fitted.explained, len(rows)), pa.float64()),
                pa.array(np.full(many, fitted.error), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


_SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector of ``rows`` (vec_id, embedding) and each component."""
    spark = prepare(rows.sparkSession)
    fitted = fit(rows, "embedding", components)
    if fitted is None:
        return spark.createDataFrame([], _SCHEMA)
    given = rows.select(F.col("`vec_id`").cast("long").alias("vec_id"), F.col("`embedding`").cast("array<double>").alias("embedding"))
    return given.mapInArrow(_applied(fitted), _SCHEMA)
