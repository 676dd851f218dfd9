"""Embedding whitening by spectrum slicing.

An entry ``c`` of a vector becomes the whole number ``x = floor(1024 * c) + 100000``. Vectors are
projected on the leading eigenvectors of the covariance of all ``x`` and divided by the root of
the eigenvalue, so that the projections have unit covariance.

Method. The inertia of ``V - s I``, read off a pivoted LDL' factorisation, counts the eigenvalues above ``s``.
Halving by such counts isolates each leading eigenvalue; inverse iteration and then Rayleigh quotient
iteration, which converges cubically, find its vector; and counts on both sides of the value certify
that it is the one of its number. Nothing else solves the eigenproblem.

Spark sums vectors, products of centred entries and products of whitened ones over all rows. Tasks hand on one
partial sum each. The driver sees the covariance matrix, whose size is the square of the dimension and
does not grow with the rows; the components, a few vectors, travel to the tasks.

Edge cases: rows whose vector is null, empty, or has a null or non-finite entry are dropped; the dimension
is the commonest length of the others (of equally common ones the smallest), and vectors of another length
are dropped as well. ``1024 * c`` is kept within 2 ** 45. Repeated rows and null ids count and are returned, each row
by itself; an empty table gives an empty result; only the id and the vector are read. Eigenvalues that are zero
to double precision have no component: equal vectors, or a single one, give an empty result. Equal eigenvalues get any
orthonormal vectors of their space. A ``deviation`` beyond 64 bits is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwatch.llm.registered import query, table

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
_WIDEST = float(1 << 45)
_EPS = float(np.finfo(float).eps)
_PIVOT = (1 + 17 ** 0.5) / 8
_LONG = (1 << 63) - 1


def inertia(matrix: np.ndarray) -> tuple[int, int, int]:
    """Numbers of positive, negative and zero eigenvalues of a symmetric matrix.

    They are those of D in P'LDL'P, with pivots of one or two rows, each the largest that is left.
    """
    rest = np.array(matrix, float)
    positive = negative = 0
    while len(rest):
        size = np.abs(rest)
        i = int(np.argmax(np.diagonal(size)))
        r, s = np.unravel_index(int(np.argmax(size)), size.shape)
        if size[r, s] == 0.0:
            break
        if size[i, i] >= _PIVOT * size[r, s]:
            at = [i]
            positive, negative = positive + (rest[i, i] > 0), negative + (rest[i, i] < 0)
        else:
            # The block's determinant is negative: one eigenvalue on each side.
            at = [int(r), int(s)]
            positive, negative = positive + 1, negative + 1
        others = np.delete(np.arange(len(rest)), at)
        below = rest[np.ix_(others, at)]
        rest = rest[np.ix_(others, others)] - below @ np.linalg.solve(rest[np.ix_(at, at)], below.T)
        rest = (rest + rest.T) / 2
    return int(positive), int(negative), len(matrix) - int(positive) - int(negative)


class Slicer:
    """Counts of eigenvalues above a shift, each taken once."""

    def __init__(self, matrix: np.ndarray) -> None:
        self.matrix = matrix
        self.reach = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
        self.slack = 8 * max(len(matrix), 4) * _EPS * self.reach
        self.counts = {self.reach + self.slack: 0, -self.reach - self.slack: len(matrix)}

    def above(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = inertia(self.matrix - shift * np.eye(len(self.matrix)))[0]
        return self.counts[shift]

    def bracket(self, number: int) -> tuple[float, float]:
        """The narrowest known interval that holds the eigenvalue of this number, counted from the largest."""
        low = max(s for s, n in self.counts.items() if n >= number)
        return low, min(s for s, n in self.counts.items() if n < number and s > low)

    def isolate(self, number: int) -> tuple[float, float]:
        """Halve until no other eigenvalue is in the interval, or nothing is left to halve."""
        while True:
            low, high = self.bracket(number)
            if high - low <= self.slack or (self.above(low) == number and self.above(high) == number - 1):
                return low, high
            self.above((low + high) / 2)

    def certified(self, number: int, value: float) -> bool:
        """Whether the eigenvalue of this number is ``value``, to the precision of the matrix."""
        return self.above(value - self.slack) >= number > self.above(value + self.slack)


def _solve(matrix: np.ndarray, shift: float, nudge: float, right: np.ndarray) -> np.ndarray:
    for extra in (0.0, nudge, 16 * nudge):
        try:
            found = np.linalg.solve(matrix - (shift + extra) * np.eye(len(matrix)), right)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(found).all() and np.linalg.norm(found) > 0:
            return found
    return right


def _apart(vector: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """The unit vector of the part that is orthogonal to the others."""
    for _ in range(2):
        for other in others:
            vector = vector - (other @ vector) * other
        vector = vector / np.linalg.norm(vector)
    return vector


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues that are above zero, falling, and their vectors as rows."""
    slicer, values, vectors = Slicer(matrix), [], []
    rounding = max(len(matrix), 4) * _EPS * slicer.reach
    random = np.random.default_rng(0)
    for number in range(1, min(k, len(matrix)) + 1):
        if not slicer.reach or slicer.above(len(matrix) * slicer.slack) < number:
            break
        for _ in range(200):
            low, high = slicer.isolate(number)
            middle = (low + high) / 2
            vector = _apart(random.normal(size=len(matrix)), vectors)
            for _ in range(3):
                vector = _apart(_solve(matrix, middle, rounding, vector), vectors)
            value = float(vector @ matrix @ vector)
            for _ in range(12):
                if np.linalg.norm(matrix @ vector - value * vector) <= rounding:
                    break
                vector = _apart(_solve(matrix, value, rounding, vector), vectors)
                value = float(vector @ matrix @ vector)
            if np.linalg.norm(matrix @ vector - value * vector) <= slicer.slack and slicer.certified(number, value):
                break
            slicer.above(middle)
        else:
            raise ArithmeticError(f"no certified eigenvalue {number}")
        values.append(value)
        vectors.append(vector * (1.0 if vector[np.argmax(np.abs(vector))] > 0 else -1.0))
    return np.array(values), np.array(vectors).reshape(len(values), len(matrix))


def whole_numbers(vectors: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: the rows of usable vectors, and their entries as whole numbers."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    vectors = vectors.cast(pa.large_list(pa.float64()))
    offsets = vectors.offsets.to_numpy()
    values = vectors.values
    flat = values.fill_null(float("nan")).to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    lengths = np.diff(offsets)
    usable = np.asarray(vectors.is_valid()) & (lengths > 0) & (bad[offsets[1:]] == bad[offsets[:-1]])
    found = {}
    for size in np.unique(lengths[usable]).tolist():
        rows = np.flatnonzero(usable & (lengths == size))
        entries = flat[offsets[rows][:, None] + np.arange(size)]
        found[size] = rows, np.floor(np.clip(entries * SCALE, -_WIDEST, _WIDEST)).astype(np.int64) + SHIFT
    return found


def _of_size(vectors: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    return whole_numbers(vectors).get(size, (np.zeros(0, np.int64), np.zeros((0, size), np.int64)))


@dataclass(frozen=True)
class Moments:
    """Number and exact sums of the fitted vectors."""

    n: int
    sums: tuple[int, ...]

    @property
    def size(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n``: the whole part of the mean is taken off exactly."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        part = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole).astype(float) - part

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over the dimensions of ``(n * x - S) ** 2``, exact."""
        widest = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums))
        kind = np.int64 if self.size * widest * widest <= _LONG else object
        apart = self.n * x.astype(kind) - np.array(self.sums, kind)
        return [int(d) if d <= _LONG else None for d in (apart * apart).sum(axis=1)]


@dataclass(frozen=True)
class Whitening:
    moments: Moments
    values: np.ndarray
    components: np.ndarray
    trace: float

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.moments.centred(x) @ (self.components / np.sqrt(self.values)[:, None]).T


def _only(vectors: DataFrame, vector_col: str) -> DataFrame:
    return vectors.select(F.col(vector_col).cast("array<double>").alias("vector"))


def moments(vectors: DataFrame, vector_col: str = "embedding") -> Moments:
    """Count and sums of the vectors of the commonest length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for size, (rows, x) in whole_numbers(batch.column(0)).items():
                n, before = totals.get(size, (0, 0))
                totals[size] = n + len(rows), before + x.sum(axis=0).astype(object)
        for size, (n, sums) in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * size, pa.int32()), pa.array(range(size), pa.int32()), pa.array([n] * size, pa.int64()),
                 pa.array([Decimal(int(s)) for s in sums], pa.decimal128(38, 0))], names=["size", "place", "n", "total"])

    sums = _only(vectors, vector_col).mapInArrow(run, "size int, place int, n long, total decimal(38,0)").groupBy("size", "place").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"))
    common = sums.filter("place = 0").orderBy(F.desc("n"), "size").first()
    if common is None:
        return Moments(0, ())
    found = sums.filter(F.col("size") == common["size"]).orderBy("place").collect()
    return Moments(common["n"], tuple(int(r["total"]) for r in found))


def _products(vectors: DataFrame, vector_col: str, size: int, width: int, made) -> np.ndarray:
    """The sum over all rows of the outer product of ``made(x)`` with itself, a ``width`` x ``width`` matrix."""
    i, j = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            y = made(_of_size(batch.column(0), size)[1])
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                                         names=["i", "j", "total"])

    cells = _only(vectors, vector_col).mapInArrow(run, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).toArrow()
    matrix = np.zeros((width, width))
    at = cells["i"].to_numpy(), cells["j"].to_numpy()
    matrix[at] = matrix[at[::-1]] = cells["total"].to_numpy()
    return matrix


def fit(vectors: DataFrame, k: int = COMPONENTS, vector_col: str = "embedding") -> Whitening:
    """The ``k`` leading components of all usable vectors."""
    found = moments(vectors, vector_col)
    if not found.n:
        return Whitening(found, np.zeros(0), np.zeros((0, 0)), 0.0)
    covariance = _products(vectors, vector_col, found.size, found.size, found.centred) / found.n
    return Whitening(found, *leading(covariance, k), float(np.trace(covariance)))


def identity_error(vectors: DataFrame, fitted: Whitening, vector_col: str = "embedding") -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, measured on all rows."""
    k = len(fitted.values)
    if not k:
        return 0.0
    # A last column of ones gives the sums; the rows are centred already, so these are rounding only.
    sums = _products(vectors, vector_col, fitted.moments.size, k + 1,
                     lambda x: np.column_stack([fitted.apply(x), np.ones(len(x))])) / fitted.moments.n
    return float(np.abs(sums[:k, :k] - np.outer(sums[:k, k], sums[:k, k]) - np.eye(k)).max())


def whiten(vectors: DataFrame, fitted: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, deviation, whitened``: the projections of every usable row of the fitted length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = _of_size(batch.column(1), fitted.moments.size)
            if len(rows):
                made = fitted.apply(x)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(fitted.moments.deviations(x), pa.int64()),
                     pa.array(list(made), pa.list_(pa.float64()))], names=["vec_id", "deviation", "whitened"])

    if not len(fitted.values):
        vectors = vectors.limit(0)
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).mapInArrow(
        run, "vec_id long, deviation long, whitened array<double>")


@query()
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable row's projection on each of the leading components."""
    vectors = table(spark, sf_dir, "embeddings")
    fitted = fit(vectors)
    explained = F.array(*(F.lit(float(v / fitted.trace)) for v in fitted.values)).cast("array<double>")
    rows = whiten(vectors, fitted).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return rows.select("vec_id", (F.col("place") + 1).alias("component"), F.lit(fitted.moments.n).cast("long").alias("n"), "deviation",
                       "whitened", F.get(explained, F.col("place")).alias("explained"),
                       F.lit(identity_error(vectors, fitted)).alias("identity_error"))
