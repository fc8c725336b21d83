"""Whitening of embeddings: covariances by polarisation, from exact sums of squares.

Components become integers x. The variance of every dimension and of the sum of every two dimensions
is aggregated as an exact sum of squared centred values; the covariance of two dimensions is half of
what the variance of their sum exceeds the sum of their variances by. The matrix is so exact up to the
last rounding, then ``eigh`` gives its eigenvectors, and every vector is projected on them and divided
by the root of the eigenvalue.

Centring comes before squaring. A mean S/n is a whole number m and a rest r/n. The tasks square u = x - m,
small integers, and as the sum of all u of a dimension is r, the sum of (n*x - S)^2 over all rows is
exactly n * (n * sum(u^2) - r^2). No number on the way is rounded.

What is gathered depends on the length of the vectors alone: each task sends d(d+1)/2 sums, which
Spark adds up by dimension pair, and the driver gets as many in all. The vectors are read once for
each of sums, squares, check and result; they are never stored again and never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from restframe.llm.base import query, table
from restframe.llm.vectors import usable_vectors

#: x = floor(SCALE * component) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Vectors squared at once.
ROWS = 1024
#: Sums stay below this, so that adding one batch to another cannot leave 64 bits.
SAFE = 2**62
#: Doubles of all projections together, which every task receives: 0.5 GB.
MOST_SENT = 1 << 26


def integers(vector: np.ndarray, scale: int = SCALE, shift: int = SHIFT) -> np.ndarray:
    """floor(scale * c) + shift of every component, as long; an error where that is no long."""
    scaled = np.floor(scale * vector)
    if len(scaled) and max(abs(scaled.min()), abs(scaled.max())) >= 2.0**60:
        raise OverflowError("a component of a vector is too large to become a long")
    return scaled.astype(np.int64) + shift


def _matrices(batches: Iterator[pa.RecordBatch], to_integers: Callable) -> Iterator[tuple[pa.Array, int, np.ndarray]]:
    """(keys, length, matrix of x) of the usable vectors of each batch, by length."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            vectors = usable_vectors(part.column(1))
            by_length: dict[int, list[int]] = {}
            for i, v in enumerate(vectors):
                if v is not None:
                    by_length.setdefault(len(v), []).append(i)
            for length, rows in by_length.items():
                matrix = np.array([to_integers(vectors[i]) for i in rows])
                yield part.column(0).take(pa.array(rows)), length, matrix


class _Sums:
    """Exact sums of integer rows in 64 bits; what would not fit any more is handed out before."""

    def __init__(self, emit: Callable[[int, np.ndarray], pa.RecordBatch]) -> None:
        self.emit, self.count, self.total, self.bound = emit, 0, None, 0

    def add(self, count: int, total: np.ndarray, bound: int) -> Iterator[pa.RecordBatch]:
        if self.total is not None and self.bound + bound > SAFE:
            yield from self.close()
        if self.total is None:
            self.count, self.total, self.bound = 0, np.zeros_like(total), 0
        self.count, self.total, self.bound = self.count + count, self.total + total, self.bound + bound

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.total is not None:
            yield self.emit(self.count, self.total)
        self.total = None


def _square_sum(values: np.ndarray) -> tuple[np.ndarray, int]:
    """Sums of the squares of each column, and a bound of them; Python integers where 64 bits are too few."""
    largest = max(abs(int(values.min())), abs(int(values.max())))
    bound = len(values) * largest * largest
    if bound > SAFE:
        values = values.astype(object)
    return (values * values).sum(axis=0), bound


@dataclass(frozen=True)
class Fit:
    """The fit of all vectors of one length: ``sums`` and ``covariance`` are exact and correctly rounded."""

    count: int
    sums: list[int]
    covariance: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / np.trace(self.covariance)

    def whole_means(self) -> np.ndarray:
        return np.array([s // self.count for s in self.sums], np.int64)

    def rests(self) -> np.ndarray:
        return np.array([s % self.count for s in self.sums], np.int64)

    def whiten(self, x: np.ndarray, most: int | None = None) -> np.ndarray:
        """The rows of ``x``, less the mean, on the first components, over the roots of their eigenvalues."""
        centred = (x - self.whole_means()) - self.rests() / self.count
        return centred @ (self.components[:, :most] / np.sqrt(self.eigenvalues[:most]))

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """The sum of (n*x - S)^2 over the dimensions of each row, exact; an error where it is no long."""
        u, rest = x - self.whole_means(), self.rests()
        largest = self.count * (1 + max(abs(int(u.min())), abs(int(u.max())))) if u.size else 0
        if u.shape[1] * largest * largest < 2**63:
            return ((self.count * u - rest) ** 2).sum(axis=1)
        exact = ((self.count * u.astype(object) - rest.astype(object)) ** 2).sum(axis=1)
        if max(exact) >= 2**63:
            raise OverflowError("a deviation does not fit a long")
        return exact.astype(np.int64)


def _sums(vectors: DataFrame, to_integers: Callable) -> dict[int, tuple[int, list[int]]]:
    """Number of vectors and sum of x in each dimension, by length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emitting(length: int) -> Callable[[int, np.ndarray], pa.RecordBatch]:
            return lambda count, total: pa.RecordBatch.from_pydict({
                "dim": pa.array([length] * length, pa.int32()), "i": pa.array(range(length), pa.int32()),
                "n": pa.array([count] * length, pa.int64()), "total": pa.array(list(map(str, total.tolist()))),
            })

        open_: dict[int, _Sums] = {}
        for _, length, x in _matrices(batches, to_integers):
            sums = open_.setdefault(length, _Sums(emitting(length)))
            bound = len(x) * max(abs(int(x.min())), abs(int(x.max())))
            yield from sums.add(len(x), (x if bound <= SAFE else x.astype(object)).sum(axis=0), bound)
        for sums in open_.values():
            yield from sums.close()

    parts = vectors.mapInArrow(run, "dim int, i int, n long, total string")
    exact = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    found: dict[int, tuple[int, list[int]]] = {}
    for row in parts.groupBy("dim", "i").agg(F.sum("n").alias("n"), exact).orderBy("dim", "i").collect():
        found.setdefault(row.dim, (row.n, []))[1].append(int(row.total))
    return found


def _square_sums(
    vectors: DataFrame, to_integers: Callable, means: dict[int, np.ndarray]
) -> dict[int, dict[tuple[int, int], int]]:
    """By length and (i, j): the sum of u_i^2 where i = j, else of (u_i + u_j)^2; u = x - whole mean."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emitting(length: int, i: int) -> Callable[[int, np.ndarray], pa.RecordBatch]:
            return lambda _, total: pa.RecordBatch.from_pydict({
                "dim": pa.array([length] * (length - i), pa.int32()), "i": pa.array([i] * (length - i), pa.int32()),
                "j": pa.array(range(i, length), pa.int32()), "total": pa.array(list(map(str, total.tolist()))),
            })

        open_: dict[tuple[int, int], _Sums] = {}
        for _, length, x in _matrices(batches, to_integers):
            u = x - means[length]
            for i in range(length):
                # The first column is the dimension itself, the others its sums with those after it.
                pairs = np.concatenate([u[:, i : i + 1], u[:, i : i + 1] + u[:, i + 1 :]], axis=1)
                total, bound = _square_sum(pairs)
                yield from open_.setdefault((length, i), _Sums(emitting(length, i))).add(len(u), total, bound)
        for sums in open_.values():
            yield from sums.close()

    parts = vectors.mapInArrow(run, "dim int, i int, j int, total string")
    exact = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    found: dict[int, dict[tuple[int, int], int]] = {}
    for row in parts.groupBy("dim", "i", "j").agg(exact).collect():
        found.setdefault(row.dim, {})[row.i, row.j] = int(row.total)
    return found


def covariance_by_polarisation(count: int, sums: list[int], squares: dict[tuple[int, int], int]) -> np.ndarray:
    """The matrix from variances of dimensions and of their sums, each entry rounded once.

    ``squares`` are sums of squares of values less their whole mean; ``n * (n * square - r^2)`` is
    the sum of (n*x - S)^2. For the sum of two dimensions the rests add up.
    """
    d, n = len(sums), count
    rest = [s % n for s in sums]
    own = [n * squares[i, i] - rest[i] ** 2 for i in range(d)]
    made = np.empty((d, d))
    for i in range(d):
        made[i, i] = own[i] / n**2
        for j in range(i + 1, d):
            both = n * squares[i, j] - (rest[i] + rest[j]) ** 2
            made[i, j] = made[j, i] = (both - own[i] - own[j]) / (2 * n**2)
    return made


def decompose(count: int, sums: list[int], covariance: np.ndarray) -> Fit:
    """Unit eigenvectors by falling eigenvalue, those without variance beyond rounding left out.

    Of the two signs of an eigenvector the one whose largest entry is positive is taken.
    """
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    use = values > np.trace(covariance) * len(values) * np.finfo(float).eps
    values, vectors = values[use], vectors[:, use]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))]) if len(values) else 1
    return Fit(count, sums, covariance, vectors * sign, values)


class Whitening:
    """Fits by vector length, and the frames they make of vectors."""

    def __init__(self, fits: dict[int, Fit], to_integers: Callable[[np.ndarray], np.ndarray] = integers) -> None:
        self.fits, self.to_integers = fits, to_integers
        if sum(fit.components.size for fit in fits.values()) > MOST_SENT:
            raise ValueError("the projections are too large to be sent to every task")

    def identity_errors(self, vectors: DataFrame, vector: str = "embedding", most: int | None = None) -> dict[int, float]:
        """By length: the largest absolute entry of the covariance of the whitened vectors less the identity.

        It is measured on all vectors: every task holds count, mean and centred products of those it
        has seen, and merges them batch by batch (means are taken off before multiplying).
        """
        fits, to_integers = self.fits, self.to_integers

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            open_: dict[int, tuple] = {}
            for _, length, x in _matrices(batches, to_integers):
                if length in fits and len(fits[length].eigenvalues):
                    open_[length] = _merged(open_.get(length), _moments(fits[length].whiten(x, most)))
            for length, (count, mean, products) in open_.items():
                yield _packed(length, count, mean, products)

        def merge(keys: tuple, group: pa.Table) -> pa.Table:
            held = None
            for n, mean, products in zip(*[group[c].to_pylist() for c in ("n", "mean", "products")], strict=True):
                size = len(mean) // 8
                held = _merged(held, (n, np.frombuffer(mean), np.frombuffer(products).reshape(size, size)))
            return pa.Table.from_batches([_packed(keys[0].as_py(), *held)])

        schema = "dim int, n long, mean binary, products binary"
        parts = vectors.select(F.lit(None).cast("long").alias("key"), F.col(f"`{vector}`").alias("vec")).mapInArrow(run, schema)
        # Two steps, so that no task merges what all tasks of a large table have gathered.
        some = parts.withColumn("turn", F.spark_partition_id() % 256).groupBy("dim", "turn").applyInArrow(merge, schema)
        errors = {}
        for row in some.groupBy("dim").applyInArrow(merge, schema).collect():
            products = np.frombuffer(row.products)
            size = round(len(products) ** 0.5)
            errors[row.dim] = float(np.abs(products.reshape(size, size) / row.n - np.eye(size)).max())
        return errors

    def apply(
        self, vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int | None = None
    ) -> DataFrame:
        """key, dim, deviation long and whitened array<double> of each row whose vector can be used.

        At most ``most`` components. Null keys and repeated rows stay as they are; other columns are
        left out. Rows of a length that was not fitted, and of one without variance, are left out.
        """
        fits, to_integers = self.fits, self.to_integers
        rows = vectors.select(F.col(f"`{key}`").alias(key), F.col(f"`{vector}`").alias("vec"))
        kind = rows.schema[key].dataType

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for keys, length, x in _matrices(batches, to_integers):
                if length not in fits or not len(fits[length].eigenvalues):
                    continue
                made = fits[length].whiten(x, most)
                offsets = np.arange(len(made) + 1, dtype=np.int32) * made.shape[1]
                whitened = pa.ListArray.from_arrays(pa.array(offsets), pa.array(made.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array([length] * len(made), pa.int32()), pa.array(fits[length].deviations(x)), whitened],
                    [key, "dim", "deviation", "whitened"],
                )

        return rows.mapInArrow(run, f"`{key}` {kind.simpleString()}, dim int, deviation long, whitened array<double>")


def _moments(w: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    mean = w.mean(axis=0)
    return len(w), mean, (w - mean).T @ (w - mean)


def _packed(length: int, count: int, mean: np.ndarray, products: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "dim": pa.array([length], pa.int32()), "n": pa.array([count], pa.int64()),
        "mean": pa.array([mean.tobytes()], pa.binary()), "products": pa.array([products.tobytes()], pa.binary()),
    })


def _merged(a: tuple | None, b: tuple) -> tuple:
    if a is None:
        return b
    count, away = a[0] + b[0], b[1] - a[1]
    return count, a[1] + away * (b[0] / count), a[2] + b[2] + np.outer(away, away) * (a[0] * b[0] / count)


def fit(vectors: DataFrame, vector: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> Whitening:
    """The fit of all vectors of a table; those that are null, empty or hold null or non-finite entries take no part.

    Vectors of different lengths are fit lists of their own. Repeated rows count each time. An empty
    table gives no fit. Components must fit a long after scaling.
    """

    def to_integers(v: np.ndarray) -> np.ndarray:
        return integers(v, scale, shift)

    rows = vectors.select(F.lit(None).cast("long").alias("key"), F.col(f"`{vector}`").alias("vec"))
    sums = _sums(rows, to_integers)
    means = {d: np.array([s // n for s in total], np.int64) for d, (n, total) in sums.items()}
    squares = _square_sums(rows, to_integers, means) if sums else {}
    fits = {d: decompose(n, total, covariance_by_polarisation(n, total, squares[d])) for d, (n, total) in sums.items()}
    return Whitening(fits, to_integers)


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, whitened, up to 32 components: a row for each."""
    most = 32
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    whitening = fit(vectors)
    errors = whitening.identity_errors(vectors, most=most)
    rows = []
    for dim, one in whitening.fits.items():
        for i, share in enumerate(one.explained[:most].tolist() if len(one.eigenvalues) else []):
            rows.append((dim, i + 1, one.count, share, errors[dim]))
    # One row for each component of each length.
    facts = spark.createDataFrame(rows, "dim int, component int, n long, explained double, identity_error double")
    made = whitening.apply(vectors, most=most).select("vec_id", "dim", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    made = made.withColumn("component", (F.col("at") + 1).cast("int"))
    return made.join(F.broadcast(facts), ["dim", "component"]).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    )
