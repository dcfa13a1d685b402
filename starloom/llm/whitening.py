"""Whitened embeddings from a covariance by polarisation.

Entries become integers, so that all sums are exact. The variance of every dimension and
of the sum of every two dimensions is aggregated from squared centred values, and
``2 cov(a, b) = var(a + b) - var(a) - var(b)`` recovers all other covariances. The matrix
is then as small as the vectors are long, squared, whatever the table holds, and goes to
``eigh`` on the driver.

Values are centred at the whole number below their mean before they are squared; what is
left of the mean, less than one, enters as ``sum (x - S/n)^2 = sum z^2 - r^2 / n`` in whole
numbers. So nothing is rounded before the one division at the end.

Rows: a vector that is null, empty, or holds null or non-finite entries is dropped. If
vectors differ in length, those of the most frequent length count (of the longest of them,
if two are equally frequent), the others are dropped. Ids are carried along: null and
repeated ones give rows as any other. No vector at all gives no rows. An entry beyond a
billion counts as a billion, so that sums of squares stay within 38 digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Whole steps of an entry, what is added to them, and how far from it they may be.
STEPS, SHIFT, FARTHEST = 1024, 100_000, 1 << 40
#: Whole numbers below this are squared and summed over a batch in 64 bits; larger ones in halves.
SMALL, HALF = 1 << 22, 21
#: Rows of a batch that are worked on at a time.
ROWS = 4096
#: A component whose eigenvalue is below this share of the largest has no direction of its own.
FLAT = 1e-12


class Whitening(NamedTuple):
    """Rows, sums by dimension, covariance, eigenvalues (falling) and eigenvectors (columns)."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @property
    def trace(self) -> float:
        return float(np.trace(self.covariance))

    def directions(self, components: int) -> tuple[np.ndarray, np.ndarray]:
        """Eigenvectors over the roots of their eigenvalues, by column, and which have one."""
        values = self.values[:components]
        there = values > max(FLAT * float(self.values[0]), 0.0) if len(self.values) else np.zeros(0, bool)
        scale = np.where(there, 1 / np.sqrt(np.where(there, values, 1.0)), 0.0)
        return self.vectors[:, :components] * scale, there


def whole(values: np.ndarray) -> np.ndarray:
    """Entries as whole numbers: floor(1024 c) + 100000."""
    steps = np.floor(np.clip(values * float(STEPS), -float(FARTHEST), float(FARTHEST)))
    return steps.astype(np.int64) + SHIFT


def usable(embeddings: DataFrame, vector: str) -> DataFrame:
    """Rows with a vector of finite entries only, which is then of doubles."""
    doubles = embeddings.withColumn(vector, F.col(vector).cast("array<double>"))

    def finite(entry: Column) -> Column:
        return entry.isNotNull() & ~F.isnan(entry) & (F.abs(entry) < float("inf"))

    return doubles.where((F.size(vector) > 0) & F.forall(vector, finite))


def of_one_length(vectors: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """Rows of the most frequent length, and that length; 0 if there are no rows."""
    lengths = vectors.groupBy(F.size(vector).alias("length")).count()
    found = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    if found is None:
        return vectors, 0
    return vectors.where(F.size(vector) == found.length), found.length


def _matrices(batch: pa.RecordBatch, vector: str, length: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of a batch, and their whole numbers by row."""
    for at in range(0, batch.num_rows, ROWS):
        part = batch.slice(at, ROWS)
        flat = part.column(part.schema.get_field_index(vector)).flatten()
        yield part, whole(flat.to_numpy(zero_copy_only=False).reshape(-1, length))


def _pairs(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Every dimension with itself and with all later ones, in the order of ``pair_squares``."""
    return np.triu_indices(length)


def pair_squares(z: np.ndarray) -> list[int]:
    """Sums over rows of z_i^2 (first of its run) and (z_i + z_j)^2 for j > i, exact."""
    by_dimension = np.ascontiguousarray(z.T)

    def products(left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
        out = []
        for i in range(len(left)):
            a, b = left[i:] + left[i], right[i:] + right[i]
            a[0], b[0] = left[i], right[i]
            out.append(np.einsum("ij,ij->i", a, b))
        return np.concatenate(out)

    if not z.size or np.abs(z).max() < SMALL:
        return products(by_dimension, by_dimension).tolist()
    high = by_dimension >> HALF
    low = by_dimension - (high << HALF)
    squares = zip(products(high, high).tolist(), products(high, low).tolist(), products(low, low).tolist())
    return [(h << 2 * HALF) + (m << HALF + 1) + s for h, m, s in squares]


def _totals(vectors: DataFrame, vector: str, length: int, count: int, of_rows) -> list[int]:
    """Sums over all rows of the ``count`` whole numbers that ``of_rows(z)`` gives for some rows.

    A task adds its own rows up and sends ``count`` numbers.
    """
    whole_number = pa.decimal128(38, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * count
        seen = False
        for batch in batches:
            for _, x in _matrices(batch, vector, length):
                seen = True
                total = [a + b for a, b in zip(total, of_rows(x))]
        if seen:
            values = pa.array([Decimal(t) for t in total], whole_number)
            yield pa.RecordBatch.from_arrays([pa.array(range(count), pa.int32()), values], ["at", "total"])

    parts = vectors.select(vector).mapInArrow(run, "at int, total decimal(38,0)")
    found = dict(parts.groupBy("at").agg(F.sum("total")).collect())
    return [int(found.get(k) or 0) for k in range(count)]


def covariance(squares: list[int], left: list[int], n: int) -> np.ndarray:
    """The covariance matrix, each entry rounded once, from sums of squares about whole centres.

    ``left`` are the sums of the centred values, which are below n.
    """
    length = len(left)
    rows, columns = (p.tolist() for p in _pairs(length))
    # n times the squared deviations of every dimension, then of every two together
    spread = {}
    for i, j, square in zip(rows, columns, squares):
        r = left[i] if i == j else left[i] + left[j]
        spread[i, j] = n * square - r * r
    out = np.empty((length, length))
    for i, j in zip(rows, columns):
        if i == j:
            out[i, i] = spread[i, i] / (n * n)
        else:
            out[i, j] = out[j, i] = (spread[i, j] - spread[i, i] - spread[j, j]) / (2 * n * n)
    return out


def fit(embeddings: DataFrame, vector: str = "embedding") -> Whitening | None:
    """The whitening of all usable rows; None if there are none.

    Two passes: sums by dimension, then squares of every dimension and pair about them.
    """
    vectors, length = of_one_length(usable(embeddings, vector), vector)
    if not length:
        return None

    def sums_of(x: np.ndarray) -> list[int]:
        return [len(x), *x.sum(0).tolist()]

    n, *sums = _totals(vectors, vector, length, length + 1, sums_of)
    centre = np.array([s // n for s in sums], dtype=np.int64)

    def squares_of(x: np.ndarray) -> list[int]:
        return pair_squares(x - centre)

    squares = _totals(vectors, vector, length, length * (length + 1) // 2, squares_of)
    matrix = covariance(squares, [s % n for s in sums], n)
    values, columns = np.linalg.eigh(matrix)
    values, columns = values[::-1], columns[:, ::-1]
    # either sign is right; the largest entry is positive, so that all runs agree
    signs = np.sign(columns[np.abs(columns).argmax(0), np.arange(length)])
    return Whitening(n, sums, matrix, values, columns * np.where(signs == 0, 1, signs))


def deviations(z: np.ndarray, left: list[int], n: int) -> list[int]:
    """Sums over dimensions of (n x - S)^2 by row, exact, for x about whole centres."""
    largest = n * (int(np.abs(z).max(initial=0)) + 1)
    kind = np.int64 if z.shape[1] * largest * largest < 1 << 62 else object
    far = z.astype(kind) * n - np.array(left, dtype=kind)
    return (far * far).sum(1).tolist()


def _projected(z: np.ndarray, model: Whitening, directions: np.ndarray) -> np.ndarray:
    rest = np.array([(s % model.n) / model.n for s in model.sums])
    return (z - rest) @ directions


def identity_error(embeddings: DataFrame, model: Whitening, components: int, vector: str = "embedding") -> float | None:
    """The largest absolute entry of the covariance of all whitened rows minus the identity.

    Measured on the whitened values, not derived from the fit. Components without a
    direction do not count; None if there is no other.
    """
    directions, there = model.directions(components)
    directions = directions[:, there]
    kept, length = directions.shape[1], len(model.sums)
    if not kept:
        return None
    centre = np.array([s // model.n for s in model.sums], dtype=np.int64)
    vectors = usable(embeddings, vector).where(F.size(vector) == length)
    # whitened values add up in whole steps, so that the order of tasks does not matter
    fine = 1 << 40

    def moments(x: np.ndarray) -> list[int]:
        w = _projected(x - centre, model, directions)
        return [round(float(v) * fine) for v in np.concatenate([w.sum(0), (w.T @ w).ravel()])]

    totals = [t / fine / model.n for t in _totals(vectors, vector, length, kept + kept * kept, moments)]
    means = np.array(totals[:kept])
    products = np.array(totals[kept:]).reshape(kept, kept)
    return float(np.abs(products - np.outer(means, means) - np.eye(kept)).max())


RESULT = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whitened(
    embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 8
) -> DataFrame:
    """A row for each usable row of ``embeddings`` and component: (key, and those of ``RESULT``).

    A component without spread (an eigenvalue of zero) has null in ``whitened``; ``explained``
    is null where nothing varies. ``deviation`` is null beyond 38 digits.
    """
    spark = embeddings.sparkSession
    kind = embeddings.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, {RESULT}"
    narrow = embeddings.select(key, vector)
    model = fit(narrow, vector)
    if model is None:
        return spark.createDataFrame([], schema)
    error = identity_error(narrow, model, components, vector)
    length = len(model.sums)
    directions, there = model.directions(components)
    kept = len(there)
    centre = np.array([s // model.n for s in model.sums], dtype=np.int64)
    left = [s % model.n for s in model.sums]
    trace = model.trace
    explained = [float(v) / trace if trace > 0 else None for v in model.values[:kept]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in _matrices(batch, vector, length):
                z, rows = x - centre, len(x)
                projected = _projected(z, model, directions)
                lost = np.tile(~there, rows)
                far = [Decimal(d) if d < 10**38 else None for d in deviations(z, left, model.n)]
                by_row = pa.array(np.repeat(np.arange(rows), kept))
                ids = part.column(part.schema.get_field_index(key))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(by_row),
                        pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * kept, model.n, np.int64)),
                        pa.array(far, pa.decimal128(38, 0)).take(by_row),
                        pa.array(projected.ravel(), mask=lost),
                        pa.array(explained * rows, pa.float64()),
                        pa.array([error] * (rows * kept), pa.float64()),
                    ],
                    names=[key, *(f.split()[0] for f in RESULT.split(", "))],
                )

    vectors = usable(narrow, vector).where(F.size(vector) == length)
    return vectors.mapInArrow(run, schema)
