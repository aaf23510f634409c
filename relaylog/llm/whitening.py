"""PCA whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become whole numbers, so sums and deviations are exact: n vectors x with per-dimension sums S are centred as
n*x - S before anything is multiplied. A block of directions Q is carried through passes over the data, each the product of the
covariance with Q as a sum over tasks of Xc'(Xc Q): no task and no driver ever holds more than dimensions x directions
numbers, and the covariance itself is never formed. One iteration is

1. a Chebyshev filter: a three-term recurrence over ``DEGREE`` passes whose polynomial stays within -1 and 1 on the unwanted part of
   the spectrum, from 0 to the smallest Ritz value of the block, and grows fast above it;
2. QR, so that the block stays a basis;
3. Rayleigh-Ritz on one more pass: the projected matrix gives eigenvalues, vectors and the residual of each.

It ends when the residuals of all wanted components are certified below ``TOLERANCE`` of the largest eigenvalue twice: the
second time after the spare directions of the block are replaced by new random ones and filtered again, so that an
eigenvector that the first block had no part in would show up. Or when the residuals no longer fall, which is the accuracy that doubles have.

Vectors that are null, empty, or hold a null, NaN or infinite entry are left out; the dimension is that of the longest vector
left, and a shorter one lacks entries, so it is left out too. Repeated rows and null vec_ids count like any others. An empty table,
or one without variance, gives no rows. Components without variance (an eigenvalue below ``RANK`` of the largest) have no
whitened coordinate and no rows, so there can be fewer than asked for. A deviation beyond 64 bits is null. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaylog.llm.common import stored

COMPONENTS = 32
#: Directions carried besides the wanted ones: half as many again, 8 at least.
SPARE = 8
#: Passes of one filter.
DEGREE = 8
#: Residual of an eigenvector against the largest eigenvalue. Rounding alone leaves about 1e-15.
TOLERANCE = 1e-13
#: Components whose eigenvalue is below this part of the largest have no variance.
RANK = 1e-12
MOST_FILTERS = 60
_SCALE, _SHIFT = 64, 1_000_000
#: Entries from here on would leave 64 bits as whole numbers and their sums; they count as infinite.
LARGEST = 1 << 40


def whole_numbers(embeddings: DataFrame) -> DataFrame:
    """vec_id and x, an array of whole numbers, of the vectors that count."""
    c = F.col("embedding")
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float(LARGEST)))
    kept = embeddings.select("vec_id", c.cast("array<double>").alias("embedding")).filter(c.isNotNull() & (F.size(c) > 0) & finite)
    x = F.transform(c, lambda v: F.floor(v * _SCALE).cast("long") + _SHIFT)
    return kept.select("vec_id", x.alias("x"))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        x = batch.column(batch.schema.get_field_index("x"))
        yield x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


@dataclass(frozen=True)
class Centre:
    """The number of vectors and, per dimension, the whole mean and what it leaves of the sum: S = n * mean + rest."""

    n: int
    mean: np.ndarray
    rest: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n. The difference with the whole mean is exact, so only the last step rounds."""
        return (x - self.mean).astype(np.float64) - self.rest.astype(np.float64) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The exact sum over dimensions of (n*x - S)^2; none beyond 64 bits."""
        off = x - self.mean
        widest = self.n * (int(np.abs(off).max()) + 1)
        if widest * widest * x.shape[1] < 1 << 63:
            return ((self.n * off - self.rest) ** 2).sum(axis=1).tolist()
        exact = ((self.n * off.astype(object) - self.rest.astype(object)) ** 2).sum(axis=1)
        return [d if d < 1 << 63 else None for d in exact]


@dataclass(frozen=True)
class Fit:
    """The vectors as stored, their centre, and the components found."""

    vectors: DataFrame
    centre: Centre
    values: np.ndarray
    directions: np.ndarray
    trace: float
    residual: float
    passes: int


def _summed(vectors: DataFrame, matrix, rows: int, columns: int) -> np.ndarray:
    """The sum over all vectors of ``matrix(block)``, rows x columns, added up within tasks and then by Spark."""
    names = [f"c{j}" for j in range(columns)]
    schema = "i int, " + ", ".join(f"{c} double" for c in names)

    def part(batches):
        total = np.zeros((rows, columns))
        for x in _matrices(batches):
            total += matrix(x)
        yield pa.RecordBatch.from_arrays([pa.array(range(rows), pa.int32()), *map(pa.array, total.T.copy())], names=["i", *names])

    parts = vectors.mapInArrow(part, schema).groupBy("i").agg(*[F.sum(c).alias(c) for c in names])
    out = np.zeros((rows, columns))
    for row in parts.collect():  # one row a dimension
        out[row[0]] = row[1:]
    return out


class _Covariance:
    """Products with the covariance, each one pass over the vectors."""

    def __init__(self, vectors: DataFrame, centre: Centre):
        self.vectors, self.centre, self.passes = vectors, centre, 0

    def __matmul__(self, q: np.ndarray) -> np.ndarray:
        centre = self.centre
        self.passes += 1

        def product(x):
            c = centre.centred(x)
            return c.T @ (c @ q)

        return _summed(self.vectors, product, *q.shape) / centre.n


def chebyshev_filter(v, q: np.ndarray, degree: int, low: float, high: float) -> np.ndarray:
    """The polynomial of ``v`` that is small between ``low`` and ``high``, on ``q``. ``high`` is where growth begins."""
    half, centre = (high - low) / 2, (high + low) / 2
    before, now = q, (v @ q - centre * q) / half
    for _ in range(degree - 1):
        before, now = now, 2 * (v @ now - centre * now) / half - before
        size = np.linalg.norm(now, axis=0).max()
        before, now = before / size, now / size
    return now


def _ritz(v, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues (falling), vectors and residuals of ``v`` on the space of ``q``."""
    vq = v @ q
    values, turn = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    vectors = q @ turn
    return values, vectors, np.linalg.norm(vq @ turn - vectors * values, axis=0)


def top_components(v, dimensions: int, wanted: int, seed: int = 12) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``wanted`` largest eigenvalues of ``v`` (anything with ``@``), their vectors as columns, the largest residual."""
    rng = np.random.default_rng(seed)
    block = min(dimensions, wanted + max(SPARE, wanted // 2))
    q = np.linalg.qr(rng.standard_normal((dimensions, block)))[0]
    values, q, residuals = _ritz(v, q)
    best, stuck, certified = math.inf, 0, False
    for _ in range(MOST_FILTERS):
        worst = residuals[:wanted].max()
        if values[0] <= 0 or block == dimensions:
            return values[:wanted], q[:, :wanted], worst
        stuck = 0 if worst < best / 2 else stuck + 1
        best = min(best, worst)
        if worst <= TOLERANCE * values[0] or (stuck >= 3 and best <= 100 * TOLERANCE * values[0]):
            if certified:
                return values[:wanted], q[:, :wanted], worst
            certified = True
            q[:, wanted:] = rng.standard_normal((dimensions, block - wanted))
            q, best, stuck = np.linalg.qr(q)[0], math.inf, 0
        high = max(values[-1], values[0] * 1e-9)
        q = np.linalg.qr(chebyshev_filter(v, q, DEGREE, 0.0, high))[0]
        values, q, residuals = _ritz(v, q)
    raise ArithmeticError(f"residual {residuals[:wanted].max()} after {MOST_FILTERS} filters")


def fit(embeddings: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """The components of all vectors; none if no vectors are left or they do not vary."""
    vectors = stored(whole_numbers(embeddings), "vectors")
    dimensions = vectors.agg(F.max(F.size("x"))).first()[0]
    if dimensions is None:
        return None
    vectors = vectors.filter(F.size("x") == dimensions)
    # Sums of whole numbers are exact whatever their order; 38 digits hold them for any number of vectors.
    entry = F.col("v").cast("decimal(18,0)")
    per_dimension = vectors.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(entry).alias("s"), F.count(F.lit(1)).alias("n"))
    rows = sorted(tuple(r) for r in per_dimension.collect())  # one row a dimension
    n = rows[0][2]
    whole = [divmod(int(s), n) for _, s, _ in rows]
    centre = Centre(n, np.array([m for m, _ in whole], np.int64), np.array([r for _, r in whole], np.int64))
    trace = float(_summed(vectors, lambda x: (centre.centred(x) ** 2).sum(axis=0)[:, None], dimensions, 1).sum() / n)
    if trace <= 0:
        return None
    v = _Covariance(vectors, centre)
    values, found, residual = top_components(v, dimensions, min(components, dimensions))
    kept = values > RANK * values[0]
    return Fit(vectors, centre, values[kept], found[:, kept], trace, residual, v.passes)


def whiten(fitted: Fit) -> DataFrame:
    """A row for each vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    centre, count = fitted.centre, len(fitted.values)
    turn = fitted.directions / np.sqrt(fitted.values)
    explained = fitted.values / fitted.trace

    def gram(x):
        w = centre.centred(x) @ turn
        return w.T @ w

    error = float(np.abs(_summed(fitted.vectors, gram, count, count) / centre.n - np.eye(count)).max())
    kind = fitted.vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"

    def rows(batches):
        for batch in batches:
            ids = batch.column(0)
            for x in _matrices([batch]):
                whitened, m = centre.centred(x) @ turn, len(x)
                columns = [
                    ids.take(pa.array(np.repeat(np.arange(m), count))),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * count, centre.n)),
                    pa.array([d for d in centre.deviations(x) for _ in range(count)], pa.int64()),
                    pa.array(whitened.ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * count, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in schema.split(", ")])

    return fitted.vectors.select("vec_id", "x").mapInArrow(rows, schema)


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``whiten`` of the fit of ``embeddings`` (vec_id, embedding); no rows without a fit."""
    fitted = fit(embeddings, components)
    if fitted is None:
        spark = embeddings.sparkSession
        kind = embeddings.schema["vec_id"].dataType.simpleString()
        return spark.createDataFrame(
            [], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        )
    return whiten(fitted)
