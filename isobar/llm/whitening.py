"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers, and components are fitted on every distinct
vector once.  Of the centred rows X a basis V of directions (as long as a
vector) and a basis U (as long as the table) are made in turn, so that XV = UB
with a bidiagonal B: a distributed product Xv gives the next of U, and a
distributed product X'u the next of V.  U is never stored: all of it lies in the
range of X, so each u is Xw for a direction w that the driver keeps, and tasks
make its entries from their rows as they need them.  Each pass gives Xw, its
length, its products with all earlier u and its X'u.  Both bases are
reorthogonalised in full and twice; the singular values of B and its vectors
give deviations and components.

The leading triples are taken when their residuals are at the limit of double
precision, or when the space is exhausted.  One run sees one direction of an
eigenvalue that is there twice; so further runs start in the complement of what
was found, until they find nothing larger.  Where all variance has been found
there is none to look for.

Only arrays as long as a vector (times the number of steps) are on the driver;
sums go through a grouping by place, whatever the number of tasks.

Vectors that are null or hold null or non-finite entries are left out, as are
those of another length than most have (of two lengths as frequent: the larger
one).  Entries beyond a long are taken as the nearest long; a deviation beyond
a long is null.  A null vec_id is kept, and rows that share a vec_id, or are
equal, have rows of their own.  Components without variance are left out, so
that equal vectors, one vector and an empty table give an empty result.  Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.store import discard, ship, written

SCALE = 256
COMPONENTS = 4
RESIDUAL = 1e-13  #: of the gap to the next singular value
NO_VARIANCE = 1e-12  #: of the largest eigenvalue


def finite(vector: str):
    """Whether a vector has entries and all of them are numbers."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))


def usual_length(rows: DataFrame, vector: str) -> int:
    """The length that most vectors have, the larger of two; 0 without any."""
    first = rows.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return first["d"] if first else 0


def quantised(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, x`` of the usable rows, ``x`` their entries times ``SCALE`` rounded down."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where(finite("v"))
    rows = written(rows.select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE)).alias("x")))
    return rows.where(F.size("x") == usual_length(rows, "x"))


def matrices(batches: Iterator[pa.RecordBatch], d: int, column: str = "x", rows: int = 4096) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of the batches with their vectors as a matrix."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, d)


def summed(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray], d: int, width: int) -> np.ndarray:
    """The sum over all vectors of what ``of`` gives for a matrix of them, ``width`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for _, x in matrices(batches, d):
            total += of(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total)], names=["place", "value"])

    out = np.zeros(width)
    for r in rows.select("x").mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect():
        out[r["place"]] = r["value"]
    return out


def exact_sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of vectors and the sum of each dimension, as whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * d
        for _, x in matrices(batches, d):
            x = x if np.abs(x.astype(float)).max(initial=0) < 2**50 else x.astype(object)  # 4096 of these fit a long
            n += len(x)
            sums = [a + int(b) for a, b in zip(sums, x.sum(0), strict=True)]
        whole = pa.array([Decimal(n), *map(Decimal, sums)], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, d, dtype=np.int32)), whole], names=["place", "value"])

    found = {r["place"]: int(r["value"]) for r in rows.select("x").mapInArrow(run, "place int, value decimal(38,0)").groupBy("place").agg(F.sum("value").alias("value")).collect()}
    return found[-1], [found[i] for i in range(d)]


def _away(r: np.ndarray, *bases: list[np.ndarray]) -> np.ndarray:
    """What is left of ``r`` without the bases, which are orthonormal."""
    for _ in range(2):
        for basis in bases:
            for b in basis:
                r = r - b * (b @ r)
    return r


Product = Callable[[np.ndarray, list[np.ndarray]], tuple[float, np.ndarray, np.ndarray]]


def bidiagonalised(product: Product, d: int, wanted: int, locked: list[np.ndarray], seed: int) -> tuple[np.ndarray, list[np.ndarray], bool]:
    """Singular values and right vectors of X in the complement of ``locked``, the largest first, and whether all of that was seen.

    ``product(w, W)`` gives for q = Xw its squared length, its products with XW and X'q.
    """
    v = _away(np.random.default_rng(seed).standard_normal(d), locked)
    v /= np.linalg.norm(v)
    right, left, back = [v], [], []  # V, W with U = XW, and X'U
    diagonal, above = [], []
    while True:
        v = right[-1]
        w = v - sum((b * (g @ v) for b, g in zip(left, back, strict=True)), np.zeros(d))
        square, again, g = product(w, left)
        w = w - sum((b * c for b, c in zip(left, again, strict=True)), np.zeros(d))
        g = g - sum((b * c for b, c in zip(back, again, strict=True)), np.zeros(d))
        alpha = np.sqrt(max(square - again @ again, 0.0))
        largest = max([alpha, *diagonal, *above])
        if not largest or alpha <= 1e-13 * largest:  # nothing new in the range of X: B has one column more than rows
            if not diagonal:
                return np.zeros(0), [], True
            beta, ended = 0.0, True
        else:
            left.append(w / alpha)
            back.append(g / alpha)
            diagonal.append(alpha)
            r = _away(g / alpha - alpha * v, right, locked)
            beta = float(np.linalg.norm(r))
            ended = len(right) + len(locked) >= d or beta <= 1e-13 * max(largest, beta)
        k = len(diagonal)
        b = np.zeros((k, len(right)))
        b[range(k), range(k)] = diagonal
        b[range(len(above)), range(1, len(above) + 1)] = above
        p, sigma, q = np.linalg.svd(b, full_matrices=False)
        gaps = np.array([np.abs(np.delete(sigma, i) - s).min(initial=s) for i, s in enumerate(sigma)])
        left_over = beta * np.abs(p[-1])
        done = left_over <= np.maximum(RESIDUAL * gaps, 4 * np.finfo(float).eps * sigma[0])
        if ended or (k > wanted and done[:wanted].all()):
            return sigma, list(q @ np.array(right)), ended
        above.append(beta)
        right.append(r / beta)


@dataclass(frozen=True)
class Whitening:
    """What ``n`` distinct vectors give: exact ``sums``, ``axes`` (a row for each component), eigenvalues ``values`` and the ``trace`` of the covariance."""

    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(Fraction(s, self.n)) for s in self.sums])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.axes.T / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n x - sums) squared, exact; None beyond a long."""
        reach = max(np.abs(x.astype(float)).max(initial=0) * self.n, *(abs(s) for s in self.sums), 1.0)
        small = 4 * x.shape[1] * reach**2 < 2.0**62
        x = x if small else x.astype(object)
        away = x * self.n - np.array(self.sums, dtype=np.int64 if small else object)
        return [int(s) if s < 2**63 else None for s in (away * away).sum(1)]


def fitted(vectors: DataFrame, components: int = COMPONENTS, seed: int = 7) -> Whitening | None:
    """The whitening of ``vectors`` (x), each row counted; None without rows."""
    d = usual_length(vectors, "x")
    if not d:
        return None
    n, sums = exact_sums(vectors, d)
    mean = np.array([float(Fraction(s, n)) for s in sums])
    trace = float(summed(vectors, lambda x: np.array([((x - mean) ** 2).sum()]), d, 1)[0]) / n

    def product(w: np.ndarray, left: list[np.ndarray]) -> tuple[float, np.ndarray, np.ndarray]:
        others = np.array(left).reshape(len(left), d)

        def of(x: np.ndarray) -> np.ndarray:
            x = x - mean
            q = x @ w
            return np.concatenate([[q @ q], (q @ x) if not len(others) else np.concatenate([(x @ others.T).T @ q, q @ x])])

        out = summed(vectors, of, d, 1 + len(left) + d)
        return float(out[0]), out[1 : 1 + len(left)], out[1 + len(left) :]

    values, axes = np.zeros(0), []
    run = 0
    while trace > 0 and len(axes) < d:
        more, found, ended = bidiagonalised(product, d, max(1, components - len(axes)), axes, seed + run)
        new = more**2 / n
        if not len(new) or (len(values) >= components and new[0] <= values[-1] * (1 + 1e-12)):
            break
        order = np.argsort(np.concatenate([values, new]), kind="stable")[::-1]
        axes, values = [(*axes, *found)[i] for i in order], np.concatenate([values, new])[order]
        all_seen = ended and values.sum() >= trace * (1 - 1e-11)
        axes, values = axes[:components], values[:components]
        if all_seen:
            break
        run += 1
    keep = values > NO_VARIANCE * values[0] if len(values) else np.zeros(0, bool)
    return Whitening(n, sums, np.array(axes).reshape(-1, d)[keep], values[keep], trace)


def identity_error(vectors: DataFrame, fit: Whitening) -> float:
    """The largest entry, by size, of the whitened vectors' covariance minus the identity."""
    k, d = fit.axes.shape

    def of(x: np.ndarray) -> np.ndarray:
        y = fit.whitened(x)
        return np.concatenate([y.sum(0), (y.T @ y).ravel()])

    out = summed(vectors, of, d, k + k * k) / fit.n
    return float(np.abs(out[k:].reshape(k, k) - np.outer(out[:k], out[:k]) - np.eye(k)).max())


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(embeddings: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """``embeddings`` (vec_id, vector) to a row for each usable vector and component."""
    spark = embeddings.sparkSession
    ship(spark)
    rows = quantised(embeddings, vector)
    distinct = written(rows.select("x").distinct())
    fit = fitted(distinct, components)
    if fit is None or not len(fit.values):
        return spark.createDataFrame([], RESULT)
    error = identity_error(distinct, fit)
    discard(distinct)
    k, d = fit.axes.shape
    explained = fit.values / fit.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in matrices(batches, d):
            m = len(x)
            deviation = pa.array(fit.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
            ids = part.column("vec_id").take(pa.array(np.repeat(np.arange(m), k)))
            columns = [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, fit.n)), deviation, pa.array(fit.whitened(x).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in RESULT.split(", ")])

    return rows.mapInArrow(run, RESULT)
