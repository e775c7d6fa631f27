"""Whitening of embeddings by shifted CholeskyQR.

Vectors are put on a grid of whole numbers; the model is fitted to each
distinct grid vector once.  The centred rows are made orthonormal in passes
over the table: tasks sum the Gram matrix of what the passes before made of
their rows, the driver takes the Cholesky factor of the sum, shifted by a
little so that it exists whatever the condition, and the next pass solves the
rows through that triangle.  The product of the triangles is the R of the
centred rows, and its singular values and vectors are the components.

The driver and each task hold matrices of dimension times dimension, whatever
the number of rows.  A model is fitted once and given to all tasks, so every
row sees the same signs and the same order.

Defined results: rows whose vector is null or holds null or non-finite entries
go; so do vectors of another length than most distinct vectors have (the
longest, if several lengths do).  Repeated rows and null ids pass through as
often as they occur.  Components without variance (all of them, where fewer
than two distinct vectors are left) have no whitened value and no row.  A
deviation beyond 64 bits is null, and grid entries stop at the ends of 64 bits.  An empty table gives no
rows.  Only the named columns are read; others may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from brightweir.llm.common import empty, staged

# Steps of the grid in one.
GRID = 256
COMPONENTS = 4
# The shift in units of rounding times the norm, per squared dimension; passes at most.
SHIFT = 11
PASSES = 8
# A direction below this share of the largest has no variance but rounding.
NOTHING = 1e-13
LONGS = 2**63 - 1

Step = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Whitening:
    """A fitted model; components lie in the columns of ``axes``."""

    n: int
    sums: list[int]
    axes: np.ndarray
    variances: np.ndarray
    total: float

    def project(self, centred: np.ndarray) -> np.ndarray:
        return centred @ (self.axes / np.sqrt(self.variances))


def on_grid(vector: Column) -> Column:
    """The whole numbers below the entries times the steps of the grid."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * GRID))


def usable(vector: Column) -> Column:
    """Whether a vector is there with entries that are all finite numbers."""
    infinite = F.lit(float("inf"))
    return F.coalesce(
        F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < infinite)), F.lit(False)
    )


def rows_of(values: pa.Array, size: int) -> np.ndarray:
    """A list column of one length as a matrix."""
    return values.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Rows minus the mean; its whole part is taken off before anything is rounded."""
    whole = np.array([s // n for s in sums], np.int64)
    part = np.array([s % n / n for s in sums])
    return (x - whole).astype(np.float64) - part


def solved(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Rows times the inverse of an upper triangle, column after column."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def _sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """Number and exact sums of the vectors; tasks add up whole numbers first."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, held = 0, [0] * size
        for batch in batches:
            x = rows_of(batch.column("x"), size)
            n += len(x)
            # Halves of 32 bits, so that no sum leaves 64.
            high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
            held = [h + (a << 32) + b for h, a, b in zip(held, high, low)]
        parts = [("n", n), *((str(i), s) for i, s in enumerate(held))]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _ in parts], pa.string()),
                pa.array([s >> 32 for _, s in parts], pa.int64()),
                pa.array([s & 0xFFFFFFFF for _, s in parts], pa.int64()),
            ],
            ["place", "high", "low"],
        )

    sums = fit.select("x").mapInArrow(added, "place string, high bigint, low bigint").groupBy("place").agg(
        *(F.sum(F.col(c).cast("decimal(28,0)")).alias(c) for c in ("high", "low"))
    )
    total = {row.place: (int(row.high) << 32) + int(row.low) for row in sums.collect()}
    return total.get("n", 0), [total.get(str(i), 0) for i in range(size)]


def gram(fit: DataFrame, size: int, step: Step) -> np.ndarray:
    """The sum over all rows of what ``step`` makes of them, times itself.

    Each task sends the upper half of its own sum, entry by entry, so the sums
    meet spread over as many tasks as there are entries.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            made = step(rows_of(batch.column("x"), size))
            held = made.T @ made if held is None else held + made.T @ made
        if held is not None:
            i, j = np.triu_indices(len(held))
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(held[i, j])], ["i", "j", "v"])

    entries = fit.select("x").mapInArrow(summed, "i bigint, j bigint, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    rows = entries.collect()
    whole = np.zeros((1 + max(row.i for row in rows),) * 2)
    for row in rows:
        whole[row.i, row.j] = whole[row.j, row.i] = row.v
    return whole


def shifted_cholesky(sums: np.ndarray) -> np.ndarray:
    """The upper triangle whose square is the sum, plus a shift that makes it exist."""
    size = len(sums)
    shift = SHIFT * size * (size + 1) * np.finfo(float).eps / 2 * np.linalg.norm(sums, 2)
    while True:
        try:
            return np.linalg.cholesky(sums + shift * np.eye(size)).T
        except np.linalg.LinAlgError:
            shift *= 10


def triangle(fit: DataFrame, size: int, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred rows, composed of the triangles of all passes."""
    factors: list[np.ndarray] = []

    def step(x: np.ndarray) -> np.ndarray:
        rows = centred(x, n, sums)
        for factor in factors:
            rows = solved(rows, factor)
        return rows

    composed = np.eye(size)
    for _ in range(PASSES):
        squares = gram(fit, size, step)
        if not squares.any():
            return np.zeros((size, size))
        if np.abs(squares - np.eye(size)).max() < size * 1e-14:
            break
        # Tasks of the pass before have ended, so the list may grow.
        factors.append(shifted_cholesky(squares))
        composed = factors[-1] @ composed
    return composed


def fit_whitening(fit: DataFrame, size: int, components: int) -> Whitening | None:
    """The model of a table of distinct grid vectors ``x``; None where nothing varies."""
    n, sums = _sums(fit, size)
    if n < 2:
        return None
    r = triangle(fit, size, n, sums)
    _, singular, turned = np.linalg.svd(r)
    if not singular[0] > 0:
        return None
    some = int((singular > NOTHING * singular[0]).sum())
    axes = turned[: min(components, some)].T
    # One sign for good: the largest entry of a component is positive.
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    return Whitening(n, sums, axes, singular[: axes.shape[1]] ** 2 / n, float((singular**2).sum() / n))


def identity_error(fit: DataFrame, size: int, model: Whitening) -> float:
    """How far the covariance of the whitened fit list is from the identity."""
    covariance = gram(fit, size, lambda x: model.project(centred(x, model.n, model.sums))) / model.n
    return float(np.abs(covariance - np.eye(len(covariance))).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact squared distance from the mean, times n squared; None beyond 64 bits."""
    rough = (((x.astype(np.float64) - np.array(sums, np.float64) / n) * n) ** 2).sum(axis=1)
    if (rough < LONGS / 4).all() and max(map(abs, sums)) < LONGS / 4 and (np.abs(x) < LONGS / 4 / n).all():
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = (sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x.tolist())
    return [value if value <= LONGS else None for value in exact]


def fit_list(kept: DataFrame) -> tuple[DataFrame, int]:
    """Each distinct vector once, of the length that most of them have, and that length."""
    distinct = staged(kept.select("x").distinct(), "whitening-fit")
    most = distinct.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = most.size if most else 0
    return distinct.where(F.size("x") == size), size


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per vector and component: its deviation, whitened value and the share the component explains.

    ``vectors`` has ``vec_id`` and ``embedding``.  The fit reads the distinct
    vectors some five times; the vectors themselves are read twice.
    """
    kept = vectors.where(usable(F.col("embedding"))).select("vec_id", on_grid(F.col("embedding")).alias("x"))
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    fit, size = fit_list(kept)
    model = fit_whitening(fit, size, components) if size else None
    if model is None:
        return empty(vectors.sparkSession, schema)
    error = identity_error(fit, size, model)
    found = model.axes.shape[1]
    shares = model.variances / model.total

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = rows_of(batch.column("x"), size)
            each = np.repeat(np.arange(len(x)), found)
            deviation = pa.array(deviations(x, model.n, model.sums), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, found + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), model.n, np.int64)),
                    deviation.take(pa.array(each)),
                    pa.array(model.project(centred(x, model.n, model.sums)).ravel()),
                    pa.array(np.tile(shares, len(x))),
                    pa.array(np.full(len(each), error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return kept.where(F.size("x") == size).mapInArrow(projected, schema)
