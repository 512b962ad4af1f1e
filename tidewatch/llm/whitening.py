"""Embedding whitening with refined eigenvectors (operator 13)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import map_arrow, table
from tidewatch.llm.eigen import LONG, eigen

#: Entries from here on would leave the whole numbers that sums hold exactly.
LARGEST = float(1 << 36)

SUMS = "length int, i int, j int, n long, total decimal(38,0)"
PRODUCTS = "length int, i int, j int, total double"
WHITE = (
    "vec_id long, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
)


@dataclass(frozen=True)
class Grid:
    """Entry c becomes the whole number floor(scale * c) + offset."""

    scale: int = 1024
    offset: int = 100_000


@dataclass
class Fit:
    """Of the vectors of one length: their number, whole centre, what the sums exceed
    ``n`` times the centre by, and directions divided by their deviations."""

    n: int
    centre: np.ndarray
    rest: np.ndarray
    axes: np.ndarray | None = None
    explained: list[float | None] | None = None
    error: float | None = None

    def white(self, apart: np.ndarray) -> np.ndarray:
        return (apart - self.rest / self.n) @ self.axes


def _matrices(grid: Grid, batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of each length: which rows, and their whole numbers as doubles."""
    vectors = batch.column("vector")
    lengths = np.asarray(vectors.value_lengths())
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        values = np.asarray(vectors.take(pa.array(rows)).flatten(), np.float64).reshape(len(rows), length)
        yield int(length), rows, np.floor(grid.scale * values) + grid.offset


def _exact_products(a: np.ndarray) -> np.ndarray:
    """``a.T @ a`` of whole numbers, without rounding."""
    if not len(a) or np.abs(a).max(initial=0) ** 2 * len(a) < 2.0**53:
        return (a.T @ a).astype(object)
    whole = a.astype(np.int64).astype(object)
    return whole.T @ whole


def _decimals(values) -> pa.Array:
    return pa.array([int(v) for v in values], pa.decimal128(38, 0))


def _sum(grid: Grid, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and sums of a task's vectors: place i = j."""
    sums: dict[int, list] = {}
    for batch in batches:
        for length, rows, x in _matrices(grid, batch):
            own = sums.setdefault(length, [0, np.zeros(length, object)])
            own[0] += len(rows)
            own[1] = own[1] + x.astype(np.int64).sum(axis=0).astype(object)
    for length, (n, total) in sums.items():
        place = pa.array(np.arange(length), pa.int32())
        same = pa.array([length] * length, pa.int32())
        counts = pa.array([n] * length, pa.int64())
        yield pa.RecordBatch.from_arrays([same, place, place, counts, _decimals(total)], SUMS_NAMES)


SUMS_NAMES = ["length", "i", "j", "n", "total"]


def _products(grid: Grid, fits: dict[int, Fit], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact products of a task's vectors, less the whole centre: places i <= j."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for length, _, x in _matrices(grid, batch):
            sums[length] = sums.get(length, 0) + _exact_products(x - fits[length].centre)
    for length, total in sums.items():
        i, j = np.triu_indices(length)
        same = pa.array([length] * len(i), pa.int32())
        counts = pa.array([0] * len(i), pa.int64())
        columns = [same, pa.array(i, pa.int32()), pa.array(j, pa.int32()), counts, _decimals(total[i, j])]
        yield pa.RecordBatch.from_arrays(columns, SUMS_NAMES)


def _white_products(grid: Grid, fits: dict[int, Fit], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for length, _, x in _matrices(grid, batch):
            white = fits[length].white(x - fits[length].centre)
            sums[length] = sums.get(length, 0) + white.T @ white
    for length, total in sums.items():
        i, j = np.triu_indices(len(total))
        same = pa.array([length] * len(i), pa.int32())
        columns = [same, pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j], pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, ["length", "i", "j", "total"])


def _transform(grid: Grid, fits: dict[int, Fit], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for length, rows, x in _matrices(grid, batch):
            fit = fits[length]
            apart = x - fit.centre
            n, whole, rest = fit.n, apart.astype(np.int64), fit.rest.astype(object)
            if np.abs(whole).max(initial=0) < 1 << 24 and length < 1 << 14:
                squares = (whole * whole).sum(axis=1).astype(object)
            else:
                squares = (whole.astype(object) ** 2).sum(axis=1) if length else np.zeros(len(rows), object)
            cross = whole.astype(object) @ rest if length else squares
            away = n * n * squares - 2 * n * cross + int((rest * rest).sum())
            away = pa.array([int(v) if v < 10**38 else None for v in away], pa.decimal128(38, 0))
            white = fit.white(apart).astype(object)
            known = [k for k, share in enumerate(fit.explained) if share is not None]
            full = np.full((len(rows), len(fit.explained)), None, object)
            full[:, known] = white
            kind = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(rows)),
                    pa.array([n] * len(rows), pa.int64()),
                    away,
                    pa.array(full.tolist(), kind),
                    pa.array([[share or 0.0 for share in fit.explained]] * len(rows), kind),
                    pa.array([fit.error] * len(rows), pa.float64()),
                ],
                ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"],
            )


def _grid_of(rows, length: int) -> np.ndarray:
    out = np.zeros((length, length), object)
    for r in rows:
        out[r.i, r.j] = out[r.j, r.i] = r.total
    return out


def whiten(vectors: DataFrame, components: int | None = 8, grid: Grid = Grid()) -> DataFrame:
    """Whitened coordinates of each row of ``vectors`` (vec_id, embedding).

    Returns vec_id, n, deviation (the exact sum over dimensions of
    (n x - S) squared), whitened (up to ``components`` values, largest variance
    first; all if None), explained (their shares of the variance) and
    identity_error (the largest entry of the whitened values' covariance less
    the identity, from the values themselves).

    Entries become whole numbers x on ``grid``. A first pass sums them, a second
    their products around the whole centre next to the mean; the products are
    exact and the fraction that the centre leaves is taken off exactly, so the covariance
    does not depend on the order of addition. Each task sends one row a pair of
    dimensions; the driver holds one matrix of the vectors' length squared (some
    thousands at most). Its eigenvectors are refined from single precision to
    more than double (``eigen``). Divisor of every covariance: n.

    Rows whose vector is null or holds a null, a number that is not finite, or one of 2**36 or
    more are dropped. Vectors of each length have a fit of their own. A direction
    without variance (below the rounding of the largest) has a share of 0 and null
    as value; if all are, identity_error is null. A deviation beyond 38 digits is null.
    Repeated rows count each; null ids stay null. An empty table gives an
    empty result. Other columns are not read.
    """
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST))
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vector").isNotNull() & sound)
    numbers = rows.select("vector")
    by_place = lambda df, what: df.groupBy("length", "i", "j").agg(*what).collect()

    fits: dict[int, Fit] = {}
    sums = by_place(map_arrow(numbers, partial(_sum, grid), SUMS), [F.sum("n").alias("n"), F.sum("total").alias("total")])
    for length in {r.length for r in sums}:
        own = sorted((r for r in sums if r.length == length), key=lambda r: r.i)
        n, total = own[0].n, [int(r.total) for r in own]
        centre = [(2 * t + n) // (2 * n) for t in total]
        fits[length] = Fit(n, np.array(centre, float), np.array([t - n * c for t, c in zip(total, centre)], float))
    if 0 not in fits:  # empty vectors leave no sums
        fits[0] = Fit(numbers.where(F.size("vector") == 0).count(), np.zeros(0), np.zeros(0))

    products = by_place(map_arrow(numbers, partial(_products, grid, fits), SUMS), [F.sum("total").alias("total")])
    for length, fit in fits.items():
        places = _grid_of((r for r in products if r.length == length), length)
        rest = [int(r) for r in fit.rest]
        exact = [[fit.n * int(places[i, j]) - rest[i] * rest[j] for j in range(length)] for i in range(length)]
        square = LONG(fit.n) * LONG(fit.n) if fit.n else LONG(1)
        covariance = np.array([[LONG(v) for v in row] for row in exact], LONG).reshape(length, length) / square
        values, axes = eigen(covariance)
        kept = min(length, length if components is None else components)
        floor = length * np.finfo(float).eps * values.max(initial=LONG(0))
        live = [k for k in range(kept) if values[k] > floor]
        fit.axes = (axes[:, live] / np.sqrt(values[live])).astype(float)
        trace = np.trace(covariance)
        fit.explained = [float(values[k] / trace) if k in live else None for k in range(kept)]

    exact = F.sum(F.col("total").cast("decimal(38,15)")).alias("total")  # whatever the order of addition
    again = by_place(map_arrow(numbers, partial(_white_products, grid, fits), PRODUCTS), [exact])
    for length, fit in fits.items():
        off = [abs(float(r.total) / fit.n - (r.i == r.j)) for r in again if r.length == length]
        fit.error = max(off, default=None)
    return map_arrow(rows, partial(_transform, grid, fits), WHITE)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whiten(table(spark, sf_dir, "embeddings"))
    each = white.select(
        "vec_id",
        "n",
        F.expr("try_cast(deviation AS BIGINT)").alias("deviation"),
        "identity_error",
        F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "value"),
    )
    return each.select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        F.col("value.whitened").alias("whitened"),
        F.col("value.explained").alias("explained"),
        "identity_error",
    )
