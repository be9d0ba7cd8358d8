"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse.session import cut

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
#: Entries from here on have no grid value; their vectors are left out like those with non-finite entries.
LARGEST = 2.0**40
#: Norms below this share of the matrix' norm are rounding; singular values below RANK of the largest are zero.
ROUNDING, RANK = 1e-13, 1e-10


def on_grid(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, x): floor(64 c) + 1,000,000 of each usable vector's entries, as longs.

    Null vectors, those with null, non-finite or larger than LARGEST entries, empty ones, and those of another length than
    most usable vectors (of equally frequent lengths the greater) are left out.
    """
    wide = rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= LARGEST))
    wide = wide.filter(F.col("v").isNotNull() & ~bad & (F.size("v") > 0))
    longs = cut(wide.select("id", F.transform("v", lambda c: F.floor(c * float(SCALE)).cast("long") + SHIFT).alias("x")), "whitening-grid")
    most = longs.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return longs.filter(F.size("x") == (most["d"] if most else 0))


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _added(rows: DataFrame, d: int, kind: str, work: Callable[[np.ndarray], np.ndarray]) -> list:
    """The sum of ``work(matrix of a batch)`` over all rows, by position. A task hands on one total; Spark adds those up, so
    the driver gets one number per position whatever the number of tasks."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = work(_matrix(batch, d))
                total = part if total is None else total + part
        if total is not None:
            values = [Decimal(int(v)) for v in total] if kind != "double" else total
            yield pa.record_batch([pa.array([values], pa.list_(pa.decimal128(38, 0) if kind != "double" else pa.float64()))], ["v"])

    parts = rows.select("x").mapInArrow(task, f"v array<{kind}>").select(F.posexplode("v").alias("pos", "v"))
    found = parts.groupBy("pos").agg(F.sum("v").alias("v")).collect()
    return [r["v"] for r in sorted(found, key=lambda r: r["pos"])]


@dataclass(frozen=True)
class Centre:
    """The exact mean S / n: a whole part per dimension, and ``rest`` = S - n * base, less than n."""

    n: int
    base: np.ndarray
    rest: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n. The whole parts cancel exactly, so rounding is relative to the deviation and not to x."""
        return (x - self.base) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2 per row, exact; None where it doesn't fit a long."""
        y = x - self.base
        bound = (int(np.abs(y).max(initial=0)) + 1) * self.n
        if bound * bound * x.shape[1] < 2**63:
            return ((y * self.n - self.rest) ** 2).sum(1).tolist()
        sums = ((y.astype(object) * self.n - self.rest.astype(object)) ** 2).sum(1)
        return [int(s) if s < 2**63 else None for s in sums]


def centre(grid: DataFrame) -> Centre | None:
    """Exact count and sums; None without any vector."""
    first = grid.select(F.size("x")).first()
    if first is None:
        return None

    def count_and_sums(x: np.ndarray) -> np.ndarray:
        return np.array([len(x), *(int(s) for s in x.sum(0))], dtype=object)

    n, *sums = (int(v) for v in _added(grid, first[0], "decimal(38,0)", count_and_sums))
    base = [s // n for s in sums]
    return Centre(n, np.array(base, np.int64), np.array([s - n * b for s, b in zip(sums, base)], np.int64))


def bidiagonalise(product: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, float]], d: int, norm: float) -> tuple[np.ndarray, np.ndarray]:
    """(V, B) with X V = U B, V orthogonal and B upper bidiagonal.

    ``product(W, q)`` gives, for the rows' p = X q and the earlier left vectors U = X W: Uᵀp, Xᵀp and p·p. A left vector has a
    number per row, so it is never stored: it is kept by the d coefficients whose product with the rows it is. Each step
    is one product with X, then one with Xᵀ; both sides are orthogonalised against all earlier vectors, a left one
    again by another pass when it lost much in the first. Where a direction is exhausted (equal singular values, rank
    below d) the next right vector is a new one orthogonal to all earlier ones, so all d directions are found.
    """
    random = np.random.default_rng(d)
    least = ROUNDING * norm
    right, left, images = (np.zeros((d, 0)) for _ in range(3))
    alphas, betas = [], []
    v, q = None, None
    for _ in range(d):
        if v is None:
            v = random.standard_normal(d)
            for _ in range(3):
                v -= right @ (right.T @ v)
                v /= np.linalg.norm(v)
            q = v.copy()
        for _ in range(3):
            overlap, z, square = product(left, q)
            q, z, kept = q - left @ overlap, z - images @ overlap, square - overlap @ overlap
            if kept > 0.5 * square or square <= least**2:
                break
        alpha = np.sqrt(kept) if kept > least**2 else 0.0
        w, y = (q / alpha, z / alpha) if alpha else (np.zeros(d), np.zeros(d))
        right, left, images = np.c_[right, v], np.c_[left, w], np.c_[images, y]
        r = y - alpha * v
        for _ in range(2):
            r -= right @ (right.T @ r)
        beta = np.linalg.norm(r)
        alphas.append(alpha)
        if beta > least:
            betas.append(beta)
            v = r / beta
            q = v - beta * w
        else:
            betas.append(0.0)
            v = None
    return right, np.diag(alphas) + np.diag(betas[:-1], 1)


@dataclass(frozen=True)
class Whitener:
    """Centre, unit components as columns, their deviations (square roots of eigenvalues) and shares of the variance."""

    centre: Centre
    components: np.ndarray
    deviations: np.ndarray
    explained: np.ndarray

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.components / self.deviations

    def transform(self, grid: DataFrame) -> DataFrame:
        """(id, deviation, whitened) of the grid's rows; ``whitened`` has one entry per component."""
        kind = next(f.dataType.simpleString() for f in grid.schema if f.name == "id")
        d, keep = len(self.centre.base), self

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch, d)
                whole = pa.array(list(keep.whiten(x)), pa.list_(pa.float64()))
                yield pa.record_batch([batch.column("id"), pa.array(keep.centre.deviation(x), pa.int64()), whole], ["id", "deviation", "whitened"])

        return grid.select("id", "x").mapInArrow(task, f"id {kind}, deviation long, whitened array<double>")

    def identity_error(self, grid: DataFrame) -> float:
        """Largest absolute entry of the whitened rows' covariance minus the identity, by a pass over all rows."""
        k, n, keep = len(self.deviations), self.centre.n, self

        def moments(x: np.ndarray) -> np.ndarray:
            t = keep.whiten(x)
            return np.r_[t.sum(0), (t.T @ t).ravel()]

        sums = np.array(_added(grid, len(self.centre.base), "double", moments))
        mean, square = sums[:k] / n, sums[k:].reshape(k, k) / n
        return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())


def fit(grid: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Components of the covariance (divisor n) of all rows of ``grid`` by falling eigenvalue; None without any vector.

    The rows are read d + 2 times, d being their length: a step of the bidiagonalisation is one pass in which every
    task multiplies its rows with a vector and their result with the rows. A flat spectrum needs all d steps. The driver
    holds matrices of d x d. Directions without variance are no components.
    """
    middle = centre(grid)
    if middle is None:
        return None
    d = len(middle.base)

    def square_sum(x: np.ndarray) -> np.ndarray:
        return np.array([(middle.centred(x) ** 2).sum()])

    total = _added(grid, d, "double", square_sum)[0]
    if total <= 0:
        return Whitener(middle, np.zeros((d, 0)), np.zeros(0), np.zeros(0))

    def product(left: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        k, both = left.shape[1], np.c_[left, q]

        def step(x: np.ndarray) -> np.ndarray:
            rows = middle.centred(x)
            images = rows @ both
            p = images[:, k]
            return np.r_[images[:, :k].T @ p, rows.T @ p, p @ p]

        sums = np.array(_added(grid, d, "double", step))
        return sums[:k], sums[k:k + d], float(sums[-1])

    right, band = bidiagonalise(product, d, float(np.sqrt(total)))
    _, values, turned = np.linalg.svd(band)
    kept = min(components, int((values > RANK * values[0]).sum()))
    return Whitener(middle, (right @ turned.T)[:, :kept], values[:kept] / np.sqrt(middle.n), values[:kept] ** 2 / total)


def whiten_embeddings(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per usable vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    Usable are vectors as ``on_grid`` says. Repeated rows count and are returned as often as they stand there; a null
    identifier stays null. Of fewer directions with variance than ``components`` only those are returned; one vector
    alone, or copies of one, have none, so they give no rows, like an empty table. Equal eigenvalues give any orthogonal
    components of their space. ``deviation`` is null where it doesn't fit a long. Other columns are not read.
    """
    grid = on_grid(rows, id_col, vec_col)
    model = fit(grid, components)
    kind = next(f.dataType.simpleString() for f in grid.schema if f.name == "id")
    if model is None or not len(model.deviations):
        return rows.sparkSession.createDataFrame([], f"{id_col} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    each = model.transform(grid).select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*[F.lit(float(s)) for s in model.explained])
    return each.select(
        F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(model.centre.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(model.identity_error(grid)).alias("identity_error"),
    )
