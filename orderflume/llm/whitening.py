"""Whitening of embeddings on their leading principal components.

A component c of a vector becomes the whole number floor(64 * c) + 1000000. Tasks add up exact sums per dimension, then the
covariance of what is left after subtracting the mean (only d x d partial sums leave a task). The driver holds that one
d x d matrix: Householder reflections make it tridiagonal, Sturm counts with bisection find the leading eigenvalues, and
inverse iteration with reorthogonalisation inside clusters of close eigenvalues finds the vectors, which are reflected
back. Components are broadcast (d x ``COMPONENTS`` numbers) and every vector is projected where it lies. A pass over the
projections measures how far their covariance is from the identity.

Defined results: rows whose vector is null or holds null or non-finite entries drop out; empty vectors have no component
and hence no row; a null vec_id is kept; repeated rows count as often as they come; vectors of different length are fits
of their own; a component whose eigenvalue is at most ``NOISE`` of the trace (constant or dependent dimensions) cannot be
scaled in double precision and is left out; entries whose whole number does not fit into 62 bits end with an error; a
deviation beyond a long is null in the digest (the operator gives it as decimal); an empty table gives none; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflume.llm.common import stage

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
NOISE = 2.0**-40
CLUSTER = 1e-3  # eigenvalues closer than this share of the norm are reorthogonalised
ROUNDS = 5
LIMIT = float(1 << 62)
FIELDS = "vec_id long, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"


def usable(vectors: DataFrame) -> DataFrame:
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.where(F.coalesce((F.size("embedding") > 0) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)))


def whole(column: pa.ListArray, width: int) -> np.ndarray:
    scaled = np.floor(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width) * SCALE)
    if not (np.abs(scaled) < LIMIT).all():
        raise ValueError("whitening: an entry times 64 does not fit into 62 bits")
    return scaled.astype(np.int64) + SHIFT


def sums(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sum of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, dtype=object)
        for batch in batches:
            if batch.num_rows:
                x = whole(batch.column("embedding"), width)
                safe = int(np.abs(x).max()) * len(x) < 1 << 62
                n, total = n + len(x), total + (x.sum(axis=0).astype(object) if safe else x.astype(object).sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0)), pa.array([n] * width, pa.int64())], ["dim", "total", "n"])

    found = rows.select("embedding").mapInArrow(run, "dim int, total decimal(38,0), n long").groupBy("dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
    by_dim = {r["dim"]: r for r in found}
    return int(by_dim[0]["n"]), [int(by_dim[i]["total"]) for i in range(width)]


class Centre:
    """The mean as a whole number and the rest of it, so that differences lose nothing."""

    def __init__(self, n: int, total: list[int]):
        self.n = n
        self.floor = np.array([t // n for t in total], dtype=np.int64)
        self.over = np.array([t % n for t in total], dtype=object)  # total - n * floor
        self.part = np.array([(t % n) / n for t in total])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floor).astype(np.float64) - self.part

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - total)^2, exact."""
        apart = x - self.floor
        most = self.n * (int(np.abs(apart).max(initial=0)) + 1)
        if most * most * x.shape[1] < 1 << 63:
            off = self.n * apart - self.over.astype(np.int64)
            return (off * off).sum(axis=1).tolist()
        off = self.n * apart.astype(object) - self.over
        return (off * off).sum(axis=1).tolist()


def second_moments(rows: DataFrame, width: int, features) -> np.ndarray:
    """Sum over all rows of the outer products of ``features`` (a function of a batch), added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                made = features(batch)
                total += made.T @ made
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "cells"])

    cells = rows.select("embedding").mapInArrow(run, "i int, cells array<double>").select("i", F.posexplode("cells").alias("j", "cell"))
    out = np.zeros((width, width))
    for r in cells.groupBy("i", "j").agg(F.sum("cell").alias("cell")).toLocalIterator():
        out[r["i"], r["j"]] = r["cell"]
    return (out + out.T) / 2


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the Householder vectors (each from its column's second entry on)."""
    a = matrix.copy()
    n, reflectors = len(a), []
    for k in range(n - 2):
        x = a[k + 1 :, k]
        norm = np.sqrt(x @ x)
        v = x.copy()
        if norm > 0 and np.abs(x[1:]).max() > 0:
            v[0] += np.copysign(norm, x[0])
            v /= np.sqrt(v @ v)
            p = a[k + 1 :, k + 1 :] @ v
            w = p - (v @ p) * v
            a[k + 1 :, k + 1 :] -= 2 * (np.outer(v, w) + np.outer(w, v))
            a[k + 1, k] = -np.copysign(norm, x[0])
        else:
            v[:] = 0
        reflectors.append(v)
    return np.diag(a).copy(), np.append(np.diag(a, -1), []).copy(), reflectors


def below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm count: how many eigenvalues are less than each point."""
    least = np.finfo(float).tiny * max(1.0, float((off * off).max(initial=0)))
    q = diagonal[0] - at
    count = (q < 0).astype(int)
    for d, e in zip(diagonal[1:], off):
        q = np.where(np.abs(q) < least, -least, q)
        q = d - at - e * e / q
        count += q < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k greatest, falling, each bisected down to neighbouring doubles."""
    n = len(diagonal)
    radius = np.append(np.abs(off), 0) + np.insert(np.abs(off), 0, 0)
    low, high = np.full(k, (diagonal - radius).min()), np.full(k, (diagonal + radius).max())
    slack = np.finfo(float).eps * n * max(abs(low[0]), abs(high[0])) + np.finfo(float).tiny
    low, high = low - slack, high + slack
    want = n - 1 - np.arange(k)  # as many eigenvalues are less than it
    while True:
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            return middle
        up = below(diagonal, off, middle) > want
        high, low = np.where(up, middle, high), np.where(up, low, middle)


def solve_shifted(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Column j solves (T - shifts[j]) x = right[:, j]: elimination with row exchanges, all columns at once."""
    n, k = right.shape
    tiny = np.finfo(float).eps * max(np.abs(diagonal).max(), np.abs(off).max(initial=0), np.finfo(float).tiny)
    u0, u1, u2, b = (np.zeros((n, k)) for _ in range(4))
    pivot, second, value = diagonal[0] - shifts, np.full(k, off[0] if n > 1 else 0.0), right[0].copy()
    for i in range(n - 1):
        below_, own = off[i], diagonal[i + 1] - shifts
        after = off[i + 1] if i + 2 < n else 0.0
        swap = np.abs(pivot) < np.abs(below_)
        p = np.where(swap, below_, np.where(np.abs(pivot) < tiny, tiny, pivot))
        factor = np.where(swap, pivot, below_) / p
        u0[i], u1[i], u2[i] = p, np.where(swap, own, second), np.where(swap, after, 0.0)
        b[i] = np.where(swap, right[i + 1], value)
        value = np.where(swap, value - factor * right[i + 1], right[i + 1] - factor * value)
        pivot = np.where(swap, second - factor * own, own - factor * second)
        second = np.where(swap, -factor * after, after)
    u0[n - 1], b[n - 1] = np.where(np.abs(pivot) < tiny, tiny, pivot), value
    x = np.zeros((n + 2, k))
    for i in range(n - 1, -1, -1):
        x[i] = (b[i] - u1[i] * x[i + 1] - u2[i] * x[i + 2]) / u0[i]
        most = np.abs(x[i:]).max(axis=0)
        large = np.where(most > 1e100, most, 1.0)  # only the direction counts
        x, b = x / large, b / large
    return x[:n]


def eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Inverse iteration on the tridiagonal matrix; close eigenvalues are kept orthogonal in every round."""
    n, k = len(diagonal), len(values)
    norm = max(np.abs(diagonal).max(), np.abs(off).max(initial=0), np.finfo(float).tiny)
    shifts = values.copy()
    for j in range(1, k):  # equal shifts would give equal vectors
        shifts[j] = min(shifts[j], shifts[j - 1] - 4 * np.finfo(float).eps * norm)
    x = np.random.default_rng(n).standard_normal((n, k))
    for _ in range(ROUNDS):
        x = solve_shifted(diagonal, off, shifts, x / np.abs(x).max(axis=0))
        x /= np.sqrt((x * x).sum(axis=0))
        first = 0
        for j in range(k):
            if j and values[j - 1] - values[j] > CLUSTER * norm:
                first = j
            for _ in range(2):
                x[:, j] -= x[:, first:j] @ (x[:, first:j].T @ x[:, j])
            x[:, j] /= np.sqrt(x[:, j] @ x[:, j])
    return x


def leading_components(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix, those above the noise."""
    n = len(covariance)
    scale = float(np.trace(covariance))
    if not scale > 0:
        return np.zeros(0), np.zeros((n, 0))
    diagonal, off, reflectors = tridiagonal(covariance / scale)
    values = leading_eigenvalues(diagonal, off, min(k, n))
    values = values[values > NOISE]
    x = eigenvectors(diagonal, off, values)
    for i in range(len(reflectors) - 1, -1, -1):
        v = reflectors[i]
        x[i + 1 :] -= 2 * np.outer(v, v @ x[i + 1 :])
    return values * scale, x


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector: its scaled projections on the leading components, what these explain, its deviation."""
    spark = vectors.sparkSession
    rows = stage(usable(vectors), "vectors")
    found = None
    for width in sorted(r["width"] for r in rows.groupBy(F.size("embedding").alias("width")).count().collect()):  # one as a rule
        own = rows.where(F.size("embedding") == width)
        centre = Centre(*sums(own, width))
        covariance = second_moments(own, width, lambda batch, w=width, c=centre: c.centred(whole(batch.column("embedding"), w))) / centre.n
        values, directions = leading_components(covariance, components)
        if not len(values):
            continue
        explained = values / np.trace(covariance)
        shared = spark.sparkContext.broadcast(directions / np.sqrt(values))

        def project(batch: pa.RecordBatch, w=width, c=centre, s=shared) -> np.ndarray:
            return c.centred(whole(batch.column("embedding"), w)) @ s.value

        with_one = second_moments(own, len(values) + 1, lambda batch, p=project: np.column_stack([p(batch), np.ones(batch.num_rows)])) / centre.n
        mean = with_one[-1, :-1]
        error = float(np.abs(with_one[:-1, :-1] - np.outer(mean, mean) - np.eye(len(values))).max())

        def run(batches: Iterator[pa.RecordBatch], w=width, c=centre, p=project, explained=explained, error=error) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                m = batch.num_rows
                if m:
                    made = p(batch)
                    starts = pa.array(np.arange(m + 1, dtype=np.int32) * made.shape[1])
                    cells = [pa.ListArray.from_arrays(starts, pa.array(x.ravel())) for x in (made, np.broadcast_to(explained, made.shape))]
                    deviation = pa.array([Decimal(x) for x in c.deviation(whole(batch.column("embedding"), w))], pa.decimal128(38, 0))
                    yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(np.full(m, c.n)), deviation, *cells, pa.array(np.full(m, error))], ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"])

        made = own.mapInArrow(run, FIELDS)
        found = made if found is None else found.unionByName(made)
    return spark.createDataFrame([], FIELDS) if found is None else found


def digest(white: DataFrame) -> DataFrame:
    rows = white.select("vec_id", "n", F.expr("try_cast(deviation as bigint)").alias("deviation"), "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "cell"))
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("cell.whitened").alias("whitened"), F.col("cell.explained").alias("explained"), "identity_error")
