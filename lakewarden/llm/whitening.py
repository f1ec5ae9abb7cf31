"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor.

Every entry c of a vector becomes the whole number x = floor(SCALE * c) + OFFSET. A first pass adds up
the x per dimension. A second one adds up the products of x minus the rounded mean; both sums are
whole numbers, so they are exact and do not depend on how rows are dealt out. What the rounded mean
leaves is taken off exactly, so the scatter around S/n is right to the last digit of a double. The
factor of its pivoted Cholesky decomposition (which stops where nothing but rounding is left) is
turned from the right, two columns at a time, until all columns are orthogonal: their squared norms
over n are the eigenvalues, the normalised columns the components. The driver holds matrices of
dimension x dimension; everything that grows with the table stays in the tasks.

Vectors that are null, empty or hold null or non-finite entries are left out, as are their rows in the
result. Repeated rows count each; ``vec_id`` is only carried along, null or not. An empty table, or
one whose vectors are all equal, has no component and gives no rows; with fewer directions than
``components`` there are as many rows per vector as directions. Vectors of different lengths, and
entries of 2**40 or more, end in an error. Components have the sign that makes their largest entry
positive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
LARGEST = 1 << 50          # of SCALE * c
EXACT = 1 << 53            # whole numbers below are exact as doubles
WHOLE = pa.decimal128(38, 0)


@dataclass
class Whitening:
    """What a fit gives: counts and sums of the vectors, and their leading components."""

    n: int
    sums: list[int]
    trace: float
    eigenvalues: np.ndarray  # falling
    components: np.ndarray   # one unit column per eigenvalue

    def leading(self, k: int) -> Whitening:
        return Whitening(self.n, self.sums, self.trace, self.eigenvalues[:k], self.components[:, :k])


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and entries (doubles) of the vectors that can be used."""
    bad = F.exists("entries", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                             F.col("embedding").cast("array<double>").alias("entries")) \
        .filter((F.size("entries") > 0) & ~bad)


def integers(entries: pa.Array) -> np.ndarray:
    """One row of whole numbers per vector."""
    length = pc.list_value_length(entries).to_numpy(zero_copy_only=False)
    if (length != length[0]).any():
        raise ValueError("vectors of different lengths")
    scaled = np.floor(SCALE * entries.flatten().to_numpy(zero_copy_only=False))
    if np.abs(scaled).max() >= LARGEST:
        raise ValueError("an entry is too large to become a whole number")
    return scaled.astype(np.int64).reshape(len(entries), -1) + OFFSET


def _whole(values) -> pa.Array:
    """Whole numbers of any size as decimals."""
    values = np.asarray(values)
    if values.dtype == np.int64:
        return pa.array(values).cast(WHOLE)
    return pa.array([Decimal(int(v)) for v in values], WHOLE)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n: dict[int, int] = {}
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        if batch.num_rows:
            x = integers(batch.column(0))
            d = x.shape[1]
            n[d] = n.get(d, 0) + len(x)
            total[d] = total.get(d, 0) + x.sum(axis=0).astype(object)  # Python's unbounded numbers
    for d in n:
        yield pa.RecordBatch.from_arrays(
            [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()),
             pa.array([n[d]] * d, pa.int64()), _whole(total[d])], ["length", "place", "n", "total"])


def products(u: np.ndarray) -> np.ndarray:
    """Exact ``u.T @ u``: blocks whose sums are exact as doubles, Python numbers where none is."""
    top = int(np.abs(u).max(initial=1))
    rows = EXACT // max(top * top, 1)
    if not rows:
        return u.T.astype(object) @ u.astype(object)
    out = 0
    for low in range(0, len(u), rows):
        block = u[low:low + rows].astype(np.float64)
        out = out + (block.T @ block).astype(np.int64).astype(object)
    return out


def _scatters(centre):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                new = products(integers(batch.column(0)) - np.array(centre.value, np.int64))
                total = new if total is None else total + new
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), _whole(total[i, j])],
                ["i", "j", "total"])
    return run


def triangular(scatter: np.ndarray) -> np.ndarray:
    """Factor A with ``A @ A.T == scatter``; its columns come in the order of the pivots, so its rows,
    taken in that order, are lower triangular. It has as many columns as directions that are not
    rounding."""
    d = len(scatter)
    factor, left = np.zeros((d, d)), scatter.diagonal().copy()
    floor = d * np.finfo(float).eps * max(left.max(initial=0.0), 0.0)
    done = np.zeros(d, bool)
    for k in range(d):
        pivot = int(np.argmax(np.where(done, -1.0, left)))
        if done[pivot] or left[pivot] <= floor:
            return factor[:, :k]
        root = np.sqrt(left[pivot])
        column = (scatter[:, pivot] - factor[:, :k] @ factor[pivot, :k]) / root
        column[done] = 0.0
        column[pivot] = root
        factor[:, k] = column
        left = left - column * column
        done[pivot] = True
    return factor


def _pairings(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rounds of disjoint pairs in which every two of n columns meet once."""
    ring = list(range(n + n % 2))
    out = []
    for _ in range(len(ring) - 1):
        half = len(ring) // 2
        pairs = [(a, b) for a, b in zip(ring[:half], reversed(ring[half:])) if max(a, b) < n]
        if pairs:
            out.append((np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out


def orthogonal_columns(factor: np.ndarray, sweeps: int = 40) -> np.ndarray:
    """``factor`` turned from the right until its columns are orthogonal; ``A @ A.T`` stays."""
    a = factor.copy()
    small = np.finfo(float).eps * np.sqrt(max(len(a), 1))
    rounds = _pairings(a.shape[1])
    for _ in range(sweeps):
        turned = False
        for p, q in rounds:
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            turn = np.abs(xy) > small * np.sqrt(xx * yy)
            if not turn.any():
                continue
            turned = True
            half = np.where(turn, (yy - xx) / np.where(turn, 2 * xy, 1.0), 0.0)
            tangent = np.where(half < 0, -1.0, 1.0) / (np.abs(half) + np.hypot(1.0, half))
            tangent = np.where(turn, tangent, 0.0)
            cosine = 1 / np.hypot(1.0, tangent)
            sine = cosine * tangent
            a[:, p], a[:, q] = cosine * x - sine * y, sine * x + cosine * y
        if not turned:
            break
    return a


def fit(embeddings: DataFrame) -> Whitening | None:
    """Counts, sums, eigenvalues and components of all usable vectors; None if there are none."""
    vectors = usable(embeddings).select("entries")
    context = embeddings.sparkSession.sparkContext
    found = vectors.mapInArrow(_totals, "length int, place int, n long, total decimal(38,0)") \
        .groupBy("length", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    if not found:
        return None
    if len({r["length"] for r in found}) > 1:
        raise ValueError(f"vectors of different lengths: {sorted({r['length'] for r in found})}")
    d, n = len(found), found[0]["n"]
    sums = [0] * d
    for r in found:
        sums[r["place"]] = int(r["total"])
    centre = [(2 * s + n) // (2 * n) for s in sums]
    cells = vectors.mapInArrow(_scatters(context.broadcast(centre)), "i int, j int, total decimal(38,0)") \
        .groupBy("i", "j").agg(F.sum("total").alias("total")).collect()  # d * (d + 1) / 2 rows
    rest = [s - n * c for s, c in zip(sums, centre)]
    scatter, trace = np.zeros((d, d)), 0
    for r in cells:
        exact = n * int(r["total"]) - rest[r["i"]] * rest[r["j"]]
        scatter[r["i"], r["j"]] = scatter[r["j"], r["i"]] = exact / n
        trace += exact if r["i"] == r["j"] else 0
    columns = orthogonal_columns(triangular(scatter))
    norms = np.sqrt((columns * columns).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    components = columns[:, order] / norms[order]
    largest = np.argmax(np.abs(components), axis=0)
    components = components * np.sign(components[largest, np.arange(len(order))])
    return Whitening(n, sums, trace / (n * n), norms[order] ** 2 / n, components)


def _apart(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """n * x - S of every entry, exact, and the whitened rows."""
    wide = model.n * (int(np.abs(x).max(initial=0)) + 1) >= 1 << 62
    apart = (x.astype(object) if wide else x) * model.n - np.array(model.sums, object if wide else np.int64)
    centred = (apart / model.n).astype(np.float64)
    return apart, centred @ model.components / np.sqrt(model.eigenvalues)


def deviation(apart: np.ndarray) -> np.ndarray:
    """Exact sum of squares per row."""
    top = int(np.abs(apart).max(initial=0))
    if top * top * max(apart.shape[1], 1) >= 1 << 63:
        apart = apart.astype(object)
    return (apart * apart).sum(axis=1)


def _moments(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = model.value.components.shape[1]
        mean, square = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                w = _apart(integers(batch.column(0)), model.value)[1]
                mean, square = mean + w.sum(axis=0), square + w.T @ w
        i, j = np.indices((k, k)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((i, np.full(k, -1))).astype(np.int32)),
             pa.array(np.concatenate((j, np.arange(k))).astype(np.int32)),
             pa.array(np.concatenate((square.ravel(), mean)))], ["i", "j", "total"])
    return run


def identity_error(embeddings: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity, measured on
    the rows. They are centred already; what rounding leaves of their mean is taken off."""
    k = model.components.shape[1]
    sent = embeddings.sparkSession.sparkContext.broadcast(model)
    cells = usable(embeddings).select("entries") \
        .mapInArrow(_moments(sent), "i int, j int, total double") \
        .groupBy("i", "j").agg(F.sum(F.col("total").cast("decimal(38,12)")).alias("total")).collect()
    square, mean = np.zeros((k, k)), np.zeros(k)
    for r in cells:
        if r["i"] < 0:
            mean[r["j"]] = float(r["total"]) / model.n
        else:
            square[r["i"], r["j"]] = float(r["total"]) / model.n
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())


def _rows(model, error: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = model.value
        k = fitted.components.shape[1]
        for batch in batches:
            if not batch.num_rows:
                continue
            apart, w = _apart(integers(batch.column(1)), fitted)
            n = len(w)
            each = pa.array(np.repeat(np.arange(n), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                 pa.array(np.full(n * k, fitted.n)), _whole(deviation(apart)).take(each),
                 pa.array(w.ravel()), pa.array(np.tile(fitted.eigenvalues / fitted.trace, n)),
                 pa.array(np.full(n * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


ROW = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double,"
       " identity_error double")


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: see ROW."""
    spark = embeddings.sparkSession
    model = fit(embeddings)
    if model is None or not len(model.eigenvalues):
        return spark.createDataFrame([], ROW)
    model = model.leading(components)
    error = identity_error(embeddings, model)
    return usable(embeddings).mapInArrow(_rows(spark.sparkContext.broadcast(model), error), ROW)
