"""Whitening of embeddings by an exact, bit-sliced scatter matrix.

A vector's entries become integers x = floor(64 * c) + 1,000,000. The covariance is fitted on each distinct
x-vector once. To multiply exactly, each dimension is shifted to its smallest value and cut into bit planes; a
plane packs one bit of 64 vectors into a word. The sum of products of two dimensions is the sum over pairs of
their planes of 2^(a + b) times the bits set in both planes (AND, then a population count). Tasks add up
counts by (pair of dimensions, a + b), so what leaves a task depends on dimensions and bits, not on rows.
The counts become Python integers on the driver, are centred as integers (n * sum(xy) - sum(x) * sum(y)) and
only then divided, for ``eigh``.

Rows whose vector is null, empty, or holds a null or an entry that is not finite are left out, and so are
vectors whose length differs from the most frequent one (of equally frequent ones the longest). Entries beyond
2^55 either way count as 2^55. Null and repeated ids are ordinary rows; equal vectors get equal results.
Extra columns are ignored. An empty table gives an empty result. Components without variance (beyond the rank
of the covariance, for example with fewer distinct vectors than dimensions) have a null ``whitened``; with no
variance at all ``explained`` is null too. ``deviation`` is null where it exceeds a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import checkpointed

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
# Bits that a task unpacks at once, a byte each.
BLOCK = 1 << 25
CELLS = "a int, b int, weight int, n long"


def integers(vector: Column) -> Column:
    """floor(64 * c) + 1,000,000 of each entry."""
    bound = F.lit(float(2**61))
    return F.transform(
        vector,
        lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, bound), -bound)) + F.lit(OFFSET).cast("long"),
    )


def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has the usual length and only finite entries, with the integers as ``x``."""

    def finite(c: Column) -> Column:
        value = c.cast("double")
        return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))

    clean = df.where(F.col(vector).isNotNull() & (F.size(vector) > 0)).where(F.forall(vector, finite))
    lengths = clean.groupBy(F.size(vector).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("size")).first()
    return clean.where(F.size(vector) == (usual["size"] if usual else 0)).withColumn("x", integers(F.col(vector)))


def matrix(column: pa.Array) -> np.ndarray:
    """A batch of equally long lists as rows of integers."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def bounds(distinct: DataFrame) -> tuple[list[int], list[int], int]:
    """Smallest and largest entry of each dimension, and the number of vectors."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        n = 0
        for batch in batches:
            x = matrix(batch.column(0))
            if len(x):
                n += len(x)
                low = x.min(0) if low is None else np.minimum(low, x.min(0))
                high = x.max(0) if high is None else np.maximum(high, x.max(0))
        if n:
            rows = [range(len(low)), low, high, [n] * len(low)]
            yield pa.record_batch([pa.array(r, pa.int64()) for r in rows], names=["d", "low", "high", "n"])

    found = distinct.select("x").mapInArrow(scan, "d long, low long, high long, n long")
    rows = found.groupBy("d").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).collect()
    rows.sort(key=lambda r: r["d"])
    return [r["low"] for r in rows], [r["high"] for r in rows], rows[0]["n"] if rows else 0


def packed(y: np.ndarray, bits: list[int]) -> np.ndarray:
    """Bit planes of non-negative integers, dimension by dimension from the lowest bit: (planes, words)."""
    planes = np.zeros((sum(bits), -(-len(y) // 64) * 64), np.uint8)
    row = 0
    for d, n in enumerate(bits):
        for a in range(n):
            planes[row, : len(y)] = (y[:, d] >> a) & 1
            row += 1
    return np.packbits(planes, axis=1).view(np.uint64)


def scatter_cells(distinct: DataFrame, low: list[int], bits: list[int]) -> DataFrame:
    """(a, b, weight, n): in how many vectors, counted by plane pairs of weight 2^weight, dimensions a <= b meet.

    Dimension -1 stands for a plane of ones, so its cells are plain sums.
    """
    dimension = np.array([d for d, n in enumerate(bits) for _ in range(n)], np.int64)
    place = np.array([a for n in bits for a in range(n)], np.int64)
    width, top = len(bits) + 1, max(bits, default=0)
    block = max(64, BLOCK // max(1, len(place)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.array(low, np.int64)
        counts = np.zeros((width, width, 2 * top + 1), np.int64)

        def add(rows: np.ndarray) -> None:
            planes = packed(rows - shift, bits)
            np.add.at(counts, (0, dimension + 1, place), np.bitwise_count(planes).sum(1, dtype=np.int64))
            for i in range(len(planes)):
                met = np.bitwise_count(planes[i:] & planes[i]).sum(1, dtype=np.int64)
                met[1:][dimension[i + 1 :] == dimension[i]] *= 2  # both orders of two planes of one dimension
                np.add.at(counts, (dimension[i] + 1, dimension[i:] + 1, place[i:] + place[i]), met)

        for batch in batches:
            x = matrix(batch.column(0))
            for at in range(0, len(x), block):
                add(x[at : at + block])
        a, b, weight = np.nonzero(counts)
        if len(a):
            columns = [a - 1, b - 1, weight]
            arrays = [pa.array(c, pa.int32()) for c in columns] + [pa.array(counts[a, b, weight], pa.int64())]
            yield pa.record_batch(arrays, names=["a", "b", "weight", "n"])

    cells = distinct.select("x").mapInArrow(scan, CELLS)
    return cells.groupBy("a", "b", "weight").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Whitening:
    """``n`` distinct vectors with sums ``sums`` (of x - low); ``axes`` are unit eigenvectors as columns."""

    n: int
    low: list[int]
    high: list[int]
    sums: list[int]
    values: np.ndarray
    axes: np.ndarray
    trace: float

    def known(self) -> np.ndarray:
        """Components with variance, by the usual bound on rounding errors."""
        largest = self.values[0] if len(self.values) else 0.0
        return self.values > max(largest, 0.0) * len(self.low) * np.finfo(float).eps

    def exact(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, as longs where they fit and as Python integers otherwise."""
        widest = max((h - l for l, h in zip(self.low, self.high)), default=0)
        kind = np.int64 if self.n * widest < 2**62 else object
        return self.n * (x - np.array(self.low, np.int64)).astype(kind) - np.array(self.sums, kind)

    def deviations(self, exact: np.ndarray) -> list[int | None]:
        """Sums of squares per row; None where one exceeds a long."""
        largest = max(self.n * (h - l) for l, h in zip(self.low, self.high))
        if largest * largest * len(self.low) < 2**63:
            return (exact * exact).sum(1).tolist()
        every = [sum(v * v for v in map(int, row)) for row in exact]
        return [v if v < 2**63 else None for v in every]

    def project(self, exact: np.ndarray) -> np.ndarray:
        """Whitened rows; NaN in components without variance."""
        centred = (exact / self.n).astype(np.float64)
        scale = np.where(self.known(), self.values, np.nan)
        return centred @ self.axes / np.sqrt(scale)


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a frame of distinct vectors ``x``; None if there are none."""
    low, high, n = bounds(distinct)
    if not n:
        return None
    bits = [(h - l).bit_length() for l, h in zip(low, high)]
    size = len(low)
    sums = [0] * size
    products = [[0] * size for _ in range(size)]
    for r in scatter_cells(distinct, low, bits).collect():  # bounded by dimensions and bits
        value = int(r["n"]) << r["weight"]
        if r["a"] < 0:
            sums[r["b"]] += value
        else:
            products[r["a"]][r["b"]] += value
    v = np.zeros((size, size))
    for a in range(size):
        for b in range(a, size):
            v[a, b] = v[b, a] = (n * products[a][b] - sums[a] * sums[b]) / (n * n)  # integers until here
    values, axes = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:components]
    return Whitening(n, low, high, sums, values[order], axes[:, order], float(np.trace(v)))


def identity_error(distinct: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, over the fit list."""
    known = np.flatnonzero(model.known())

    def totals(centre: np.ndarray | None) -> np.ndarray:
        """Sums by component, or of products of what is centred, as one array."""
        width = len(known)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(width if centre is None else width * width)
            for batch in batches:
                x = matrix(batch.column(0))
                if len(x):
                    w = model.project(model.exact(x))[:, known]
                    total += w.sum(0) if centre is None else ((w - centre).T @ (w - centre)).ravel()
            yield pa.record_batch([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["cell", "total"])

        sums = distinct.select("x").mapInArrow(scan, "cell int, total double").groupBy("cell").agg(F.sum("total").alias("total"))
        return np.array([r["total"] for r in sorted(sums.collect(), key=lambda r: r["cell"])]) / model.n

    if not len(known):
        return None
    covariance = totals(totals(None)).reshape(len(known), len(known))
    return float(np.abs(covariance - np.eye(len(known))).max())


SCHEMA = (
    "component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whiten(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each usable row and component."""
    rows = usable(df.select(vec_id, vector), vector).select(vec_id, "x")
    distinct = checkpointed(rows.select("x").distinct())
    model = fit(distinct, components)
    schema = f"{vec_id} {df.schema[vec_id].dataType.simpleString()}, {SCHEMA}"
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    error = identity_error(distinct, model)
    explained = [float(v / model.trace) if model.trace > 0 else None for v in model.values]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                exact = model.exact(matrix(part.column(1)))
                white = model.project(exact)
                k = white.shape[1]
                each = np.repeat(np.arange(part.num_rows), k)
                flat = white.ravel()
                yield pa.record_batch(
                    [
                        part.column(0).take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, k + 1), part.num_rows), pa.int32()),
                        pa.array(np.full(len(each), model.n), pa.int64()),
                        pa.array(model.deviations(exact), pa.int64()).take(pa.array(each)),
                        pa.array(flat, mask=np.isnan(flat)),
                        pa.array(explained * part.num_rows, pa.float64()),
                        pa.array([error] * len(each), pa.float64()),
                    ],
                    names=[vec_id, *(f.split()[0] for f in SCHEMA.split(", "))],
                )

    return rows.mapInArrow(project, schema)
