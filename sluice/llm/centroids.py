"""Centroid clustering over a VA-file (operator 13).

Vectors are kept as integers ``floor(64 x)``. Beside each vector lies its approximation: for every
dimension the number of one of :data:`CELLS` cells, in few bits. Cell edges follow the mean and
spread of the dimension over all vectors, so that cells hold about as many values each; least and
greatest values close the outer cells. A pass over the table looks up, for each centroid, the
least and greatest squared difference of every cell of every dimension. The sums over a vector's
cells are an interval that holds its exact distance. A centroid whose interval begins above
the lowest upper end cannot be the nearest. Where one centroid is left, it is the nearest, and no
component is compared; where intervals overlap, the vector itself is fetched and its distances
to the centroids still possible are computed exactly, in 64-bit integers.

Cells and vector are columns of one stored row, so a fetch is a local read without a join. A pass
is one task function over the stored table; what leaves a task is one row of counts and sums per
centroid. Only centroids and those sums, ``k`` rows, reach the driver. The result does not depend
on partitions, since every sum is one of integers.

Defined cases: vectors that are NULL, of another length, or hold a NULL or non-finite component
are left out, and so have no row. Repeated rows are vectors each. A row with a NULL ``vec_id`` is
clustered but starts no centroid. Equal hashes (repeated ids) are ordered by their components.
With fewer vectors than centroids there are fewer centroids; an empty table, or one in which no
row has an id, gives no rows. A component beyond ``2**20`` would not leave its squared distances
in a long: it stops the job with an error that says so.
"""

from __future__ import annotations

import hashlib
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.frames import numbered, position, store

DIMENSIONS = 64
CENTROIDS = 16
ROUNDS = 3
SCALE = 64
CELLS = 16
LARGEST = 1 << 26
CHUNK = 4096


def integer_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``vec_id long, v array<int>`` of the vectors that take part."""
    plain = numbered(vectors)
    x = F.col(f"c{position(vectors, 'embedding')}").cast("array<double>")
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    whole = lambda c: F.floor(F.when(F.abs(c) <= LARGEST / scale, scale * c)
                              .otherwise(F.raise_error(F.lit(f"a component beyond {LARGEST // scale}: its squared distances do not fit a long")).cast("double")))
    return (plain.select(F.col(f"c{position(vectors, 'vec_id')}").cast("long").alias("vec_id"), x.alias("x"))
            .where((F.size("x") == dimensions) & F.coalesce(F.forall("x", fine), F.lit(False)))
            .select("vec_id", F.transform("x", whole).cast("array<int>").alias("v")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


class Cells:
    """Cell edges of every dimension, and what follows from them for a set of centroids."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, least: np.ndarray, greatest: np.ndarray, cells: int = CELLS):
        steps = np.array([NormalDist().inv_cdf(j / cells) for j in range(1, cells)])
        self.edges = np.ceil(mean[:, None] + spread[:, None] * steps).astype(np.int64)
        self.low = np.concatenate([least[:, None], np.maximum(self.edges, least[:, None])], axis=1)
        self.high = np.concatenate([np.minimum(self.edges - 1, greatest[:, None]), greatest[:, None]], axis=1)
        # a cell that holds no value at all is never looked up
        self.high = np.maximum(self.low, self.high)

    def number(self, v: np.ndarray) -> np.ndarray:
        """The cell of every component, one byte each."""
        out = np.empty(v.shape, np.uint8)
        for d, edges in enumerate(self.edges):
            out[:, d] = np.searchsorted(edges, v[:, d], side="right")
        return out

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest squared difference, by dimension, cell and centroid."""
        c = centroids.T[:, None, :]
        below, above = self.low[:, :, None] - c, c - self.high[:, :, None]
        outside = np.maximum(np.maximum(below, above), 0)
        return outside * outside, np.maximum(below * below, above * above)


def pack(cells: np.ndarray) -> np.ndarray:
    """Two four-bit cells a byte."""
    return (cells[:, 0::2] << 4) | cells[:, 1::2]


def unpack(data: np.ndarray) -> np.ndarray:
    out = np.empty((len(data), 2 * data.shape[1]), np.uint8)
    out[:, 0::2], out[:, 1::2] = data >> 4, data & 15
    return out


def nearest(cells: np.ndarray, v: np.ndarray, tables: tuple[np.ndarray, np.ndarray], centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of every row (ties: the smaller number), and which rows were fetched."""
    low = np.zeros((len(cells), len(centroids)), np.int64)
    high = np.zeros_like(low)
    for d in range(cells.shape[1]):
        low += tables[0][d][cells[:, d]]
        high += tables[1][d][cells[:, d]]
    possible = low <= high.min(axis=1, keepdims=True)
    nearest_ = possible.argmax(axis=1)
    fetched = possible.sum(axis=1) > 1
    row, k = np.nonzero(possible[fetched])
    gap = v[fetched][row].astype(np.int64) - centroids[k]
    exact = np.full((int(fetched.sum()), len(centroids)), np.iinfo(np.int64).max)
    exact[row, k] = (gap * gap).sum(axis=1)
    nearest_[fetched] = exact.argmin(axis=1)
    return nearest_, fetched


def _measure(dimensions: int):
    """Per task: what the cell edges need to know of every dimension."""

    def run(batches):
        n, total, squares, least, greatest = 0, 0, 0.0, None, None
        for batch in batches:
            v = _matrix(batch.column(0), dimensions)
            if len(v):
                n, total, squares = n + len(v), total + v.sum(axis=0, dtype=np.int64), squares + (v.astype(float) ** 2).sum(axis=0)
                least = v.min(axis=0) if least is None else np.minimum(least, v.min(axis=0))
                greatest = v.max(axis=0) if greatest is None else np.maximum(greatest, v.max(axis=0))
        if n:
            yield pa.RecordBatch.from_pydict({
                "d": pa.array(range(dimensions), pa.int32()), "n": pa.array([n] * dimensions, pa.int64()), "total": pa.array(total, pa.int64()),
                "squares": pa.array(squares, pa.float64()), "least": pa.array(least, pa.int64()), "greatest": pa.array(greatest, pa.int64())})

    return run


def _cells_of(rows: DataFrame, dimensions: int) -> Cells | None:
    seen = rows.select("v").mapInArrow(_measure(dimensions), "d int, n long, total long, squares double, least long, greatest long")
    by = seen.groupBy("d").agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")], F.min("least").alias("least"),
                               F.max("greatest").alias("greatest")).orderBy("d").collect()  # one row a dimension
    if not by:
        return None
    mean = np.array([r.total / r.n for r in by])
    spread = np.sqrt(np.maximum(np.array([r.squares / r.n for r in by]) - mean**2, 0))
    return Cells(mean, spread, np.array([r.least for r in by]), np.array([r.greatest for r in by]))


def _sums(cells: Cells, centroids: np.ndarray):
    """Per task: how many vectors each centroid gets, and the sums of their components."""

    def run(batches):
        tables = cells.tables(centroids)
        count, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            for at in range(0, len(batch), CHUNK):
                near, v = _near(batch.slice(at, CHUNK), cells, tables, centroids)
                order = np.argsort(near, kind="stable")
                first = np.flatnonzero(np.diff(near[order], prepend=-1))
                which = near[order][first]
                count[which] += np.diff(first, append=len(near))
                total[which] += np.add.reduceat(v[order].astype(np.int64), first, axis=0)
        if count.any():
            yield pa.RecordBatch.from_pydict({"cluster": pa.array(np.flatnonzero(count), pa.int32()), "n": pa.array(count[count > 0]),
                                              "total": pa.array(list(total[count > 0]), pa.list_(pa.int64()))})

    return run


def _near(batch: pa.RecordBatch, cells: Cells, tables, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroids and vectors of a batch with the columns ``..., cells, v``."""
    width = centroids.shape[1]
    v = _matrix(batch.column(batch.num_columns - 1), width)
    packed = batch.column(batch.num_columns - 2)
    small = np.frombuffer(b"".join(packed.to_pylist()), np.uint8).reshape(len(batch), -1)
    return nearest(unpack(small), v, tables, centroids)[0], v


def _distances(cells: Cells, centroids: np.ndarray):
    def run(batches):
        tables = cells.tables(centroids)
        for batch in batches:
            for at in range(0, len(batch), CHUNK):
                part = batch.slice(at, CHUNK)
                near, v = _near(part, cells, tables, centroids)
                gap = v.astype(np.int64) - centroids[near]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(near.astype(np.int32)), pa.array((gap * gap).sum(axis=1))],
                                                 names=["vec_id", "cluster", "distance"])

    return run


def va_file(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> tuple[DataFrame, Cells | None]:
    """The stored table ``vec_id, cells, v`` and its cells (None, if no vector takes part)."""
    rows = integer_vectors(vectors, dimensions, scale)
    cells = _cells_of(rows, dimensions)

    def approximate(batches):
        for batch in batches:
            small = pack(cells.number(_matrix(batch.column(1), dimensions))) if len(batch) else np.empty((0, 1), np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in small], pa.binary()), batch.column(1)],
                                             names=["vec_id", "cells", "v"])

    if cells is None:
        return rows.select("vec_id", F.lit(None).cast("binary").alias("cells"), "v"), None
    return store(rows.mapInArrow(approximate, "vec_id long, cells binary, v array<int>"), "va-file"), cells


def clusters(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE,
             seed: int = 1) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector; see the module."""
    spark = vectors.sparkSession
    table, cells = va_file(vectors, dimensions, scale)
    key = F.sha2(F.encode(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), "UTF-8"), 256)
    first = [] if cells is None else table.where("vec_id IS NOT NULL").orderBy(key, "v").limit(k).select("v").collect()
    result = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not first:
        return spark.createDataFrame([], result)
    centroids = np.array([r.v for r in first], np.int64)
    for _ in range(rounds):
        parts = table.select("cells", "v").mapInArrow(_sums(cells, centroids), "cluster int, n long, total array<long>")
        moved = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[d]) for d in range(dimensions)]).alias("total"))
        centroids = centroids.copy()
        for r in moved.collect():  # k rows
            centroids[r.cluster] = [t // r.n for t in r.total]
    placed = store(table.mapInArrow(_distances(cells, centroids), "vec_id long, cluster int, distance long"), "placed")
    inertia = {r.cluster: r.s for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    digest = lambda c: hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()
    rows = [(c, s, sum(inertia.values()), digest(centroids[c])) for c, s in inertia.items()]
    names = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # k rows, whatever the input
    return placed.join(F.broadcast(names), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
