"""Nearest neighbours by a block matrix join (operator 2).

Queries and candidates are dealt into blocks of bounded size, and every query block meets every
candidate block in one cell of a grid. In a cell, vectors are scaled to unit length and quantised
to int8 with one scale per row. The product of two int8 tiles gives all cosines of the tile with
a proven error bound: with ``x = x' + e``, ``|<x, y> - <x', y'>| <= |e_x| + (1 + |e_x|) |e_y|``.
Pairs whose upper bound reaches neither the best cosines so far nor the tile's own k-th lower
bound are done; the others are computed again in double precision on the original vectors. A heap
per query merges tiles, and the last step merges cells, which return at most k rows a query.

The result is exact: a pair is only left out when its bound proves that k better ones exist.

Defined cases: rows with a NULL ``vec_id`` and vectors that are NULL, empty, zero or hold a NULL or
non-finite component take no part. Vectors of different lengths aren't compared. A row that
repeats an id and vector counts once; if an id has several vectors, the best score of any counts.
A query with fewer candidates returns all of them, and none without any.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sluice.llm.frames import numbered, position, store

QUERY_BLOCK = 1024
BLOCK = 8192
TILE = 2048


def _scores(vectors: np.ndarray, norms: np.ndarray, query: np.ndarray, norm: float) -> np.ndarray:
    """Cosines in double precision, summed in the order of the components."""
    return np.cumsum(vectors * query, axis=1)[:, -1] / (norms * norm)


def _norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(np.cumsum(vectors * vectors, axis=1)[:, -1])


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, and the length of each row's quantisation error."""
    unit = _unit(vectors)
    scale = np.abs(unit).max(axis=1) / 127
    small = np.rint(unit / scale[:, None])
    error = np.sqrt(((unit - small * scale[:, None]) ** 2).sum(axis=1))
    return small.astype(np.int8), scale, error


def _matrix(table: pa.Table) -> np.ndarray:
    column = table.column("v").combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(table), -1)


def _cell(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(queries) and len(rows):
            qid, q = queries.column("vec_id").to_numpy(), _matrix(queries)
            q8, qs, qe = quantised(q)
            kind = np.float32 if q.shape[1] <= 1000 else np.float64  # sums of products stay exact
            q8, qn = q8.astype(kind), _norms(q)
            best: list[dict[int, float]] = [{} for _ in qid]
            floor = np.full(len(qid), -np.inf)
            for at in range(0, len(rows), TILE):
                part = rows.slice(at, TILE)
                cid, c = part.column("vec_id").to_numpy(), _matrix(part)
                c8, cs, ce = quantised(c)
                cn = _norms(c)
                about = (q8 @ c8.astype(kind).T).astype(np.float64) * (qs[:, None] * cs[None, :])
                slack = qe[:, None] + (1 + qe[:, None]) * ce[None, :] + 1e-9
                about[qid[:, None] == cid[None, :]] = -np.inf
                low = about - slack
                if len(np.unique(cid)) == len(cid) and len(cid) > k:
                    floor = np.maximum(floor, np.partition(low, -k, axis=1)[:, -k])
                hits = about + slack >= floor[:, None]
                for i in np.flatnonzero(hits.any(axis=1)).tolist():
                    near = np.flatnonzero(hits[i] & (cid != qid[i]))
                    mine = best[i]
                    for v, s in zip(cid[near].tolist(), _scores(c[near], cn[near], q[i], qn[i]).tolist()):
                        if s > mine.get(v, -math.inf):
                            mine[v] = s
                    if len(mine) > k:
                        mine = best[i] = dict(heapq.nsmallest(k, mine.items(), key=lambda x: (-x[1], x[0])))
                    if len(mine) == k:
                        floor[i] = max(floor[i], min(mine.values()) - 1e-12)
            for i, mine in enumerate(best):
                out["query_id"] += [int(qid[i])] * len(mine)
                out["vec_id"] += mine.keys()
                out["score"] += mine.values()
        return pa.table(out, schema=schema)

    return search


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id long, v`` of the rows that take part, repeats removed."""
    plain = numbered(vectors)
    v = F.col(f"c{position(vectors, 'embedding')}")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    return (plain.select(F.col(f"c{position(vectors, 'vec_id')}").cast("long").alias("vec_id"), v.alias("v"))
            .where("vec_id IS NOT NULL AND v IS NOT NULL")
            .where(F.coalesce(F.forall("v", fine), F.lit(False)) & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False)))
            .dropDuplicates(["vec_id", "v"]).withColumn("dim", F.size("v")))


def nearest(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """The ``k`` nearest rows of every row whose ``vec_id`` is divisible by ``every``; see the module."""
    rows = store(usable(vectors), "vectors")
    queries = rows.where(F.col("vec_id") % every == 0)
    sizes = rows.agg(F.count("*").alias("n"), F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("q")).first()
    across, down = max(1, -(-sizes.n // BLOCK)), max(1, -(-sizes.q // QUERY_BLOCK))
    key = lambda n, seed: F.pmod(F.xxhash64("vec_id", "v", F.lit(seed)), F.lit(n)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("qb", key(down, 1)).withColumn("cb", upto(across))
    right = rows.withColumn("cb", key(across, 2)).withColumn("qb", upto(down))
    schema = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])
    found = left.groupBy("dim", "qb", "cb").cogroup(right.groupBy("dim", "qb", "cb")).applyInArrow(_cell(k), schema)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
