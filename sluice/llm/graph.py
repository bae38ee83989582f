"""Connected components of a link table, as Spark jobs: contract in tasks, hook to the least neighbour, jump, contract."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.frames import store, store_counting

#: links that a task contracts at a time
CHUNK = 1 << 20


def _least(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some links, and the least node that each reaches over them."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    comp = np.arange(len(ids))
    while True:
        low, high = np.minimum(comp[a], comp[b]), np.maximum(comp[a], comp[b])
        apart = low != high
        if not apart.any():
            return ids, ids[comp]
        a, b = a[apart], b[apart]
        np.minimum.at(comp, high[apart], low[apart])
        while not np.array_equal(up := comp[comp], comp):
            comp = up


def _stars(batches):
    """Links as others that connect the same nodes: a chunk's nodes with the least that they reach in it."""

    def star(held):
        ids, comp = _least(*(np.concatenate([h.column(k).to_numpy() for h in held]) for k in (0, 1)))
        linked = ids != comp
        return pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(comp[linked])], names=["a", "b"])

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= CHUNK:
            yield star(held)
            held, size = [], 0
    if size:
        yield star(held)


def _contracted(links: DataFrame) -> DataFrame:
    """Distinct ``links(a, b)``, cut down in their tasks before they are dealt out and after it."""
    stars = links.where("a <> b").mapInArrow(_stars, "a long, b long")
    return stars.distinct().mapInArrow(_stars, "a long, b long")


def connected_components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` -> ``(node, comp)`` where ``comp`` is the least node reachable from ``node``.

    Tasks replace the links that they hold, some at a time, by links to the least node that
    these reach, so there are few rounds, and a small table settles in one. Every round hooks each
    node to its least smaller neighbour, shortens the hooks by pointer jumping, and contracts the
    graph to the hooked-to nodes, so the edge table at least halves.
    Every step is a join or a map-side combined ``min``; nothing is gathered on the driver, and
    rows are counted as they are written: each job leaves some MB of garbage in the driver's memory.
    Nodes without a link are not returned.
    """
    edges, left = store_counting(_contracted(links.select(F.col("a").cast("long"), F.col("b").cast("long"))), "edges")
    labels = None
    while left:
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
        hooks = store(both.groupBy("node").agg(F.min("other").alias("least"))
                      .select("node", F.least("node", "least").alias("comp")), "hooks")
        moved = 1
        while moved:
            up = hooks.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
            hooks, moved = store_counting(hooks.select("node", "comp").join(up, "comp")
                                          .select("node", F.col("up").alias("comp"), (F.col("up") != F.col("comp")).alias("moved")), "jump", "moved")
        hooks = hooks.select("node", "comp")
        if labels is None:
            labels = hooks
        else:
            step = hooks.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
            labels = store(labels.join(step, "comp", "left").select("node", F.coalesce("next", "comp").alias("comp")), "labels")
        ends = hooks.select(F.col("node").alias("a"), F.col("comp").alias("ca"))
        other = hooks.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
        edges, left = store_counting(_contracted(edges.join(ends, "a").join(other, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))), "edges")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("a").alias("comp")).limit(0)
    return labels
