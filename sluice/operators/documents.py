"""K9: bulk-index documents as NDJSON (action line + document line per row).

An optional id column gives each document its ``_id``; rows sharing an id keep only the
last one by ``order`` (what repeated index requests leave in the index). A row with a NULL id is
a document of its own, without ``_id``. The de-duplication combines map-side, so a hot id does
not gather all its rows in one task. Without an id every row is its own document and no shuffle
happens.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.upsert import dedupe_by_key


def to_bulk_docs(index: str, doc_type: str | None = None, id_col: str | None = None,
                 parent_col: str | None = None, order: Sequence[str] | str | None = None,
                 doc_cols: Sequence[str] | None = None, doc_json_col: str | None = None):
    """Rows -> ``(doc_id, action, doc)``.

    ``doc`` is ``to_json`` of ``doc_cols`` (default all columns) or, with ``doc_json_col``,
    an already rendered JSON column (e.g. the output of ``line_to_json``).
    """

    def op(df: DataFrame) -> DataFrame:
        if id_col is not None and order is not None:
            df = dedupe_by_key(df, [id_col], order, keep="last")
        meta = [F.lit(index).alias("_index")]
        if doc_type:
            meta.append(F.lit(doc_type).alias("_type"))
        doc_id = F.col(id_col).cast("string") if id_col else F.lit(None).cast("string")
        if id_col:
            meta.append(doc_id.alias("_id"))
        if parent_col:
            meta.append(F.col(parent_col).cast("string").alias("_parent"))
        action = F.to_json(F.struct(F.struct(*meta).alias("index")))
        if doc_json_col:
            doc = F.col(doc_json_col)
        else:
            doc = F.to_json(F.struct(*[F.col(c) for c in (doc_cols or df.columns)]))
        return df.select(doc_id.alias("doc_id"), action.alias("action"), doc.alias("doc"))

    return op


# ---- fixed values: the limits of one bulk request ---------------------------------------
MAX_ACTIONS = 10000
MAX_BYTES = 5 * 1024 * 1024
# -----------------------------------------------------------------------------------------


def bulk_requests(df: DataFrame, max_actions: int = MAX_ACTIONS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``(action, doc)`` -> one row a bulk request: ``value`` (its NDJSON lines), ``n_docs``, ``n_bytes``.

    Documents are taken in the order of their partition. A request is closed when one more would
    bring it over either limit; bytes are those of the written lines, line feeds included. Only a
    document that is larger than ``max_bytes`` by itself makes a larger request, alone. A task
    holds one request at a time, and no row moves to another task.
    """
    if max_actions < 1 or max_bytes < 1:
        raise ValueError("limits of a bulk request must be positive")

    def run(batches):
        lines: list[str] = []
        size = 0

        def closed():
            return pa.RecordBatch.from_pydict({"value": pa.array(["\n".join(lines)], pa.string()), "n_docs": pa.array([len(lines)], pa.int64()),
                                               "n_bytes": pa.array([size], pa.int64())})

        for batch in batches:
            for line, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lines and (len(lines) >= max_actions or size + n > max_bytes):
                    yield closed()
                    lines, size = [], 0
                lines.append(line)
                size += n
        if lines:
            yield closed()

    sized = bulk_lines(df).select("value", (F.octet_length("value") + 1).cast("long").alias("n"))
    return sized.mapInArrow(run, "value string, n_docs long, n_bytes long")


def bulk_lines(df: DataFrame) -> DataFrame:
    """``(action, doc)`` -> one text row holding both NDJSON lines (kept adjacent on write)."""
    return df.select(F.concat_ws("\n", "action", "doc").alias("value"))
