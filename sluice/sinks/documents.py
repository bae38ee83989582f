"""Document sinks.

* :func:`write_bulk` writes ``to_bulk_docs`` output as NDJSON bulk files (action line then
  document line); a bulk loader or ``curl --data-binary`` posts them as they are.
* :func:`write_documents` writes typed JSON documents (E10 strict casts: a value that does
  not parse fails the job), ``append`` or drop-first ``overwrite``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from sluice.functions.coerce import cast_strict
from sluice.operators.documents import MAX_ACTIONS, MAX_BYTES, bulk_requests


def write_bulk(docs: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None,
               max_actions: int | None = MAX_ACTIONS, max_bytes: int | None = MAX_BYTES) -> None:
    """NDJSON bulk files, one bulk request each: at most ``max_actions`` documents and ``max_bytes`` bytes.

    ``None`` lifts a limit; a request must fit in the memory of its task.
    """
    requests = bulk_requests(docs, max_actions or 1 << 62, max_bytes or 1 << 30)
    w = requests.select("value").write.mode(mode).option("maxRecordsPerFile", "1")
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def write_documents(df: DataFrame, path: str, types: Sequence[str] | Mapping[str, str] | None = None,
                    append: bool = False) -> None:
    if types:
        df = cast_strict(df, types)
    df.write.mode("append" if append else "overwrite").json(path)
