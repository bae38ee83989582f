"""Structured Streaming: the same stateless operators on ``readStream`` frames.

Every row processor, template column and coercion in sluice is a projection or a filter,
so a chain built for a batch job applies unchanged to a streaming frame. Writing one
stream to several targets goes through ``foreachBatch``: each micro-batch is persisted
once, written to every target, then released. Checkpoints live under the cluster's
``spark.checkpoint.dir`` (read from the session), so a restarted query resumes with the
first micro-batch that was not committed.

Delivery. A batch that stopped between its writes and its commit is run again. A ledger beside the
checkpoint holds, for every named target, the last epoch that it has; a target skips what it has.
For a :func:`file_target` this is exactly once: the batch is published (staged, committed by a
manifest, moved in), and the manifest carries the query and the epoch, so that a replay finishes
an open publish instead of writing again. For any other sink the ledger is written right after the
sink returns: only a stop between the two repeats a batch, to this one target.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sluice.functions.delimiters import unescape_delim
from sluice.session import checkpoint_subdir
from sluice.sinks.publish import HIDDEN, MANIFEST, Folder, publish, recover

BatchSink = Callable[[DataFrame], None]


@dataclass
class StreamTarget:
    """A named sink of a stream. ``write(batch, tag, done)`` must call ``done()`` when it has the batch."""

    name: str
    write: Callable[[DataFrame, str, Callable[[], None]], None]


def sink_target(name: str, sink: BatchSink) -> StreamTarget:
    """Any sink as a target; ``done`` follows its return."""

    def write(batch: DataFrame, tag: str, done: Callable[[], None]) -> None:
        sink(batch)
        done()

    return StreamTarget(name, write)


def file_target(name: str, path: str, fmt: str = "parquet", partition_cols: Sequence[str] = (),
                options: dict[str, str] | None = None) -> StreamTarget:
    """Appends every micro-batch to the files of ``path`` exactly once."""

    def write(batch: DataFrame, tag: str, done: Callable[[], None]) -> None:
        spark, tx = batch.sparkSession, f"{HIDDEN}/{tag}"
        if Folder(spark, path).exists(f"{tx}/{MANIFEST}"):
            # the batch was committed, but not all of it moved in or entered in the ledger
            recover(spark, path, committed=lambda name_: done() if name_ == tag else None)
        else:
            publish(batch, path, fmt, partition_cols, scope="append", options=options, name=tag, committed=done)

    return StreamTarget(name, write)


class Ledger:
    """The last epoch that each target of a query has, one small file a target."""

    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, path)

    def last(self, target: str, query: str) -> int:
        """-1 if the target has no epoch of this query."""
        rel = f"{query}/{target}"
        return int(self.folder.read(rel)) if self.folder.exists(rel) else -1

    def enter(self, target: str, query: str, epoch: int) -> None:
        self.folder.write(f"{query}/{target}", str(epoch))


def read_text_stream(spark: SparkSession, path: str, line_delim: str | None = None,
                     max_files_per_trigger: int | None = None, name_glob: str | None = None) -> DataFrame:
    """New files under ``path`` as a stream of ``value`` lines (UTF-8, malformed -> U+FFFD)."""
    reader = spark.readStream.format("text")
    if line_delim:
        reader = reader.option("lineSep", unescape_delim(line_delim))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.load(path).select(F.make_valid_utf8("value").alias("value"))


def read_table_stream(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def fan_out(sinks: Sequence[BatchSink | StreamTarget], ledger: Ledger | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function writing each micro-batch to every sink, computed once.

    With a ledger, a target that has the epoch is skipped. The query is known by the id in its
    checkpoint, which outlives restarts.
    """
    targets = [s if isinstance(s, StreamTarget) else sink_target(f"sink{i}", s) for i, s in enumerate(sinks)]
    if len({t.name for t in targets}) < len(targets):
        raise ValueError("targets of one stream need different names")

    def write(batch: DataFrame, epoch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "query"
        open_ = [t for t in targets if ledger is None or ledger.last(t.name, query) < epoch_id]
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK) if len(open_) > 1 else batch
        try:
            for t in open_:
                t.write(kept, f"{query}-{t.name}-{epoch_id}", lambda t=t: ledger and ledger.enter(t.name, query, epoch_id))
        finally:
            if len(open_) > 1:
                kept.unpersist()

    return write


def start(df: DataFrame, sinks: Sequence[BatchSink | StreamTarget], name: str, trigger: dict | None = None,
          checkpoint: str | None = None) -> StreamingQuery:
    """Start ``df`` -> every sink. ``trigger`` e.g. ``{"availableNow": True}`` or
    ``{"processingTime": "1 minute"}``. The ledger lies below the checkpoint."""
    loc = checkpoint or checkpoint_subdir(df.sparkSession, f"streams/{name}")
    ledger = Ledger(df.sparkSession, f"{loc}/sluice-ledger")
    w = df.writeStream.queryName(name).option("checkpointLocation", loc).foreachBatch(fan_out(sinks, ledger))
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()
