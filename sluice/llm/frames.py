"""Helpers shared by the operators: exact column picking and shared scratch tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.session import checkpoint_dir

#: Names this run's scratch folders, so that other jobs' are never taken for its own.
RUN = uuid.uuid4().hex[:12]

#: bytes of rows that a Python worker is given at a time
BATCH_BYTES = 1 << 20


def numbered(df: DataFrame) -> DataFrame:
    """The same columns as ``c0, c1, ...``: safe to address whatever the real names are."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def position(df: DataFrame, name: str) -> int:
    """Index of the column with exactly this name (the first, if it repeats).

    Column lookup by name is case-insensitive in Spark, so a frame that also has ``Text`` or a
    second ``text`` would be ambiguous; positions never are.
    """
    if name not in df.columns:
        raise ValueError(f"column {name!r} is missing from {df.columns}")
    return df.columns.index(name)


def pick(df: DataFrame, **types: str) -> DataFrame:
    """Only the named columns, cast to the given types; everything else is pruned."""
    plain = numbered(df)
    return plain.select(*[F.col(f"c{position(df, name)}").cast(kind).alias(name) for name, kind in types.items()])


def documents_view(df: DataFrame) -> DataFrame:
    """``doc_id long, text string`` with a NULL text read as empty."""
    return pick(df, doc_id="long", text="string").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python workers in batches of about :data:`BATCH_BYTES`, unless the session names a size itself.

    By default a batch of texts has up to 10000 rows and 64 MB, which the executor and each of its
    workers hold several times over and give back late or never. Frames are computed after they are
    returned, so the setting stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared ``spark.checkpoint.dir``.

    Where the session names none (local tests), the warehouse folder, which a cluster shares as
    well, takes its place.
    """
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    base = checkpoint_dir(spark, default=os.path.join(warehouse, "_checkpoints"))
    return os.path.join(base, f"sluice-{RUN}-{name}-{uuid.uuid4().hex[:12]}")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a scratch table and read it back: the lineage is cut, executors may go."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def store_counting(df: DataFrame, name: str, where: str = "true") -> tuple[DataFrame, int]:
    """:func:`store`, and how many of the rows meet ``where``: counted as they are written, without a job."""
    seen = Observation()
    stored = store(df.observe(seen, F.count_if(F.expr(where)).alias("n")), name)
    return stored, seen.get["n"]


def drop_scratch(spark: SparkSession) -> None:
    """Delete the scratch folders of this run; call it once its results are written."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(os.path.dirname(scratch_dir(spark, "any")))
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(base):
        for found in fs.listStatus(base):
            if found.getPath().getName().startswith(f"sluice-{RUN}-"):
                fs.delete(found.getPath(), True)
