"""Files of about a stated size, however the rows are spread and skewed.

One pass sums the bytes of every partition value. Each value gets as many files as its bytes need,
and a row goes to one of its value's files by a hash of its content and of the task it comes from
(so equal rows from many tasks part, and a repeated task deals its rows alike). Every file is one
task's rows, addressed directly, so two files never share a task and a value that holds most of
the rows is written by many tasks.

With rows much smaller than a file, sizes of a value's files differ by a few per cent; the
smallest possible file is a value whose rows need no whole one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dealt_by_size(df: DataFrame, size: Column, file_bytes: int, partition_cols: Sequence[str] = ()) -> DataFrame:
    """The rows in one partition a file; ``size`` is the bytes that a row takes in it."""
    if file_bytes < 1:
        raise ValueError("file_bytes must be positive")
    keys = [F.col(c) for c in partition_cols]
    sums = (df.groupBy(*[k.alias(f"__p{i}") for i, k in enumerate(keys)]).agg(F.sum(size).alias("__bytes")).collect())  # one row a folder
    files = [max(1, -(-(r["__bytes"] or 0) // file_bytes)) for r in sums]
    if not files:
        return df
    names = [f"__p{i}" for i in range(len(keys))]
    first = [sum(files[:i]) for i in range(len(files))]
    spark = df.sparkSession
    rows = [(*[r[n] for n in names], f, n) for r, f, n in zip(sums, first, files)]
    kinds = [df.select(*keys).schema[i].dataType.simpleString() for i in range(len(keys))]
    plan = spark.createDataFrame(rows, ", ".join([*[f"{n} {k}" for n, k in zip(names, kinds)], "__first int", "__files int"]))
    here = reduce(lambda a, b: a & b, [k.eqNullSafe(F.col(n)) for k, n in zip(keys, names)], F.lit(True))
    # one row a folder, and no more than the folders that the write makes anyway
    placed = df.join(F.broadcast(plan), here)
    turn = F.xxhash64(*df.columns, F.spark_partition_id())
    return placed.repartitionById(sum(files), F.col("__first") + F.pmod(turn, F.col("__files")).cast("int")).select(*df.columns)
