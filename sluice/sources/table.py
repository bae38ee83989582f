"""Table and partition scans.

A table is either a catalog name (``db.table``, any format the catalog knows -- Parquet,
ORC, text, and Hive ``STORED AS RCFILE / SEQUENCEFILE`` tables when the session has Hive
support) or a partitioned directory (``path`` + ``fmt``). The partition spec becomes a
``where`` on the partition columns, which Catalyst turns into partition pruning: only the
named partition's files are listed and read.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.template import expand_values


def parse_partition_spec(spec: str | None, partition_cols: Sequence[str] = ()) -> dict[str, str]:
    """``"k=v;k2=v2"`` -> ``{k: v, k2: v2}``; a bare ``"20151101"`` names the first partition column."""
    if spec is None or not spec.strip():
        return {}
    out: dict[str, str] = {}
    for item in spec.split(";"):
        item = item.strip()
        if not item:
            continue
        if "=" in item:
            k, v = item.split("=", 1)
            out[k.strip()] = v.strip().strip("'\"")
        else:
            if not partition_cols:
                raise ValueError(f"bare partition value {item!r} needs the partition columns")
            out[partition_cols[0]] = item.strip("'\"")
    return out


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def scan_table(spark: SparkSession, name: str | None = None, partition: str | dict | None = None,
               path: str | None = None, fmt: str = "parquet", partition_cols: Sequence[str] = ()) -> DataFrame:
    """Read a table, optionally only one partition (pruned at planning time)."""
    if (name is None) == (path is None):
        raise ValueError("give exactly one of name= or path=")
    if name is not None:
        df = spark.table(name)
        cols = list(partition_cols) or partition_columns(spark, name)
    else:
        df = spark.read.format(fmt).load(path)
        cols = list(partition_cols)
    spec = partition if isinstance(partition, dict) else parse_partition_spec(partition, cols)
    return df.where(_in_partition(df, spec)) if spec else df


def _in_partition(df: DataFrame, spec: dict[str, str]) -> Column:
    unknown = [k for k in spec if k not in df.columns]
    if unknown:
        raise ValueError(f"unknown partition columns {unknown}")
    # compared in the column's own type: inference reads the folder ``m=01`` as the number 1
    types = {f.name: f.dataType for f in df.schema}
    return reduce(lambda a, b: a & b, [F.col(k) == F.lit(str(v)).try_cast(types[k]) for k, v in spec.items()])


def scan_table_template(spark: SparkSession, name: str | None = None, partition: str = "",
                        base: str | datetime | None = None, **kw) -> DataFrame:
    """S16 + S8: the partition template expands to specs, and one scan reads all their partitions.

    The specs become one pruning predicate (``or`` of the single ones), not a union of reads; a
    partition that several specs name is read once.
    """
    df = scan_table(spark, name, None, **kw)
    cols = list(kw.get("partition_cols", ())) or (partition_columns(spark, name) if name is not None else [])
    specs = [parse_partition_spec(p, cols) for p in expand_values(partition, base)]
    if not all(specs):
        return df  # an empty spec is the whole table
    return df.where(reduce(lambda a, b: a | b, [_in_partition(df, s) for s in specs]))


def scan_select(df: DataFrame, cols: str | Sequence[str] | None = "*", condition: str | None = None) -> DataFrame:
    """S11 on a DataFrame source: ``select cols [where condition]`` (blank cols = ``*``)."""
    if condition and condition.strip():
        df = df.where(F.expr(condition))
    if cols is None or (isinstance(cols, str) and not cols.strip()) or cols == "*" or \
            (isinstance(cols, str) and cols.strip() == "*"):
        return df
    exprs = [c.strip() for c in cols.split(",")] if isinstance(cols, str) else list(cols)
    return df.selectExpr(*exprs)
