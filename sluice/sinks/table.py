"""K5: table sink that replaces a partition or the table.

* A static spec ``{"dt": "20151101"}`` replaces that partition, also when the frame is empty.
* Without a spec an overwrite replaces the whole table; ``present_only`` replaces just the
  partitions that the frame holds (dynamic partition overwrite).

A table in a folder is replaced by :mod:`sluice.sinks.publish`: files are staged, a manifest commits
them, and folders are swapped, so a failed or killed run loses no row. A catalog table is
overwritten by Spark; an upsert into one keeps its merged rows and a manifest until the overwrite
is done, and a later upsert, or :func:`recover_table`, first carries out what was left.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.functions.coerce import encode_nulls
from sluice.sinks.publish import MANIFEST, Folder, publish, recover
from sluice.sources.table import parse_partition_spec


#: up to so many touched partitions are named in the scan's filter; beyond, they are joined
NAMED_PARTITIONS = 1000


def _partition_folder(df: DataFrame, spec: Mapping[str, str]) -> str:
    escape = df.sparkSession.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join(f"{escape(k)}={escape(str(v))}" for k, v in spec.items())


def _overwrite_catalog_partition(df: DataFrame, name: str, spec: Mapping[str, str], pcols: Sequence[str]) -> None:
    """``INSERT OVERWRITE ... PARTITION``: an empty frame empties the partition, too."""
    spark, quoted = df.sparkSession, lambda v: "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    cols = [c.name for c in spark.catalog.listColumns(name) if c.name not in spec]
    view = f"sluice_insert_{uuid.uuid4().hex}"
    df.select(*cols).createOrReplaceTempView(view)
    try:
        keys = ", ".join(f"`{c}` = {quoted(spec[c])}" if c in spec else f"`{c}`" for c in pcols)
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({keys}) SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def write_table(df: DataFrame, name: str | None = None, path: str | None = None, fmt: str = "parquet",
                partition: str | Mapping[str, str] | None = None, partition_cols: Sequence[str] = (),
                mode: str = "overwrite", null_token: str | None = None, present_only: bool = False) -> None:
    """Write into a catalog table (``name``) or a partitioned directory (``path``).

    ``partition``: static spec (``"k=v;k2=v2"`` or a dict) added as constant columns.
    ``null_token``: encode NULL/empty as e.g. ``\\N`` first (text tables, K5a).
    ``present_only``: without a spec, leave partitions that the frame does not hold as they are.
    """
    if (name is None) == (path is None):
        raise ValueError("give exactly one of name= or path=")
    spark = df.sparkSession
    exists = name is not None and spark.catalog.tableExists(name)
    if exists and not partition_cols:
        partition_cols = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    spec = dict(partition) if isinstance(partition, Mapping) else parse_partition_spec(partition, partition_cols)
    if null_token is not None:
        df = encode_nulls(df, [c for c in df.columns if c not in spec], null_token)
    if spec:
        df = df.withColumns({k: F.lit(v) for k, v in spec.items()})
    pcols = list(partition_cols) or list(spec)
    scope = "dynamic" if present_only or spec else "static"
    if exists:
        # Hive tables take dynamic partition values only in non-strict mode
        spark.conf.set("hive.exec.dynamic.partition.mode", "nonstrict")
        if spec and mode == "overwrite":
            _overwrite_catalog_partition(df, name, spec, pcols)
            return
        cols = [c.name for c in spark.catalog.listColumns(name)]
        (df.select(*cols).write.mode(mode).option("partitionOverwriteMode", scope)
         .insertInto(name, overwrite=(mode == "overwrite")))
        return
    if path is not None and mode == "overwrite":
        if spec and list(spec) == pcols[:len(spec)]:
            # the partition's folder is the target, so an empty frame replaces its rows as well
            publish(df.drop(*spec), path, fmt, pcols[len(spec):], below=_partition_folder(df, spec))
        else:
            publish(df, path, fmt, pcols, scope="present" if scope == "dynamic" and pcols else "table")
        return
    w = df.write.mode(mode).format(fmt)
    if pcols:
        w = w.partitionBy(*pcols)
    if name is not None:
        w.saveAsTable(name)
    else:
        w.save(path)


def _touched(incoming: DataFrame, pcols: Sequence[str], limit: int):
    """Predicate on the partition columns for the partitions of ``incoming``; None beyond ``limit``."""
    found = incoming.select(*pcols).distinct().limit(limit + 1).collect()  # names of partitions
    if len(found) > limit:
        return None
    if not found:
        return F.lit(False)
    if len(pcols) == 1:
        values = [r[0] for r in found if r[0] is not None]
        here = F.col(pcols[0]).isin(values) if values else F.lit(False)
        return here | F.col(pcols[0]).isNull() if len(values) < len(found) else here
    types = {f.name: f.dataType for f in incoming.schema}
    one = lambda r: reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(r[i]).cast(types[c])) for i, c in enumerate(pcols)])
    return reduce(lambda a, b: a | b, [one(r) for r in found])


def existing_rows(existing: DataFrame, incoming: DataFrame, pcols: Sequence[str], limit: int = NAMED_PARTITIONS) -> DataFrame:
    """The rows of the partitions that ``incoming`` touches: a static filter, which prunes the scan."""
    touched = _touched(incoming, pcols, limit)
    if touched is not None:
        return existing.where(touched)
    named = incoming.select(*[F.col(c).alias(f"__t{i}") for i, c in enumerate(pcols)]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"__t{i}")) for i, c in enumerate(pcols)]
    return existing.join(named, reduce(lambda a, b: a & b, same), "left_semi")


def _open_upserts(spark, name: str) -> Folder:
    """Where upserts into a catalog table keep their merged rows until the overwrite is done."""
    from sluice.plans.tables import shared_base

    key = hashlib.sha256(".".join([spark.catalog.currentDatabase(), name] if "." not in name else [name]).encode()).hexdigest()[:24]
    return Folder(spark, f"{shared_base(spark)}/sluice-upserts/{key}")


def recover_table(spark, name: str) -> int:
    """Carry out the upserts into a catalog table that were committed, but not done; returns how many."""
    folder, n = _open_upserts(spark, name), 0
    for tx, is_dir, _ in sorted(folder.entries(), key=lambda e: e[2]):
        if is_dir and folder.exists(f"{tx}/{MANIFEST}"):
            _overwrite_from(spark, name, folder, tx)
            n += 1
    return n


def _overwrite_from(spark, name: str, folder: Folder, tx: str) -> None:
    """Put the merged rows of a stage into their table; can be repeated."""
    plan = json.loads(folder.read(f"{tx}/{MANIFEST}"))
    write_table(spark.read.schema(StructType.fromJson(plan["schema"])).parquet(folder.uri(f"{tx}/merged")), name=name, present_only=plan["present_only"])
    folder.delete(tx)


def write_upsert(incoming: DataFrame, keys: Sequence[str], name: str | None = None, path: str | None = None,
                 fmt: str = "parquet", mode: str = "replace", order: Sequence[str] | str | None = None,
                 partition_cols: Sequence[str] = (), stage: str | None = None) -> None:
    """K6 as a sink: merge ``incoming`` into a table on ``keys`` and rewrite what changed.

    With partition columns that are part of the key, only the partitions the incoming rows
    touch (the NULL partition included) are read, merged and replaced: they are named in the
    scan's partition filter. Otherwise the whole table is replaced, so a row that moves to another
    partition leaves none behind. The incoming rows, one per key, are first written to ``stage``
    (default: a fresh folder under ``spark.checkpoint.dir``, deleted at the end). Merged rows are
    published, see the module: a run killed at any point loses nothing, and the next one, or
    ``recover`` / ``recover_table``, finishes what was committed.
    """
    from sluice.operators.upsert import dedupe_by_key, upsert
    from sluice.plans.tables import drop_path, scratch_path

    spark = incoming.sparkSession
    if name is not None:
        recover_table(spark, name)
        existing = spark.table(name)
        if not partition_cols:
            partition_cols = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    else:
        recover(spark, path)
        existing = spark.read.format(fmt).load(path)
    own_stage = stage is None
    stage = stage or scratch_path(spark, "upsert-stage")
    if order is not None:
        incoming = dedupe_by_key(incoming, list(keys), order, keep="last" if mode.lower() == "replace" else "first")
    incoming = incoming.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in existing.schema])
    incoming.write.mode("overwrite").parquet(f"{stage}/incoming")
    incoming = spark.read.schema(existing.schema).parquet(f"{stage}/incoming")
    pcols = [c for c in partition_cols if c in keys]
    in_key = bool(pcols) and len(pcols) == len(partition_cols)
    if in_key:
        existing = existing_rows(existing, incoming, pcols)
    merged = upsert(existing, incoming, keys, mode=mode)
    if name is None:
        publish(merged, path, fmt, partition_cols, scope="present" if in_key else "table")
    else:
        folder, tx = _open_upserts(spark, name), uuid.uuid4().hex[:16]
        merged.write.parquet(folder.uri(f"{tx}/merged"))
        folder.write(f"{tx}/{MANIFEST}", json.dumps({"present_only": in_key, "schema": spark.table(name).schema.jsonValue()}))
        _overwrite_from(spark, name, folder, tx)
    if own_stage:
        drop_path(spark, stage)
