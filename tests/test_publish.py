"""Replacing tables: what a killed run leaves, what a scan reads, and sessions without a shared folder."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from sluice.sinks import publish as P
from sluice.sinks.table import existing_rows, recover_table, write_table, write_upsert

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def rows(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("k", "v", "dt").collect()), key=str)


@pytest.fixture
def table(spark, outdir):
    path = f"{outdir}/t"
    df = spark.range(40).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.concat(F.lit("d"), F.col("id") % 8).alias("dt"))
    write_table(df, path=path, partition_cols=["dt"])
    return path


def incoming(spark, n=10):
    return spark.range(n).select(F.col("id").alias("k"), F.lit("new").alias("v"), F.concat(F.lit("d"), F.col("id") % 2).alias("dt"))


def merged(spark, path):
    new = {r.k: r for r in incoming(spark).collect()}
    old = [tuple(r) for r in spark.read.parquet(path).select("k", "v", "dt").collect()]
    keys = {(r.k, r.dt) for r in new.values()}
    return sorted([r for r in old if (r[0], r[2]) not in keys] + [tuple(r) for r in new.values()], key=str)


class Killed(BaseException):
    pass


@pytest.mark.parametrize("at", range(7))
def test_a_run_killed_at_any_move_loses_nothing(spark, table, monkeypatch, at):
    """The upsert makes five moves: the manifest, two old partitions out, two new ones in."""
    before, after = rows(spark, table), merged(spark, table)
    real, made = P.Folder.move, []

    def move(self, old, new):
        if len(made) == at:
            raise Killed
        made.append(old)
        real(self, old, new)

    monkeypatch.setattr(P.Folder, "move", move)
    run = lambda: write_upsert(incoming(spark), ["k", "dt"], path=table, partition_cols=["dt"])
    if at < 5:
        with pytest.raises(Killed):
            run()
        monkeypatch.setattr(P.Folder, "move", real)
        assert P.recover(spark, table) == ([] if at == 0 else [made[0].split("/")[1]])
        assert rows(spark, table) == (before if at == 0 else after)
        assert P.recover(spark, table) == []
    else:
        run()
        assert rows(spark, table) == after and len(made) == 5
    assert not P.Folder(spark, table).entries(P.HIDDEN)


def test_a_process_that_dies_between_removal_and_arrival(spark, table):
    after = merged(spark, table)
    script = f"""
import os, sys; sys.path.insert(0, {ROOT!r})
from pyspark.sql import functions as F
from sluice.session import get_session
from sluice.sinks import publish as P
from sluice.sinks.table import write_upsert
spark = get_session("local[2]", extra={{"spark.ui.enabled": "false"}})
real, made = P.Folder.move, []
def move(self, old, new):
    if len(made) == 3:
        os._exit(9)
    made.append(old)
    real(self, old, new)
P.Folder.move = move
new = spark.range(10).select(F.col("id").alias("k"), F.lit("new").alias("v"), F.concat(F.lit("d"), F.col("id") % 2).alias("dt"))
write_upsert(new, ["k", "dt"], path={table!r}, partition_cols=["dt"])
"""
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, timeout=300)
    assert done.returncode == 9, done.stderr[-2000:]
    assert {n for n, _ in P.Folder(spark, table).visible()} == {f"dt=d{i}" for i in range(2, 8)}  # both are away
    # the next upsert finishes the open one first
    write_upsert(incoming(spark, 1), ["k", "dt"], path=table, partition_cols=["dt"])
    assert rows(spark, table) == after


def test_a_failing_write_leaves_the_table(spark, table):
    before = rows(spark, table)
    bad = incoming(spark).withColumn("v", F.when(F.col("k") == 7, F.raise_error(F.lit("no"))).otherwise(F.col("v")))
    for run in (lambda: write_table(bad, path=table, partition_cols=["dt"]),
                lambda: write_table(bad.drop("dt"), path=table, partition={"dt": "d3"}),
                lambda: write_table(bad, path=table, partition_cols=["dt"], present_only=True)):
        with pytest.raises(Exception, match="no"):
            run()
        assert rows(spark, table) == before


def test_only_touched_partitions_are_scanned(spark, table):
    old, new = spark.read.parquet(table), incoming(spark)
    for limit in (1000, 1):
        got = existing_rows(old, new, ["dt"], limit)
        assert {r.dt for r in got.select("dt").distinct().collect()} == {"d0", "d1"}
    plan = existing_rows(old, new, ["dt"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [dt#" in plan and "IN (d0,d1)" in plan
    assert existing_rows(old, new.limit(0), ["dt"]).count() == 0
    files = existing_rows(old, new, ["dt"]).select("_metadata.file_path").distinct().collect()
    assert all("dt=d0" in r[0] or "dt=d1" in r[0] for r in files)


def test_null_and_several_partition_columns_are_pruned(spark, outdir):
    path = f"{outdir}/p"
    df = spark.range(60).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 3).cast("int").alias("a"), (F.col("id") % 4).cast("int").alias("b"), F.lit("old").alias("v"))
    write_table(df, path=path, partition_cols=["a", "b"])
    new = df.where("id IN (0, 1, 13)").withColumn("v", F.lit("new"))
    plan = existing_rows(spark.read.parquet(path), new, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((" in plan
    write_upsert(new, ["id", "a", "b"], path=path, partition_cols=["a", "b"])
    got = {(r.id, r.v) for r in spark.read.parquet(path).collect()}
    # a NULL in the key equals nothing, so id 0 is there twice
    assert got == {(i, "old") for i in range(60) if i not in (1, 13)} | {(i, "new") for i in (0, 1, 13)}
    assert spark.read.parquet(path).count() == 61


def test_catalog_upsert_that_was_left_open_is_done_later(spark, monkeypatch):
    from sluice.sinks import table as T

    name = f"sluice_open_{os.getpid()}"
    spark.range(20).select(F.col("id").alias("k"), F.lit("old").alias("v"), (F.col("id") % 2).alias("dt")).write.partitionBy("dt").saveAsTable(name)
    try:
        new = spark.range(4).select(F.col("id").alias("k"), F.lit("new").alias("v"), (F.col("id") % 2).alias("dt"))
        real = T._overwrite_from
        monkeypatch.setattr(T, "_overwrite_from", lambda *a: (_ for _ in ()).throw(Killed()))
        with pytest.raises(Killed):
            write_upsert(new, ["k", "dt"], name=name)
        monkeypatch.setattr(T, "_overwrite_from", real)
        assert recover_table(spark, name) == 1 and recover_table(spark, name) == 0
        spark.catalog.refreshTable(name)
        assert {(r.k, r.v) for r in spark.table(name).collect()} == {(i, "new" if i < 4 else "old") for i in range(20)}
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_session_without_a_checkpoint_folder(tmp_path):
    """Round trips work where no ``spark.checkpoint.dir`` is set: the warehouse takes its place."""
    script = f"""
import sys; sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.warehouse.dir", {str(tmp_path / "wh")!r}).getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
from sluice.plans import catalog, roundtrips
for _ in range(2):
    print("ROWS", catalog.REGISTRY["delimited_roundtrip"][0](spark, "/root/testdata/sf0.001").count())
"""
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300, env=env, cwd=tmp_path)
    assert done.stdout.split() == ["ROWS", "150", "ROWS", "150"], done.stderr[-2000:]
    assert (tmp_path / "wh" / "_checkpoints").is_dir()
