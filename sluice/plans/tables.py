"""Loading the driver's parquet tables (one file per table) and a scratch area for round-trips."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from sluice.session import checkpoint_dir

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    for n in names:
        p = os.path.join(sf_dir, f"{n}.parquet")
        if os.path.exists(p):
            table(spark, sf_dir, n).createOrReplaceTempView(n)


def shared_base(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, or one in the warehouse where none is set."""
    return checkpoint_dir(spark, default=os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_checkpoints"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint dir.

    A session without one (a local run) gets a folder in the warehouse, which is shared as well.
    """
    return os.path.join(shared_base(spark), "sluice-scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through its own file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
