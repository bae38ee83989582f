"""Session helpers shared by tests, the bench and the examples."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Configs every sluice job wants. Shuffle-partition count is a local default; on a
# cluster AQE coalesces partitions from the real shuffle sizes, so the static number
# only has to be an upper bound.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "sluice", shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the sluice defaults applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        # getOrCreate may hand back an existing session: runtime SQL confs still apply.
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


# default folders that were installed, by application: the setting itself is static in a running session
_INSTALLED: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession, default: str | None = None) -> str:
    """Shared checkpoint folder of the cluster (``spark.checkpoint.dir``).

    The value is read from the session. Only when it is unset (local runs, tests) is ``default``
    installed, so on a cluster jobs always write to the shared folder.
    """
    context = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or _INSTALLED.get(context.applicationId)
    if not d:
        if default is None and context.getCheckpointDir() is None:
            raise RuntimeError("spark.checkpoint.dir is not set; pass default= for a local run")
        # a folder that the caller set for checkpoint() is shared as well
        d = _INSTALLED[context.applicationId] = default if context.getCheckpointDir() is None else context.getCheckpointDir()
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(d)
    return d


def checkpoint_subdir(spark: SparkSession, name: str, default: str | None = None) -> str:
    return os.path.join(checkpoint_dir(spark, default), name)
