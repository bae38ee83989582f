"""Null sink (dry run / benchmark): runs the whole plan, writes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()
