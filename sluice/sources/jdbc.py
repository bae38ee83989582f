"""JDBC query scans.

``spark.read.format("jdbc")`` with the query, fetch size, query timeout and connection
properties. For large tables give ``partition_column`` + bounds + ``num_partitions``: the
read is then split into that many range queries running in parallel tasks instead of one
task pulling the whole result through one connection. Retries are Spark task retries.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from py4j.java_gateway import is_instance_of
from pyspark.sql import DataFrame, SparkSession

from sluice.functions.coerce import normalize_numeric, render_date
from sluice.operators.process import limit_rows


def build_select(table: str | None, cols: str | Sequence[str] | None = " * ", condition: str | None = None,
                 sql: str | None = None) -> str:
    """An explicit ``sql`` wins; otherwise ``select cols from table [where condition]``."""
    if sql and sql.strip():
        return sql.strip().rstrip(";")
    if not table or not table.strip():
        raise ValueError("a table (or sql) is required")
    if cols is None or (isinstance(cols, str) and not cols.strip()):
        col_text = "*"
    else:
        col_text = cols.strip() if isinstance(cols, str) else ", ".join(cols)
    q = f"select {col_text} from {table.strip()}"
    if condition and condition.strip():
        q += f" where {condition.strip()}"
    return q


def scan_jdbc(spark: SparkSession, url: str, query: str | None = None, table: str | None = None,
              user: str | None = None, password: str | None = None, driver: str | None = None,
              fetchsize: int | None = None, query_timeout: int | None = None, max_rows: int = 0,
              rename: Mapping[str, str] | None = None, properties: Mapping[str, str] | None = None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None, max_retries: int = 3, retry_wait: float = 30.0) -> DataFrame:
    """Read a JDBC query (or table) into a DataFrame with typed columns.

    ``fetchsize="min"`` asks for a streamed result (cursor fetch, rows in small batches)
    instead of materialising it in the driver of the database client. Connecting (schema
    resolution on the driver) is retried ``max_retries`` times, ``retry_wait`` seconds apart,
    where the error is one that may pass; bad SQL or credentials fail at once. The row reads
    themselves are Spark tasks and retried by Spark.
    """
    reader = spark.read.format("jdbc").option("url", url)
    if partition_column:
        # partitioned reads need dbtable; wrap a query as a derived table
        src = table or f"({query}) sluice_q"
        reader = (reader.option("dbtable", src).option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions or 1)))
    elif query:
        reader = reader.option("query", query)
    elif table:
        reader = reader.option("dbtable", table)
    else:
        raise ValueError("query or table is required")
    props = dict(properties or {})
    if isinstance(fetchsize, str) and fetchsize.strip().lower() == "min":
        fetchsize = 1000
        props.setdefault("useCursorFetch", "true")
    for k, v in {"user": user, "password": password, "driver": driver, "fetchsize": fetchsize,
                 "queryTimeout": query_timeout}.items():
        if v is not None:
            reader = reader.option(k, str(v))
    for k, v in props.items():
        reader = reader.option(k, str(v))
    df = _load_with_retries(reader, max_retries, retry_wait)
    if rename:
        df = df.withColumnsRenamed(dict(rename))
    return df.transform(limit_rows(max_rows))


def _load_with_retries(reader, max_retries: int, retry_wait: float) -> DataFrame:
    attempt = 0
    while True:
        try:
            return reader.load()
        except Exception as e:  # connection / metadata errors surface here
            attempt += 1
            if attempt > max_retries or not _may_pass(reader._spark.sparkContext._gateway, e):
                raise
            time.sleep(retry_wait)


def _may_pass(gateway, error: Exception) -> bool:
    """Whether a failed connection is worth another try: not with bad SQL, names or credentials.

    SQL states of class 08 are connection failures; the two exception classes are JDBC's own
    marks for errors that may pass.
    """
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    while cause is not None:
        if is_instance_of(gateway, cause, "java.sql.SQLException"):
            passing = ("java.sql.SQLTransientException", "java.sql.SQLRecoverableException")
            return (cause.getSQLState() or "").startswith("08") or any(is_instance_of(gateway, cause, c) for c in passing)
        cause = cause.getCause()
    return False


def normalize_jdbc(df: DataFrame, scale: int = 2, rounding: str = "up", dates_as_text: bool = False) -> DataFrame:
    """S10a / S10b on a JDBC result: decimals rounded to ``scale``; optionally temporal
    columns rendered ``yyyy-MM-dd`` like the reference."""
    from pyspark.sql import types as T

    decs = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    if decs:
        df = normalize_numeric(df, decs, scale, rounding)
    if dates_as_text:
        temporal = [f.name for f in df.schema.fields
                    if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]
        df = df.withColumns({c: render_date(c) for c in temporal})
    return df
