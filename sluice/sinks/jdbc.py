"""K7 / K6: JDBC insert sink -- typed rows in batches, statements before and after -- and upsert.

Values are coerced with the E9 rules into typed columns and bound by Spark's JDBC
writer (``batchsize`` rows per batch, one transaction per partition), never pasted into
SQL text. ``presql`` (typically ``delete ... where datekey = ...``) runs once, before
the load, and ``post_sql`` once after it, on a driver-side connection.

A plain insert is at least once: a task that is retried after its commit inserts its rows
again. :func:`upsert_jdbc` is safe to repeat. It loads a stage table, then merges that into the
target by a few set statements in one transaction of the database; only the statements come
from the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.coerce import coerce_fields
from sluice.operators.upsert import dedupe_by_key

#: connections that a load opens at most, unless the caller names another number
CONNECTIONS = 16


def run_statements(spark: SparkSession, url: str, statements: Sequence[str], user: str | None = None,
                   password: str | None = None, driver: str | None = None) -> list[int]:
    """Execute DDL/DML statements in one transaction; returns their update counts."""
    jvm = spark.sparkContext._jvm
    if driver:
        jvm.java.lang.Class.forName(driver, True, jvm.java.lang.Thread.currentThread().getContextClassLoader())
    conn = jvm.java.sql.DriverManager.getConnection(url, user, password) if user else \
        jvm.java.sql.DriverManager.getConnection(url)
    try:
        conn.setAutoCommit(False)
        stmt = conn.createStatement()
        try:
            counts = [stmt.executeUpdate(s.strip().rstrip(";")) for s in statements]
            conn.commit()
            return counts
        except Exception:
            conn.rollback()
            raise
        finally:
            stmt.close()
    finally:
        conn.close()


def run_statement(spark: SparkSession, url: str, sql: str, user: str | None = None,
                  password: str | None = None, driver: str | None = None) -> int:
    """Execute one DDL/DML statement through the JVM's JDBC driver manager."""
    return run_statements(spark, url, [sql], user, password, driver)[0]


def write_jdbc(df: DataFrame, url: str, table: str, types: Sequence[str] | Mapping[str, str] | None = None,
               batch_size: int = 1000, presql: str | None = None, mode: str = "append",
               user: str | None = None, password: str | None = None, driver: str | None = None,
               num_partitions: int = CONNECTIONS, properties: Mapping[str, str] | None = None,
               post_sql: str | None = None) -> None:
    """Insert ``df`` into ``table``. ``types`` (by position or name) applies E9 coercion first."""
    if types:
        df = coerce_fields(df, types)
    if presql and presql.strip():
        run_statement(df.sparkSession, url, presql, user, password, driver)
    w = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table) \
        .option("batchsize", str(batch_size)).option("numPartitions", str(num_partitions))
    for k, v in {"user": user, "password": password, "driver": driver}.items():
        if v is not None:
            w = w.option(k, v)
    for k, v in (properties or {}).items():
        w = w.option(k, str(v))
    w.save()
    if post_sql and post_sql.strip():
        run_statement(df.sparkSession, url, post_sql, user, password, driver)


def merge_statements(table: str, stage: str, columns: Sequence[str], keys: Sequence[str], mode: str = "replace") -> list[str]:
    """Standard SQL that merges ``stage`` into ``table``.

    ``replace`` deletes the rows whose key is staged and inserts the staged rows; ``ignore``
    inserts only rows whose key the target lacks. As a unique key, the match does not equate
    NULLs. Equal rows in the stage (a task that ran twice) count once.
    """
    names = ", ".join(columns)
    match = " and ".join(f"t.{k} = s.{k}" for k in keys)
    insert = f"insert into {table} ({names}) select distinct {', '.join(f's.{c}' for c in columns)} from {stage} s"
    if mode == "ignore":
        return [f"{insert} where not exists (select 1 from {table} t where {match})"]
    match = " and ".join(f"{table}.{k} = s.{k}" for k in keys)
    return [f"delete from {table} where exists (select 1 from {stage} s where {match})", insert]


def upsert_jdbc(df: DataFrame, url: str, table: str, keys: Sequence[str], stage: str, mode: str = "replace",
                order: Sequence[str] | str | None = None, set_cols: Mapping[str, Column | str] | None = None,
                types: Sequence[str] | Mapping[str, str] | None = None, post_sql: str | None = None,
                user: str | None = None, password: str | None = None, driver: str | None = None, **writer) -> None:
    """K6 into a JDBC table: merge ``df`` into ``table`` on ``keys``.

    ``stage`` is an existing table with the columns of ``df`` that this load may empty. ``order``
    resolves duplicate incoming keys (last wins for ``replace``, first for ``ignore``) and is
    dropped; without it the incoming keys must be unique. ``set_cols`` adds or overrides
    computed columns. ``post_sql`` runs in the transaction of the merge, after it.
    """
    mode = mode.lower()
    if mode not in ("replace", "ignore"):
        raise ValueError("mode must be 'replace' or 'ignore'")
    if set_cols:
        df = df.withColumns({k: (v if isinstance(v, Column) else F.expr(v)) for k, v in set_cols.items()})
    if order is not None:
        df = dedupe_by_key(df, list(keys), order, keep="last" if mode == "replace" else "first")
        df = df.drop(*([order] if isinstance(order, str) else order))
    login = {"user": user, "password": password, "driver": driver}
    write_jdbc(df, url, stage, types=types, presql=f"delete from {stage}", **login, **writer)
    merge = merge_statements(table, stage, df.columns, list(keys), mode)
    last = [post_sql] if post_sql and post_sql.strip() else []
    run_statements(df.sparkSession, url, [*merge, *last, f"delete from {stage}"], **login)
