"""Registered queries for the inputs that ordinary rows never contain.

NULL keys and partitions, rows that change their partition, empty sources, padded partition
values, commented SQL, decimals with many digits, values that end in a newline, and cell versions.
All inputs are derived from the driver's tables, in Spark and in the oracle alike.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.coerce import normalize_numeric
from sluice.operators.cells import cells_to_rows
from sluice.operators.documents import to_bulk_docs
from sluice.operators.upsert import upsert
from sluice.operators.validate import check_fields
from sluice.plans.catalog import query
from sluice.plans.tables import register_views, scratch_path, table
from sluice.sinks.table import write_table, write_upsert
from sluice.sources.sql_script import scan_sql
from sluice.sources.table import scan_table, scan_table_template
from sluice.sources.text import scan_glob

_NAMED = """
WITH orders_k AS (
  SELECT CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey END AS k, o_totalprice AS v, o_orderkey AS id FROM orders
)
"""


def _keyed(spark, sf_dir):
    key = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey"))
    return table(spark, sf_dir, "orders").select(key.alias("k"), F.col("o_totalprice").alias("v"), F.col("o_orderkey").alias("id"))


@query("upsert_null_keys", _NAMED + """
SELECT k, v, id FROM orders_k WHERE id % 2 = 0 AND (k IS NULL OR k % 3 <> 0)
UNION ALL SELECT k, v + 1, id FROM orders_k WHERE k IS NULL OR k % 3 = 0
""")
def q_upsert_null_keys(spark, sf_dir):
    """Rows without a key neither replace nor merge with each other."""
    rows = _keyed(spark, sf_dir)
    incoming = rows.where("k IS NULL OR k % 3 = 0").withColumn("v", F.col("v") + 1)
    return upsert(rows.where("id % 2 = 0"), incoming, ["k"], mode="replace", order="id")


@query("upsert_moved_partition", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'moved' ELSE o_orderstatus END AS dt FROM orders
""")
def q_upsert_moved(spark, sf_dir):
    """A row whose partition changes leaves none behind in the old one."""
    path = scratch_path(spark, "moved")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("dt"))
    write_table(rows, path=path, partition_cols=["dt"])
    write_upsert(rows.where("o_orderkey % 5 = 0").withColumn("dt", F.lit("moved")), ["o_orderkey"], path=path, partition_cols=["dt"])
    return scan_table(spark, path=path)


@query("upsert_null_partition", """
SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS v,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END AS dt
FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderkey % 10 = 0)
UNION ALL SELECT o_orderkey, o_totalprice, NULL FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 10 = 0
UNION ALL SELECT o_orderkey, o_totalprice + 1, NULL FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 10 = 0
""")
def q_upsert_null_partition(spark, sf_dir):
    """Rows of the NULL partition survive an upsert into it; a NULL in the key equals nothing."""
    path = scratch_path(spark, "nullpart")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("v"), F.nullif("o_orderstatus", F.lit("F")).alias("dt"))
    write_table(rows, path=path, partition_cols=["dt"])
    write_upsert(rows.where("o_orderkey % 10 = 0").withColumn("v", F.col("v") + 1), ["o_orderkey", "dt"], path=path, partition_cols=["dt"])
    return scan_table(spark, path=path)


@query("table_overwrite_empty", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'")
def q_overwrite_empty(spark, sf_dir):
    """An empty source empties the partition it names."""
    path = scratch_path(spark, "empty")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    write_table(rows, path=path, partition_cols=["c_mktsegment"])
    write_table(rows.where("c_custkey < 0").select("c_custkey"), path=path, partition={"c_mktsegment": "BUILDING"})
    return scan_table(spark, path=path)


@query("table_overwrite_whole", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'MACHINERY'")
def q_overwrite_whole(spark, sf_dir):
    """Without a partition spec the whole table is replaced."""
    path = scratch_path(spark, "whole")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    write_table(rows, path=path, partition_cols=["c_mktsegment"])
    write_table(rows.where("c_mktsegment = 'MACHINERY'"), path=path, partition_cols=["c_mktsegment"])
    return scan_table(spark, path=path)


@query("bulk_docs_null_id", _NAMED + """
SELECT CAST(k AS VARCHAR) AS doc_id,
       CASE WHEN k IS NULL THEN '{"index":{"_index":"i"}}' ELSE '{"index":{"_index":"i","_id":"' || k || '"}}' END AS action,
       '{"id":' || id || '}' AS doc
FROM orders_k
""")
def q_bulk_null_id(spark, sf_dir):
    return _keyed(spark, sf_dir).transform(to_bulk_docs("i", id_col="k", order="id", doc_cols=["id"]))


@query("scan_sql_comments", """
SELECT o_orderstatus || ';' AS a, o_orderkey AS k FROM orders
UNION ALL SELECT l_returnflag, l_orderkey FROM lineitem WHERE l_linenumber = 1
UNION ALL SELECT o_orderpriority || '-- not; a /* comment', o_orderkey FROM orders WHERE o_orderkey % 5 = 0
""")
def q_sql_comments(spark, sf_dir):
    """Semicolons in comments and quotes end no statement."""
    register_views(spark, sf_dir, ["orders", "lineitem"])
    return scan_sql(spark, r"""-- orders first; then lines
SELECT o_orderstatus || ';' AS a, o_orderkey AS k FROM orders; /* then; /* nested; */ lines */
(SELECT /*+ REPARTITION(4) */ l_returnflag, l_orderkey FROM lineitem WHERE l_linenumber = 1);
CREATE OR REPLACE TEMP VIEW sluice_fifth AS SELECT o_orderpriority AS p, o_orderkey AS k FROM orders WHERE o_orderkey % 5 = 0;
SELECT(concat(p, "-- not\; a /* comment")), k FROM sluice_fifth; -- the end""")


@query("table_partition_padded", "SELECT o_orderkey FROM orders WHERE month(o_orderdate) = 1")
def q_partition_padded(spark, sf_dir):
    path = scratch_path(spark, "padded")
    write_table(table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "MM").alias("m")), path=path, partition_cols=["m"])
    return scan_table(spark, path=path, partition="m=01").select("o_orderkey")


@query("table_partition_template", "SELECT o_orderkey, month(o_orderdate) AS m FROM orders WHERE month(o_orderdate) IN (1, 2, 3)")
def q_partition_template(spark, sf_dir):
    """A partition template becomes one pruned scan of all the partitions that it names."""
    path = scratch_path(spark, "template")
    write_table(table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "MM").alias("m")), path=path, partition_cols=["m"])
    return scan_table_template(spark, path=path, partition="m=${enum:1~4,2}").select("o_orderkey", F.col("m").cast("bigint").alias("m"))


@query("normalize_numeric_wide", """
SELECT l_orderkey, l_linenumber,
       CAST(CASE WHEN l_linenumber = 1 THEN l_quantity + 0.01 ELSE l_quantity END AS DECIMAL(38, 2)) AS q
FROM lineitem
""")
def q_numeric_wide(spark, sf_dir):
    """Digits far behind the target scale still round up."""
    tiny = F.when(F.col("l_linenumber") == 1, F.lit("0.0000000001")).otherwise("0").cast("decimal(30,10)")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity").cast("decimal(20,10)") + tiny).alias("q"))
    return normalize_numeric(rows, ["q"], scale=2, mode="up")


@query("validate_newline", """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'v:regex' ELSE '' END AS errors FROM orders
""")
def q_validate_newline(spark, sf_dir):
    value = F.when(F.col("o_orderkey") % 2 == 0, F.concat("o_orderpriority", F.lit("\n"))).otherwise(F.col("o_orderpriority"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", value.alias("v"))
    return rows.transform(check_fields({"v": [("regex", "[A-Z0-9 -]+")]})).select("o_orderkey", F.array_join("_errors", ";").alias("errors"))


@query("cells_latest", """
SELECT CAST(user_id AS VARCHAR) AS rowkey, arg_max(CAST(event_id AS VARCHAR), event_id) AS f_last FROM events GROUP BY user_id
""")
def q_cells_latest(spark, sf_dir):
    """The newest version of a cell wins, not the greatest text."""
    cells = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("rowkey"), F.lit("f").alias("family"), F.lit("last").alias("qualifier"),
        F.col("event_id").cast("string").alias("value"), F.col("event_id").alias("version"))
    return cells.transform(cells_to_rows("f", "last", ts_col="version"))


@query("scan_glob_space", "SELECT CAST(event_id AS VARCHAR) AS value FROM events")
def q_glob_space(spark, sf_dir):
    """A ``**`` pattern below a folder with a space and a plus sign in its name."""
    root = scratch_path(spark, "glob")
    table(spark, sf_dir, "events").select(F.col("event_id").cast("string")).write.text(f"{root}/a b+c/d")
    return scan_glob(spark, root, "**/part-*")
