"""Round-trip queries: write a whole table through a sink, read it back through a source.

Each call writes to a fresh folder under the cluster's shared checkpoint dir (never a
machine-local temp dir); the returned frame reads what was written.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.operators.documents import to_bulk_docs
from sluice.operators.process import split_line
from sluice.plans import catalog
from sluice.plans.catalog import query
from sluice.plans.job import Source, Target, TransferJob
from sluice.plans.tables import scratch_path, table
from sluice.sinks.checksum import write_checksums
from sluice.sinks.documents import write_bulk, write_documents
from sluice.sinks.sequence import write_sequence
from sluice.sinks.table import write_table, write_upsert
from sluice.sinks.text import write_delimited
from sluice.sources.inventory import file_inventory
from sluice.sources.sequence import scan_sequence
from sluice.sources.table import scan_table
from sluice.sources.text import scan_delimited, scan_text

CUSTOMER_TEXT = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
_CUSTOMER_TEXT_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment
FROM customer
"""


@query("delimited_roundtrip", _CUSTOMER_TEXT_SQL)
def q_delimited_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "delimited")
    write_delimited(table(spark, sf_dir, "customer"), path, "\\001", cols=CUSTOMER_TEXT, compression="gzip")
    return scan_delimited(spark, path, CUSTOMER_TEXT, "\\001")


@query("charset_roundtrip", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name || ' 中文字é€' AS c_name, c_mktsegment FROM customer
""")
def q_charset_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "gbk")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.concat("c_name", F.lit(" 中文字é€")).alias("c_name"), "c_mktsegment")
    write_delimited(rows, path, "\\t", encode="GBK")
    return scan_delimited(spark, path, ["c_custkey", "c_name", "c_mktsegment"], "\\t", encode="GBK")


PART_FIELDS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]


@query("sequence_roundtrip", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size FROM part
""")
def q_sequence_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "sequence")
    write_sequence(table(spark, sf_dir, "part"), path, key_field="p_partkey", field_delim="\\t", cols=PART_FIELDS)
    lines = scan_sequence(spark, path, ignore_key=False, field_delim="\\t")
    return lines.transform(split_line(PART_FIELDS, "\\t"))


@query("table_overwrite", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name || '*' ELSE c_name END AS c_name,
       c_nationkey, c_mktsegment
FROM customer
""")
def q_table_overwrite(spark, sf_dir):
    path = scratch_path(spark, "table")
    cust = table(spark, sf_dir, "customer").select(*CUSTOMER_TEXT)
    write_table(cust, path=path, partition_cols=["c_mktsegment"])
    # overwrite exactly one partition; the other segments must survive untouched
    building = scan_table(spark, path=path, partition="BUILDING", partition_cols=["c_mktsegment"])
    changed = building.withColumn("c_name", F.concat("c_name", F.lit("*"))).drop("c_mktsegment")
    write_table(_materialize(spark, changed), path=path, partition={"c_mktsegment": "BUILDING"})
    return scan_table(spark, path=path).select(*CUSTOMER_TEXT)


def _materialize(spark, df):
    """Reading and overwriting one partition in the same job: cut the lineage first by
    writing the new rows to the shared checkpoint area (a written table survives
    executor loss, unlike cached blocks)."""
    stage = scratch_path(spark, "stage")
    df.write.mode("overwrite").parquet(stage)
    return spark.read.parquet(stage)


@query("table_partition_scan", """
SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_mktsegment = 'MACHINERY'
""")
def q_table_partition_scan(spark, sf_dir):
    path = scratch_path(spark, "table")
    write_table(table(spark, sf_dir, "customer").select(*CUSTOMER_TEXT), path=path, partition_cols=["c_mktsegment"])
    return scan_table(spark, path=path, partition="MACHINERY", partition_cols=["c_mktsegment"]) \
        .select("c_custkey", "c_name", "c_nationkey")


@query("bulk_docs_roundtrip", """
WITH last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
                             FROM events) WHERE rn = 1)
SELECT '{"index":{"_index":"events","_id":"' || CAST(user_id AS VARCHAR) || '"}}' AS value FROM last
UNION ALL
SELECT json_object('event_id', event_id, 'user_id', user_id, 'event_type', event_type)::VARCHAR FROM last
""")
def q_bulk_docs_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "bulk")
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    write_bulk(ev.transform(to_bulk_docs("events", id_col="user_id", order="event_id")), path)
    return scan_text(spark, path)


@query("documents_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def q_documents_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "docs")
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"), "c_name",
        F.col("c_nationkey").cast("string").alias("c_nationkey"), "c_acctbal")
    write_documents(cust, path, {"c_custkey": "long", "c_name": "string", "c_nationkey": "int",
                                 "c_acctbal": "double"})
    return spark.read.schema("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double").json(path)


@query("checksum_sidecar", """
SELECT c_mktsegment AS segment,
       md5(string_agg(c_custkey || chr(1) || c_name || chr(1) || c_nationkey || chr(10), '' ORDER BY c_custkey)) AS md5
FROM customer GROUP BY c_mktsegment
""")
def q_checksum_sidecar(spark, sf_dir):
    """One sorted file a segment, so that its sum is known beforehand."""
    path = scratch_path(spark, "md5")
    rows = table(spark, sf_dir, "customer").select(*CUSTOMER_TEXT).repartition("c_mktsegment").sortWithinPartitions("c_mktsegment", "c_custkey")
    write_delimited(rows, path, "\\001", partition_cols=["c_mktsegment"])
    write_checksums(spark, path)
    sidecars = scan_text(spark, f"{path}/*/_md5/*.md5", with_path=True)
    return sidecars.select(F.regexp_extract("path", "c_mktsegment=([^/]+)/", 1).alias("segment"), F.split("value", " ").getItem(0).alias("md5"))


@query("file_inventory", """
SELECT 'seq' AS dir, 'sequence' AS type, CAST(NULL AS BIGINT) AS bytes
UNION ALL
SELECT 'txt', 'unknown', CAST(sum(octet_length(encode(c_custkey || chr(9) || c_name || chr(9) || c_nationkey || chr(9) || c_mktsegment)) + 1) AS BIGINT) FROM customer
""")
def q_file_inventory(spark, sf_dir):
    """Types of the files in two folders, and the bytes of the text files (a sequence file has marks of its own)."""
    path = scratch_path(spark, "inventory")
    write_sequence(table(spark, sf_dir, "part"), path + "/seq", key_field="p_partkey", cols=PART_FIELDS)
    write_delimited(table(spark, sf_dir, "customer"), path + "/txt", cols=CUSTOMER_TEXT)
    found = file_inventory(spark, path).withColumn("dir", F.regexp_extract("path", r"/(seq|txt)/", 1))
    return found.groupBy("dir", "type").agg(F.sum(F.when(F.col("dir") == "txt", F.col("length"))).alias("bytes"))


def _job_report(spark, sf_dir):
    base = scratch_path(spark, "job")
    cols = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    orders = lambda s: table(spark, sf_dir, "orders").select(*cols)
    job = TransferJob(
        sources=[Source("1", lambda s: orders(s).filter(F.col("o_orderstatus") == "F")),
                 Source("1", lambda s: orders(s).filter(F.col("o_orderstatus") != "F")),
                 Source("2", lambda s: orders(s).filter(F.col("o_orderstatus") == "P"))],
        targets=[Target("lines", "1", lambda d: write_delimited(d, base + "/lines", "|")),
                 Target("table", "1,2", lambda d: write_table(d, path=base + "/table")),
                 Target("dry", "2", lambda d: d.write.format("noop").mode("overwrite").save())],
    )
    return job.run(spark)


@query("transfer_job", """
WITH o AS (SELECT o_orderkey, o_orderstatus, o_orderpriority,
                  length(concat_ws(chr(9), CAST(o_orderkey AS VARCHAR), o_orderstatus, o_orderpriority)) AS len
           FROM orders)
SELECT 'lines' AS target, CAST(count(*) AS BIGINT) AS rows, CAST(sum(len) AS BIGINT) AS chars FROM o
UNION ALL
SELECT 'table', CAST(count(*) AS BIGINT), CAST(sum(len) AS BIGINT)
FROM (SELECT * FROM o UNION ALL SELECT * FROM o WHERE o_orderstatus = 'P')
UNION ALL
SELECT 'dry', CAST(count(*) AS BIGINT), CAST(sum(len) AS BIGINT) FROM o WHERE o_orderstatus = 'P'
""")
def q_transfer_job(spark, sf_dir):
    report = _job_report(spark, sf_dir)
    rows = [(t.target, t.rows, t.chars) for t in report.targets]
    return spark.createDataFrame(rows, "target string, rows bigint, chars bigint")


@query("upsert_table", catalog.REGISTRY["upsert_replace"][1])
def q_upsert_table(spark, sf_dir):
    """K6 as a sink: the existing rows live in a table; the merged table is read back."""
    existing, incoming = catalog._upsert_inputs(spark, sf_dir)
    path = scratch_path(spark, "upsert-table")
    write_table(existing, path=path)
    write_upsert(incoming, ["o_orderkey"], path=path, mode="replace", order="version")
    return spark.read.parquet(path)
