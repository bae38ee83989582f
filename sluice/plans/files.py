"""Registered queries of file formats, publishing, counted jobs, scripts and user functions."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from sluice.functions import coerce as C
from sluice.functions.render import row_shape
from sluice.operators import process as P
from sluice.operators.documents import bulk_requests, to_bulk_docs
from sluice.plans.catalog import query
from sluice.plans.job import Source, Target, TransferJob
from sluice.plans.tables import register_views, scratch_path, table
from sluice.sinks.checksum import verify_checksums, write_manifest
from sluice.sinks.documents import write_bulk
from sluice.sinks.noop import write_noop
from sluice.sinks.sequence import write_sequence
from sluice.sinks.table import write_table, write_upsert
from sluice.sinks.text import write_delimited, write_mode
from sluice.sources.inventory import list_files
from sluice.sources.sequence import scan_sequence_typed
from sluice.sources.sql_script import scan_sql, scan_sql_template
from sluice.sources.table import scan_select, scan_table
from sluice.sources.text import scan_codec, scan_delimited, scan_text

# ---- jobs that count their steps --------------------------------------------------------


@query("transfer_counts", """
WITH o AS (SELECT o_orderstatus = 'F' AS f, o_orderkey % 3 = 0 AS third, o_orderkey % 2 = 0 AS even, o_totalprice > 100000 AS dear FROM orders),
     step(target, step, rows_in, rows_out) AS (
  SELECT 'even', 'source 1.0', count(*) FILTER (f), count(*) FILTER (f) FROM o
  UNION ALL SELECT 'even', 'source 1.1', count(*) FILTER (NOT f), count(*) FILTER (NOT f) FROM o
  UNION ALL SELECT 'even', 'input 1.0', count(*), count(*) FILTER (NOT third) FROM o
  UNION ALL SELECT 'even', 'output 0', count(*) FILTER (NOT third), count(*) FILTER (NOT third AND even) FROM o
  UNION ALL SELECT 'all', 'source 1.0', count(*) FILTER (f), count(*) FILTER (f) FROM o
  UNION ALL SELECT 'all', 'source 1.1', count(*) FILTER (NOT f), count(*) FILTER (NOT f) FROM o
  UNION ALL SELECT 'all', 'input 1.0', count(*), count(*) FILTER (NOT third) FROM o
  UNION ALL SELECT 'all', 'source 2.0', count(*) FILTER (dear), count(*) FILTER (dear) FROM o
  UNION ALL SELECT 'all', 'input 2.0', count(*) FILTER (dear), count(*) FILTER (dear AND NOT third) FROM o
  UNION ALL SELECT 'even', 'written', count(*) FILTER (NOT third AND even), count(*) FILTER (NOT third AND even) FROM o
  UNION ALL SELECT 'all', 'written', count(*) FILTER (NOT third) + count(*) FILTER (dear AND NOT third), count(*) FILTER (NOT third) + count(*) FILTER (dear AND NOT third) FROM o
)
SELECT target, step, CAST(rows_in AS BIGINT) AS rows_in, CAST(rows_out AS BIGINT) AS rows_out, CAST(rows_in - rows_out AS BIGINT) AS dropped FROM step
""")
def q_transfer_counts(spark, sf_dir):
    """Rows in, dropped and out at every source, processor and target of one job."""
    orders = lambda s: table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    job = TransferJob(
        sources=[Source("1", lambda s: orders(s).where("o_orderstatus = 'F'")), Source("1", lambda s: orders(s).where("o_orderstatus <> 'F'")),
                 Source("2", lambda s: orders(s).where("o_totalprice > 100000"))],
        input_transforms=[P.filter_row("o_orderkey % 3 <> 0")],
        targets=[Target("even", "1", write_noop, [P.filter_row("o_orderkey % 2 = 0")]), Target("all", "1,2", write_noop)], count_steps=True)
    report = job.run(spark)
    if not report.reconciled():
        raise RuntimeError(f"rows in, dropped and out do not agree: {report.steps}")
    rows = [(s.target, s.step, s.rows_in, s.rows_out, s.dropped) for s in report.steps] + [(t.target, "written", t.rows, t.rows, 0) for t in report.targets]
    return spark.createDataFrame(rows, "target string, step string, rows_in bigint, rows_out bigint, dropped bigint")


@query("transfer_all_id", """
SELECT 'a' AS target, CAST(count(*) FILTER (o_orderstatus = 'F') + count(*) FILTER (o_orderstatus = 'P') AS BIGINT) AS rows FROM orders
UNION ALL SELECT 'b', CAST(count(*) FILTER (o_orderstatus = 'O') + count(*) FILTER (o_orderstatus = 'P') AS BIGINT) FROM orders
""")
def q_transfer_all_id(spark, sf_dir):
    """A source with the id ``ALL`` feeds every target."""
    part = lambda v: lambda s: table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").where(F.col("o_orderstatus") == v)
    job = TransferJob([Source("1", part("F")), Source("2", part("O")), Source("ALL", part("P"))], [Target("a", "1", write_noop), Target("b", "2", write_noop)])
    return spark.createDataFrame([(t.target, t.rows) for t in job.run(spark).targets], "target string, rows bigint")


# ---- publishing -------------------------------------------------------------------------


@query("upsert_partitioned", """
SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (1, 2) AND o_orderkey % 4 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS v,
       CAST(month(o_orderdate) AS INT) AS m FROM orders
""")
def q_upsert_partitioned(spark, sf_dir):
    """An upsert reads and replaces the touched partitions only, by stage, manifest and swap."""
    path = scratch_path(spark, "publish")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("v"), F.month("o_orderdate").alias("m"))
    write_table(rows, path=path, partition_cols=["m"])
    write_upsert(rows.where("m IN (1, 2) AND o_orderkey % 4 = 0").withColumn("v", F.col("v") + 1), ["o_orderkey", "m"], path=path, partition_cols=["m"])
    return scan_table(spark, path=path)


@query("write_modes", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
def q_write_modes(spark, sf_dir):
    """K2: mode 1 replaces what is there, mode 2 refuses to."""
    path = scratch_path(spark, "modes")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    write_delimited(rows, path, "|", mode=write_mode(2))
    write_delimited(rows.where("o_orderstatus <> 'F'"), path, "|", mode=write_mode(1))
    try:
        write_delimited(rows, path, "|", mode=write_mode(2))
    except Exception as e:
        if "PATH_ALREADY_EXISTS" not in str(e):
            raise
    else:
        raise RuntimeError("mode 2 wrote over a target")
    return scan_delimited(spark, path, ["o_orderkey", "o_orderstatus"], "|").select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderstatus")


@query("sized_files", """
SELECT event_type, CAST(ceil(sum(length(line) + 1) / 20000.0) AS BIGINT) AS files, CAST(sum(length(line) + 1) AS BIGINT) AS bytes
FROM (SELECT event_type, event_id || '|' || user_id || '|' || props AS line FROM events) GROUP BY event_type
""")
def q_sized_files(spark, sf_dir):
    """Each partition value gets as many files as its bytes need."""
    path = scratch_path(spark, "sized")
    write_delimited(table(spark, sf_dir, "events").select("event_id", "user_id", "props", "event_type"), path, "|", file_bytes=20_000, partition_cols=["event_type"])
    files = list_files(spark, path).withColumn("event_type", F.regexp_extract("path", "event_type=([^/]+)/", 1))
    return files.groupBy("event_type").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


@query("verify_checksums", """
SELECT segment, CASE WHEN segment = 'AUTOMOBILE' THEN 'missing' WHEN segment = 'BUILDING' THEN 'changed' ELSE 'ok' END AS status
FROM (SELECT DISTINCT c_mktsegment AS segment FROM customer) UNION ALL SELECT 'NEW', 'extra'
""")
def q_verify_checksums(spark, sf_dir):
    """A manifest finds what became of the files that it knows."""
    path = scratch_path(spark, "manifest")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment").repartition("c_mktsegment").sortWithinPartitions("c_custkey")
    rows.write.partitionBy("c_mktsegment").csv(path)
    write_manifest(spark, path)
    write_table(rows.where("false").drop("c_mktsegment"), path=path, fmt="csv", partition={"c_mktsegment": "AUTOMOBILE"})
    write_table(rows.where("c_mktsegment = 'BUILDING'").drop("c_mktsegment"), path=path, fmt="csv", partition={"c_mktsegment": "NEW"})
    # the manifest gets another sum for one segment, as if its file had been changed since
    known = spark.read.parquet(f"{path}/_sluice_md5")
    altered = known.withColumn("md5", F.when(F.col("file").contains("BUILDING"), "0").otherwise(F.col("md5")))
    write_table(altered, path=f"{path}/_sluice_md5")
    return verify_checksums(spark, path).select(F.regexp_extract("file", "c_mktsegment=([^/]+)/", 1).alias("segment"), "status")


@query("bulk_volume", """
SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(length(line) + 1) AS BIGINT) AS bytes, 0::BIGINT AS over_actions, 0::BIGINT AS over_bytes, 0::BIGINT AS cut
FROM (SELECT '{"index":{"_index":"e","_id":"' || event_id || '"}}' || chr(10) || '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS line FROM events)
""")
def q_bulk_volume(spark, sf_dir):
    """K9: bulk files hold at most 200 documents and 10000 bytes, and all of them together every document."""
    path = scratch_path(spark, "bulk")
    docs = table(spark, sf_dir, "events").select("event_id", "event_type").transform(to_bulk_docs("e", id_col="event_id"))
    write_bulk(docs, path, max_actions=200, max_bytes=10_000)
    requests = bulk_requests(docs, 200, 10_000).agg(F.max("n_docs").alias("most_docs"))
    lines = scan_text(spark, path, with_path=True).groupBy("path").agg(F.count(F.when(F.col("value").startswith('{"index"'), 1)).alias("docs"), F.count("*").alias("lines"),
                                                                       F.sum(F.octet_length("value") + 1).cast("bigint").alias("bytes"))
    over = lambda c: F.count(F.when(c, 1))
    return (lines.crossJoin(requests)  # one row
            .agg(F.sum("docs").alias("docs"), F.sum("bytes").alias("bytes"), over((F.col("docs") > 200) | (F.col("most_docs") > 200)).alias("over_actions"),
                 over(F.col("bytes") > 10_000).alias("over_bytes"), over(F.col("lines") != 2 * F.col("docs")).alias("cut")))


# ---- formats and charsets ---------------------------------------------------------------


@query("charset_wide_roundtrip", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, translate(text, chr(9) || chr(10) || chr(13), '   ') || '਀ਊ' AS text FROM documents")
def q_charset_wide(spark, sf_dir):
    """UTF-16 lines, with characters whose bytes look like line feeds."""
    path = scratch_path(spark, "wide")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.translate("text", "\t\n\r", "   "), F.lit("਀ਊ")).alias("text"))
    write_delimited(docs.where("doc_id % 2 = 0"), path + "/le", "\\t", encode="UTF-16LE")
    write_delimited(docs.where("doc_id % 2 <> 0"), path + "/be", "\\t", encode="UTF-16BE")
    fields = ["doc_id", "text"]
    return scan_delimited(spark, path + "/le", fields, "\\t", encode="UTF-16LE").unionAll(scan_delimited(spark, path + "/be", fields, "\\t", encode="UTF-16BE"))


@query("separator_roundtrip", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text FROM documents")
def q_separator(spark, sf_dir):
    """Records end with a character of the caller's choice, so texts keep their line feeds."""
    path = scratch_path(spark, "separator")
    write_delimited(table(spark, sf_dir, "documents").select("doc_id", "text"), path, "\\001", line_delim="\\003")
    return scan_delimited(spark, path, ["doc_id", "text"], "\\001", line_delim="\\003")


@query("reencode_charsets", "SELECT doc_id, text AS back, octet_length(encode(text)) AS chars FROM documents")
def q_reencode(spark, sf_dir):
    """UTF-8 bytes read as Latin-1 have a character a byte, and can be read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", C.reencode("text", "UTF-8", "ISO-8859-1").alias("t"))
    return docs.select("doc_id", C.reencode("t", "ISO-8859-1", "UTF-8").alias("back"), F.char_length("t").cast("bigint").alias("chars"))


@query("codec_split", "SELECT CAST(event_id AS VARCHAR) || '|' || props AS value FROM events UNION ALL SELECT CAST(event_id AS VARCHAR) || '|' || props FROM events")
def q_codec_split(spark, sf_dir):
    """Codecs named in config; bzip2 files are split at their blocks."""
    path = scratch_path(spark, "codec")
    rows = table(spark, sf_dir, "events").select("event_id", "props")
    write_delimited(rows, path + "/bz", "|", compression="bzip2")
    write_delimited(rows, path + "/gz", "|", compression="gzip")
    return scan_codec(spark, path + "/bz", "bzip2", range_bytes=1 << 14).unionAll(scan_codec(spark, path + "/gz", "GzipCodec", range_bytes=1 << 14))


@query("sequence_typed_roundtrip", "SELECT o_orderkey AS key, o_totalprice AS value FROM orders")
def q_sequence_typed(spark, sf_dir):
    """S3/K4: long keys and double values in compressed blocks, read by ranges."""
    path = scratch_path(spark, "typed")
    write_sequence(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), path, "o_orderkey", codec="gzip", compression="BLOCK",
                   key_class="LongWritable", value_class="DoubleWritable")
    return scan_sequence_typed(spark, path, range_bytes=1 << 14)


@query("json_rows", "SELECT json_object('id', event_id, 'kind', event_type, 'none', NULL)::VARCHAR AS value FROM events")
def q_json_rows(spark, sf_dir):
    """The ``COLUMNS`` shape, NULL included."""
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.lit(None).cast("string").alias("none"))
    return rows.transform(row_shape("COLUMNS"))


@query("select_builder", "SELECT o_orderkey, upper(o_orderpriority) AS p FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'")
def q_select_builder(spark, sf_dir):
    """Columns and a condition as text."""
    return scan_select(table(spark, sf_dir, "orders"), "o_orderkey, upper(o_orderpriority) AS p", "o_totalprice > 100000 AND o_orderstatus = 'F'")


@query("line_null_tokens", r"""
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN '\N' ELSE l_returnflag END || '|' || l_linestatus || '|' || CASE WHEN l_linenumber % 3 = 0 THEN '\N' ELSE 'x' END AS encoded,
       l_returnflag || '||' || CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE 'x' END AS decoded
FROM lineitem
""")
def q_line_null_tokens(spark, sf_dir):
    """E12 on whole lines: empty fields become tokens, and whole-field ``NULL`` becomes empty."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    last = F.when(F.col("l_linenumber") % 3 == 0, "").otherwise("x")
    plain = F.concat_ws("|", F.when(F.col("l_linenumber") % 2 == 0, "").otherwise(flag), status, last)
    nulls = F.concat_ws("|", flag, F.lit("NULL"), F.when(F.col("l_linenumber") % 3 == 0, "NULL").otherwise("x"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", C.encode_line_nulls(plain, "|").alias("encoded"), C.decode_line_nulls(nulls, "|").alias("decoded"))


# ---- scripts and user functions ---------------------------------------------------------


@query("scan_sql_template", """
SELECT o_orderkey, strftime(o_orderdate, '%m') AS m, o_orderstatus AS s FROM orders
WHERE month(o_orderdate) IN (1, 2, 3) AND o_orderstatus IN ('F', 'O')
""")
def q_sql_template(spark, sf_dir):
    """S16 into S9: a statement for every month and status, the values bound to its markers."""
    register_views(spark, sf_dir, ["orders"])
    statement = "SELECT o_orderkey, :m AS m, o_orderstatus AS s FROM orders WHERE date_format(o_orderdate, 'MM') = :m AND o_orderstatus = :s"
    return scan_sql_template(spark, statement, {"m": "${enum:1~4,2}", "s": "${enum:F,O,1}"})


def _net(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A user's processor: lines with a discount, and what is left of their price in cents."""
    batch = batch.filter(pc.greater(batch.column("l_discount"), 0.0))
    cents = pc.round(pc.multiply(pc.multiply(batch.column("l_extendedprice"), pc.subtract(1.0, batch.column("l_discount"))), 100.0))
    return pa.RecordBatch.from_arrays([batch.column("l_orderkey"), batch.column("l_linenumber"), cents.cast(pa.int64())], names=["l_orderkey", "l_linenumber", "net"])


@query("user_processor", """
SELECT l_orderkey, l_linenumber, CAST(round_even(l_extendedprice * (1 - l_discount) * 100, 0) AS BIGINT) AS net FROM lineitem WHERE l_discount > 0
""")
def q_user_processor(spark, sf_dir):
    """A user's processor over Arrow batches with a declared schema."""
    columns = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_discount"]
    return table(spark, sf_dir, "lineitem").transform(P.map_batches(_net, "l_orderkey bigint, l_linenumber int, net bigint", columns))


@query("script_functions", """
SELECT event_id, upper(event_type) || '!' AS shout, part AS word, CAST(event_id % 7 AS BIGINT) AS seventh
FROM (SELECT event_id, event_type, unnest(string_split(event_type || ' ' || user_id, ' ')) AS part FROM events)
""")
def q_script_functions(spark, sf_dir):
    """Scalar and table functions, some given from Python and one made by the script."""
    register_views(spark, sf_dir, ["events"])

    @F.pandas_udf("string")
    def shout(values):
        return values.str.upper() + "!"

    @F.udtf(returnType="word string")
    class Words:
        def eval(self, text: str):
            for w in text.split(" "):
                yield (w,)

    return scan_sql(spark, """
CREATE OR REPLACE TEMPORARY FUNCTION sluice_seventh(x BIGINT) RETURNS BIGINT RETURN x % 7;
SELECT event_id, sluice_shout(event_type) AS shout, w.word, sluice_seventh(event_id) AS seventh
FROM events, LATERAL sluice_words(concat(event_type, ' ', user_id)) w
""", {"sluice_shout": shout, "sluice_words": Words})
