import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.functions.render import render_line
from sluice.sinks.jdbc import write_jdbc
from sluice.sinks.text import write_delimited, write_mode
from sluice.sources.inventory import classify_header, file_inventory
from sluice.sources.jdbc import build_select, normalize_jdbc, scan_jdbc
from sluice.sources.sql_script import scan_sql, split_statements
from sluice.sources.table import parse_partition_spec
from sluice.sources.text import glob_to_regex, scan_delimited, scan_glob, scan_template, scan_text


def local(p):
    return p.replace("file:", "")


def test_partition_spec():
    assert parse_partition_spec("k=v;k2=v2") == {"k": "v", "k2": "v2"}
    assert parse_partition_spec("20151101", ["load_date", "x"]) == {"load_date": "20151101"}
    with pytest.raises(ValueError):
        parse_partition_spec("20151101")


def test_magic_bytes():
    assert classify_header(b"SEQ\x06" + b"x" * 19 + b"hive") == "rcfile"
    assert classify_header(b"SEQ\x06org.apache.hadoop") == "sequence"
    assert classify_header(b"Obj\x01") == "avro"
    assert classify_header(b"RCF\x01\x00\x00") == "rcfile"
    assert classify_header(b"") == "text"
    assert classify_header(b"hello") == "unknown"


def test_write_modes():
    assert write_mode(1) == "overwrite" and write_mode("2") == "errorifexists" and write_mode("9") == "overwrite"


def test_split_statements():
    assert split_statements(r"select 1; select 'a\;b' ;;") == ["select 1", "select 'a;b'"]


def test_scan_sql_concatenates_queries(spark):
    script = "CREATE OR REPLACE TEMP VIEW t AS SELECT id FROM range(5); SELECT id FROM t WHERE id < 2; SELECT 9"
    assert sorted(r[0] for r in scan_sql(spark, script).collect()) == [0, 1, 9]


def test_gbk_and_malformed_utf8(spark, outdir):
    os.makedirs(local(outdir), exist_ok=True)
    p = os.path.join(local(outdir), "gbk.txt")
    with open(p, "wb") as f:
        f.write("中文\t一\n第二行\tb\n".encode("gbk"))
    rows = scan_delimited(spark, p, ["a", "b"], "\\t", encode="GBK").collect()
    assert [tuple(r) for r in rows] == [("中文", "一"), ("第二行", "b")]
    q = os.path.join(local(outdir), "bad.txt")
    with open(q, "wb") as f:
        f.write(b"ok\xff\xfeend\n")
    assert scan_text(spark, q).first().value == "ok\ufffd\ufffdend"


def test_custom_line_separator_and_compression(spark, outdir):
    df = spark.createDataFrame([("a", "1"), ("b", None)], "x string, y string")
    write_delimited(df, outdir + "/t", "\\001", line_delim="\\u007f", compression="gzip")
    files = os.listdir(local(outdir) + "/t")
    assert any(f.endswith(".gz") for f in files)
    back = scan_delimited(spark, outdir + "/t", ["x", "y"], "\\001", line_delim="\\u007f")
    assert sorted(tuple(r) for r in back.collect()) == [("a", "1"), ("b", "")]


def test_glob_and_template_paths(spark, outdir):
    root = local(outdir) + "/g"
    for d in ["dt=20151031/000000", "dt=20151031/000001", "dt=20151031/000002", "other/x"]:
        os.makedirs(os.path.join(root, d), exist_ok=True)
        with open(os.path.join(root, d, "part-0"), "w") as f:
            f.write(d + "\n")
    assert glob_to_regex("**/part-*") == "(?:[^/]*/)*part\\-[^/]*"
    got = sorted(r.value for r in scan_glob(spark, root, "dt=*/**/part-*").collect())
    assert got == ["dt=20151031/000000", "dt=20151031/000001", "dt=20151031/000002"]
    tpl = root + "/dt=${time:yyyyMMdd,-1d}/${enum:0~2,6}"
    got = sorted(r.value for r in scan_template(spark, tpl, "20151101000000").collect())
    assert got == ["dt=20151031/000000", "dt=20151031/000001"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="ab\t\n\x01\\ é", max_size=8), st.text(alphabet="xy\t\n", max_size=5)),
                min_size=1, max_size=10))
def test_render_write_scan_roundtrip_property(spark, rows):
    """Escaped lines survive a text write + scan: one row per record, escapes intact."""
    from sluice.plans.tables import scratch_path
    df = spark.createDataFrame(rows, "a string, b string")
    lines = df.transform(render_line("\\002"))
    path = scratch_path(spark, "prop")
    write_delimited(lines, path, None)
    back = sorted(r.value for r in scan_text(spark, path).collect())
    want = sorted((a.replace("\t", "\\t") + "\x02" + b.replace("\t", "\\t")).replace("\n", "\\n") for a, b in rows)
    assert back == want


def test_jdbc_roundtrip_embedded_derby(spark):
    # In-memory Derby lives inside this JVM: valid for local mode only (executors elsewhere cannot see it).
    url = "jdbc:derby:memory:sluice_t;create=true"
    from sluice.sinks.jdbc import run_statement
    run_statement(spark, url, "CREATE TABLE trans_dt (datekey DATE, n INT, s VARCHAR(20), amt DECIMAL(12,4))")
    src = spark.createDataFrame([("2015-11-01", "\\N", "it's", "1.2345"), ("2015-11-02", "7", "b", "-1.005")],
                                "datekey string, n string, s string, amt string")
    typed = src.withColumn("amt", F.col("amt").cast("decimal(12,4)"))
    write_jdbc(typed, url, "trans_dt", types={"datekey": "date", "n": "int", "s": "string"}, batch_size=1,
               presql="DELETE FROM trans_dt WHERE datekey = '2015-11-01'")
    q = build_select("trans_dt", " datekey, n, s, amt ", "n >= 0")
    assert q == "select datekey, n, s, amt from trans_dt where n >= 0"
    back = normalize_jdbc(scan_jdbc(spark, url, query=q, fetchsize=100, rename={"N": "n_value"}), scale=2,
                          rounding="up", dates_as_text=True)
    got = sorted(tuple(r) for r in back.collect())
    from decimal import Decimal
    assert got == [("2015-11-01", 0, "its", Decimal("1.24")), ("2015-11-02", 7, "b", Decimal("-1.01"))]
    assert back.columns[1] == "n_value"


def test_file_inventory(spark, outdir):
    root = local(outdir) + "/inv"
    os.makedirs(root, exist_ok=True)
    for name, data in [("a.seq", b"SEQ\x06rest"), ("b.avro", b"Obj\x01"), ("c.txt", b""), ("d.bin", b"zz"),
                       ("_hidden", b"SEQ")]:
        with open(os.path.join(root, name), "wb") as f:
            f.write(data)
    got = {os.path.basename(r.path): r.type for r in file_inventory(spark, root).collect()}
    # Spark's file listing skips zero-length files, so c.txt never reaches the inventory.
    assert got == {"a.seq": "sequence", "b.avro": "avro", "d.bin": "unknown"}


def test_write_upsert_rewrites_touched_partitions_only(spark, outdir):
    from sluice.sinks.table import write_table, write_upsert
    from sluice.sources.table import scan_table
    base = spark.createDataFrame([("a", "d1", "v1"), ("b", "d1", "v1"), ("c", "d2", "v1")], "k string, dt string, v string")
    path = outdir + "/up"
    write_table(base, path=path, partition_cols=["dt"])
    before_d2 = sorted(os.listdir(local(path) + "/dt=d2"))
    inc = spark.createDataFrame([("b", "d1", "v2", 1), ("b", "d1", "v3", 2), ("z", "d1", "v1", 1)],
                                "k string, dt string, v string, seq int")
    write_upsert(inc, ["k", "dt"], path=path, mode="replace", order="seq", partition_cols=["dt"])
    got = sorted(tuple(r) for r in scan_table(spark, path=path).select("k", "dt", "v").collect())
    assert got == [("a", "d1", "v1"), ("b", "d1", "v3"), ("c", "d2", "v1"), ("z", "d1", "v1")]
    assert sorted(os.listdir(local(path) + "/dt=d2")) == before_d2   # untouched partition kept its files


def test_jdbc_fails_at_once_on_errors_that_stay(spark):
    import time
    t0 = time.time()
    for url, query in [("jdbc:derby:memory:nope_db", "select 1 from sysibm.sysdummy1"),
                       ("jdbc:derby:memory:sluice_r;create=true", "select nothing from nowhere")]:
        with pytest.raises(Exception):
            scan_jdbc(spark, url, query=query, max_retries=2, retry_wait=60)
    assert time.time() - t0 < 50


def test_jdbc_retries_errors_that_may_pass(spark):
    from sluice.sources.jdbc import _may_pass
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway

    class Failed(Exception):
        def __init__(self, cause):
            self.java_exception = cause

    sql = jvm.java.sql.SQLException
    assert _may_pass(gateway, Failed(jvm.java.lang.RuntimeException(sql("no route", "08001"))))
    assert _may_pass(gateway, Failed(jvm.java.sql.SQLTransientConnectionException("busy")))
    assert not _may_pass(gateway, Failed(sql("bad login", "28000")))
    assert not _may_pass(gateway, Failed(sql("no state")))
    assert not _may_pass(gateway, ValueError("x"))


def test_jdbc_upsert_embedded_derby(spark):
    from sluice.sinks.jdbc import run_statements, upsert_jdbc
    url = "jdbc:derby:memory:sluice_u;create=true"
    run_statements(spark, url, ["CREATE TABLE target (k INT, v INT, who VARCHAR(9))",
                                "CREATE TABLE staged (k INT, v INT, who VARCHAR(9))",
                                "CREATE TABLE log (n INT)",
                                "INSERT INTO target VALUES (1, 1, 'old'), (2, 2, 'old'), (NULL, 3, 'old')"])
    rows = spark.createDataFrame([(2, 20, 1), (2, 21, 2), (3, 30, 1), (None, 40, 1)], "k int, v int, seq int")

    def held():
        return sorted((tuple(r) for r in scan_jdbc(spark, url, table="target").collect()), key=str)

    for _ in range(2):  # a repeated load changes nothing but the rows without a key
        upsert_jdbc(rows.where("k is not null"), url, "target", ["k"], "staged", order="seq", set_cols={"who": "'new'"},
                    post_sql="INSERT INTO log VALUES 1")
        assert held() == sorted([(1, 1, "old"), (2, 21, "new"), (3, 30, "new"), (None, 3, "old")], key=str)
    assert scan_jdbc(spark, url, table="log").count() == 2 and scan_jdbc(spark, url, table="staged").count() == 0
    upsert_jdbc(rows, url, "target", ["k"], "staged", mode="ignore", order="seq", set_cols={"who": "'late'"})
    assert held() == sorted([(1, 1, "old"), (2, 21, "new"), (3, 30, "new"), (None, 3, "old"), (None, 40, "late")], key=str)
    with pytest.raises(Exception):  # the merge is one transaction
        upsert_jdbc(rows, url, "target", ["k"], "staged", order="seq", set_cols={"who": "'x'"}, post_sql="INSERT INTO nowhere VALUES 1")
    assert len(held()) == 5


def test_codec_named_in_config(spark, outdir):
    import bz2
    import gzip
    from sluice.sources.text import scan_codec
    root = local(outdir) + "/codec"
    os.makedirs(root, exist_ok=True)
    lines = [f"row{i}\tvalue é {i}" for i in range(25000)]
    with open(os.path.join(root, "data_000"), "wb") as f:            # no extension
        f.write(gzip.compress(("\r\n".join(lines) + "\r\n").encode()))
    with open(os.path.join(root, "data_001"), "wb") as f:
        f.write(gzip.compress("last\tline".encode()))
    got = scan_codec(spark, root, "org.apache.hadoop.io.compress.GzipCodec")
    vals = [r.value for r in got.collect()]
    assert len(vals) == 25001 and sorted(vals)[:2] == ["last\tline", "row0\tvalue é 0"]
    broot = local(outdir) + "/codec_bz"
    os.makedirs(broot, exist_ok=True)
    with open(os.path.join(broot, "x"), "wb") as f:
        f.write(bz2.compress(b"a\x01b\x7fc\x01d"))
    assert [r.value for r in scan_codec(spark, broot, "bzip2", line_delim="\\u007f").collect()] == ["a\x01b", "c\x01d"]
