import pytest
from pyspark.sql import functions as F

from sluice.operators.cells import cells_to_rows, filter_day_range, parse_layout, rows_to_cells
from sluice.operators.documents import bulk_lines, to_bulk_docs
from sluice.operators.upsert import upsert
from sluice.operators.validate import validate_fields


def test_upsert_duplicates(spark):
    existing = spark.createDataFrame([(1, "old1"), (2, "old2")], "k int, v string")
    incoming = spark.createDataFrame([(2, "new2a", 1), (2, "new2b", 2), (3, "new3a", 1), (3, "new3b", 2)],
                                     "k int, v string, seq int")
    rep = {r.k: r.v for r in upsert(existing, incoming, ["k"], "replace", order="seq").collect()}
    assert rep == {1: "old1", 2: "new2b", 3: "new3b"}
    ign = {r.k: r.v for r in upsert(existing, incoming, ["k"], "ignore", order="seq").collect()}
    assert ign == {1: "old1", 2: "old2", 3: "new3a"}


def test_upsert_hot_key_keeps_all_other_rows(spark):
    # one key holds a third of the incoming rows: de-dup must still give one row for it
    hot = spark.range(3000).select(F.lit(7).cast("int").alias("k"), F.col("id").cast("string").alias("v"),
                                   F.col("id").alias("seq"))
    rest = spark.range(6000).select((F.col("id") + 100).cast("int").alias("k"), F.lit("r").alias("v"),
                                    F.col("id").alias("seq"))
    existing = spark.range(50).select(F.col("id").cast("int").alias("k"), F.lit("e").alias("v"))
    out = upsert(existing, hot.unionByName(rest), ["k"], "replace", order="seq")
    assert out.count() == 50 + 6000
    assert out.filter("k = 7").first().v == "2999"
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Window" not in plan


def test_cells_roundtrip_and_nulls(spark):
    df = spark.createDataFrame([("1", "a", "x\ny", None)], "id string, b string, c string, d string")
    cells = df.transform(rows_to_cells(key_pos=[2, 1], value_pos=[3, 4], qualifiers=["c", "d"], family="f",
                                       key_delim="-"))
    assert sorted((r.rowkey, r.qualifier, r.value) for r in cells.collect()) == [("a-1", "c", "x\ny"), ("a-1", "d", None)]
    wide = cells.transform(cells_to_rows("f", "c,d", as_line=True)).first()
    assert wide.value == "a-1\x01xy\x01"
    assert parse_layout("f1|f2", "a,b|c") == [("f1", "a"), ("f1", "b"), ("f2", "c")]


def test_day_range_bounds(spark):
    df = spark.createDataFrame([("2024-01-04 23:59:59",), ("2024-01-05 00:00:00",), ("2024-01-12 00:00:00",)], "s string") \
        .select(F.to_timestamp("s").alias("ts"))
    assert df.transform(filter_day_range("ts", "2024-01-05", "2024-01-12")).count() == 1
    assert df.transform(filter_day_range("ts", None, "2024-01-05")).count() == 1
    assert df.transform(filter_day_range("ts", "2024-01-05", None)).count() == 2
    plan = df.transform(filter_day_range("ts", "2024-01-05", "2024-01-12"))
    assert plan.count() == 1


def test_bulk_docs_last_wins(spark):
    df = spark.createDataFrame([(1, 10, "a"), (2, 10, "b"), (3, 11, "c")], "seq int, uid int, t string")
    docs = df.transform(to_bulk_docs("idx", "t1", id_col="uid", order="seq", doc_cols=["uid", "t"]))
    got = sorted((r.doc_id, r.action, r.doc) for r in docs.collect())
    assert got[0] == ("10", '{"index":{"_index":"idx","_type":"t1","_id":"10"}}', '{"uid":10,"t":"b"}')
    assert bulk_lines(docs).count() == 2


def test_validate_split(spark):
    df = spark.createDataFrame([("ab", "5"), ("a1", "50"), (None, "x")], "name string, n string")
    good, bad = validate_fields(df, {"name": [("regex", "[a-z]+")], "n": [("range", "0,10")]})
    assert [tuple(r) for r in good.collect()] == [("ab", "5")]
    reasons = sorted(tuple(r._errors) for r in bad.collect())
    assert reasons == [("name:regex", "n:range"), ("name:regex", "n:range")]
