"""Statements, templates over them, functions of scripts, user processors and counted steps."""

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.operators import process as P
from sluice.plans.job import Source, Target, TransferJob
from sluice.sources.sql_script import expand_statements, scan_sql, scan_sql_template, split_statements
from sluice.streaming.stream import read_table_stream, start


@pytest.mark.parametrize("script,statements", [
    ("select 'a;b'", ["select 'a;b'"]),
    ('select "a;b"; select `c;d`', ['select "a;b"', "select `c;d`"]),
    ("-- note; more\nselect 1; -- end; of it", ["-- note; more\nselect 1"]),
    ("/* a; /* b; */ c; */ select 1; select 2", ["/* a; /* b; */ c; */ select 1", "select 2"]),
    (r"select 'a\;b' ;; select 1\;2", ["select 'a;b'", "select 1;2"]),
    (r"select 'it\'s; fine'; select 2", [r"select 'it\'s; fine'", "select 2"]),
    ("select 'it''s; fine'; select 2", ["select 'it''s; fine'", "select 2"]),
    (r"select r'a\'; select 2", [r"select r'a\'", "select 2"]),
    (r"select R"r"""'x;\' as "y;"; select bar'a;'""", ["select R'x;\\' as \"y;\"", "select bar'a;'"]),
    ("select 1 - 2; select 6 / 2 -1", ["select 1 - 2", "select 6 / 2 -1"]),
    ("select 'open; select 2", ["select 'open", "select 2"]),
    ("/* open; select 2", []),
    ("; ;\n", []),
])
def test_statements(script, statements):
    assert split_statements(script) == statements


_QUOTED = st.text("ab;-/*\" ", max_size=5).map(lambda t: f"'{t}'") | st.text("ab;-/*' ", max_size=5).map(lambda t: f'"{t}"')
_COMMENT = st.text("ab;'\" ", max_size=5).map(lambda t: f"--{t}\n") | st.text("ab;'\" -", max_size=5).map(lambda t: f"/*{t}*/")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(_QUOTED | _COMMENT | st.sampled_from(["select ", " 1", ",", "x "]), min_size=1, max_size=5).map("".join), max_size=5))
def test_what_is_joined_by_semicolons_is_split_again(statements):
    bare = [s for s in statements if split_statements(s)]
    assert split_statements(";".join(statements)) == [s.strip() for s in bare]


def test_template_binds_every_combination(spark):
    rows = scan_sql_template(spark, "SELECT :a AS a, CAST(:b AS INT) AS b", {"a": "x${range:1,2}", "b": "${enum:0~3,1}"}).collect()
    assert [tuple(r) for r in rows] == [(f"x{i}", j) for i in (1, 2) for j in (0, 1, 2)]
    assert scan_sql_template(spark, "SELECT :v AS v", {"v": "'; DROP TABLE t; --"}).first().v == "'; DROP TABLE t; --"
    for i in (1, 2):
        spark.range(i).createOrReplaceTempView(f"sluice_part{i}")
    frame = scan_sql_template(spark, "SELECT id, :k AS k FROM sluice_part${range:1,2}", {"k": "${enum:a,b,1}"})
    assert sorted(map(tuple, frame.collect())) == sorted((i, k) for n in (1, 2) for i in range(n) for k in "ab")
    assert expand_statements("SELECT ${range:1,2}") == ["SELECT 1", "SELECT 2"]
    with pytest.raises(ValueError, match="only queries"):
        scan_sql_template(spark, "CREATE OR REPLACE TEMP VIEW v AS SELECT 1")


def test_functions_of_a_script(spark):
    @F.udtf(returnType="n int")
    class Upto:
        def eval(self, n: int):
            for i in range(n):
                yield (i,)

    out = scan_sql(spark, "SELECT sluice_up(n) AS v FROM sluice_upto(3)", {"sluice_up": F.udf(lambda n: n + 1, "int"), "sluice_upto": Upto})
    assert sorted(r.v for r in out.collect()) == [1, 2, 3]
    table = scan_sql(spark, "CREATE OR REPLACE TEMPORARY FUNCTION sluice_pair(x INT) RETURNS TABLE(a INT, b INT) RETURN SELECT x, x + 1; SELECT * FROM sluice_pair(4)")
    assert [tuple(r) for r in table.collect()] == [(4, 5)]


def _doubled(batch: pa.RecordBatch) -> pa.Table:
    return pa.concat_tables([pa.Table.from_batches([batch])] * 2)


def test_map_batches(spark, outdir):
    df = spark.range(10).withColumn("s", F.col("id").cast("string")).withColumn("wide", F.lit("w"))
    out = df.transform(P.map_batches(_doubled, "s string, id int", ["id", "s"]))
    assert out.schema.simpleString() == "struct<s:string,id:int>"
    assert sorted(r.id for r in out.collect()) == sorted(2 * list(range(10)))
    assert df.limit(0).transform(P.map_batches(_doubled, "id bigint", ["id"])).collect() == []
    with pytest.raises(Exception, match="without"):
        df.transform(P.map_batches(lambda b: b, "gone int")).collect()
    with pytest.raises(Exception, match="(?i)overflow|bounds|invalid"):
        spark.range(1).selectExpr("id + 3000000000 as id").transform(P.map_batches(lambda b: b, "id int")).collect()
    df.select("id").write.parquet(outdir + "/in")
    got = []
    stream = read_table_stream(spark, outdir + "/in", "id long").transform(P.map_batches(_doubled, "id long"))
    start(stream, [lambda d: got.extend(r.id for r in d.collect())], "batches", checkpoint=outdir + "/ckpt").awaitTermination(120)
    assert sorted(got) == sorted(2 * list(range(10)))


def test_steps_are_counted_and_agree(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("v"))
    noop = lambda d: d.write.format("noop").mode("overwrite").save()
    twice = lambda d: d.unionAll(d)
    job = TransferJob([Source("1", lambda s: df), Source("ALL", lambda s: df.limit(0)), Source("2", lambda s: df.where("v < '3'"))],
                      [Target("a", "1", noop, [P.filter_row("v LIKE '1%'"), P.filter_row("v = 'none'")]), Target("b", "1,2", noop, [twice])],
                      input_transforms=[P.filter_row("v <> '1'")], count_steps=True)
    report = job.run(spark)
    steps = {(s.target, s.step): (s.rows_in, s.rows_out, s.dropped) for s in report.steps}
    n2 = df.where("v < '3'").count()
    assert steps["a", "source 1.0"] == (100, 100, 0) and steps["a", "source 1.1"] == (0, 0, 0)
    assert steps["a", "input 1.0"] == (100, 99, 1) and steps["a", "output 0"] == (99, 10, 89) and steps["a", "output 1"] == (10, 0, 10)
    assert steps["b", "input 2.0"] == (n2, n2 - 1, 1)
    assert report.reconciled() and report.rows_in("b") == 100 + n2 and [t.rows for t in report.targets][0] == 0
    report.targets[0].rows += 1
    empty = TransferJob(job.sources[:1], [Target("none", "1", noop, [P.filter_row("false")])], count_steps=True).run(spark)
    assert empty.reconciled() and empty.targets[0].rows == 0
    assert not report.reconciled()
    with pytest.raises(ValueError, match="kept channel"):
        TransferJob(job.sources, job.targets, count_steps=True, fanout="persist").run(spark)
