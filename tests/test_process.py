import pytest
from pyspark.sql import functions as F

from sluice.functions.delimiters import literal_regex, unescape_delim
from sluice.operators import process as P


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_unescape():
    assert unescape_delim("\\001") == "\x01"
    assert unescape_delim("\\t") == "\t"
    assert unescape_delim("\\u0001") == "\x01"
    assert unescape_delim("|") == "|"
    assert literal_regex("|") == "\\x{7c}"


def test_split_keeps_trailing_empties(spark):
    df = spark.createDataFrame([("a\x01b\x01\x01",), ("x",)], "value string")
    out = df.transform(P.split_line(["f1", "f2", "f3", "f4"], "\\001"))
    assert rows(out) == [("a", "b", "", ""), ("x", None, None, None)]


def test_split_literal_delimiter(spark):
    df = spark.createDataFrame([("a|b",), ("a.b|c",)], "value string")
    assert rows(df.transform(P.split_line(["x", "y"], "|"))) == [("a", "b"), ("a.b", "c")]
    assert rows(df.transform(P.split_line(["x", "y"], "[.|]", regex=True))) == [("a", "b"), ("a", "b")]


def test_add_field_positions(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert df.transform(P.add_field("n", F.lit(0), after="a")).columns == ["a", "n", "b", "c"]
    assert df.transform(P.add_field("n", F.lit(0), before="c")).columns == ["a", "b", "n", "c"]
    assert df.transform(P.add_field("n", F.lit(0), before="b", after="c")).columns == ["a", "n", "b", "c"]
    assert df.transform(P.add_field("n", F.lit(0), after="zz")).columns == ["n", "a", "b", "c"]
    assert df.transform(P.add_field("n", "a + b")).first().n == 3
    with pytest.raises(ValueError):
        df.transform(P.add_field("n", F.lit(0), before="zz"))


def test_filter_remove_replace(spark):
    df = spark.createDataFrame([("k1", "ab12cd345", "x")], "k string, v string, w string")
    assert df.transform(P.filter_field(["w", "k"])).columns == ["w", "k"]
    assert df.transform(P.remove_field("v")).columns == ["k", "w"]
    with pytest.raises(ValueError):
        df.transform(P.remove_field("nope"))
    assert df.transform(P.replace_field("v", "([0-9]+)", "<$1>")).first().v == "ab<12>cd<345>"


def test_filter_row_drops_null(spark):
    df = spark.createDataFrame([(1,), (None,), (5,)], "v int")
    assert rows(df.transform(P.filter_row("v > 2"))) == [(5,)]


def test_replace_delimit_null_is_empty(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    assert df.transform(P.replace_delimit("\\001")).first().value == "a\x01\x01c"


def test_line_to_json_omission_and_pair(spark):
    df = spark.createDataFrame([("\\N", "v1", " ", "alt"), ("x", "v2", "main", "alt")], "a string, b string, c string, d string")
    out = [r.value for r in df.transform(P.line_to_json(["a", "b", "k,other"], [0, 1, "2,3"])).collect()]
    assert out == ['{"b":"v1","k":"alt"}', '{"a":"x","b":"v2","k":"main"}']
    # pair keeps \N
    df2 = spark.createDataFrame([("", "\\N")], "a string, b string")
    assert df2.transform(P.line_to_json(["a,b"], ["0,1"])).first().value == '{"a":"\\\\N"}'
    with pytest.raises(ValueError):
        df.transform(P.line_to_json(["a", "b"], [0]))
    with pytest.raises(ValueError):
        df.transform(P.line_to_json(["a", "b", "c", "d", "e"], [0, 1, 2, 3, 3]))


def test_chain_limit_union(spark):
    df = spark.range(10).withColumnRenamed("id", "v")
    chained = df.transform(P.chain(P.filter_row("v % 2 = 0"), P.add_field("w", "v * 10")))
    assert [r.w for r in chained.orderBy("v").collect()] == [0, 20, 40, 60, 80]
    assert df.transform(P.limit_rows(0)).count() == 10
    assert df.transform(P.limit_rows(3)).count() == 3
    assert P.union_sources(df, df).count() == 20
