from decimal import (ROUND_CEILING, ROUND_DOWN, ROUND_FLOOR, ROUND_HALF_DOWN, ROUND_HALF_EVEN, ROUND_HALF_UP, ROUND_UP,
                     Decimal)

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.functions import coerce as C

# Java BigDecimal rounding modes have the same definitions as Python's decimal modes.
PY_MODES = {"ceiling": ROUND_CEILING, "down": ROUND_DOWN, "floor": ROUND_FLOOR, "halfdown": ROUND_HALF_DOWN,
            "halfeven": ROUND_HALF_EVEN, "halfup": ROUND_HALF_UP, "up": ROUND_UP}
FIXTURE = ["1.005", "-1.005", "1.235", "2.5", "-2.5", "0.0049", "-0.0051", "0"]


def expected(v: str, scale: int, mode: str) -> Decimal:
    return Decimal(v).quantize(Decimal(1).scaleb(-scale), rounding=PY_MODES[mode])


def spark_round(spark, values, scale):
    df = spark.createDataFrame([(v,) for v in values], "s string").select(F.col("s").cast("decimal(20,6)").alias("x"))
    cols = [C.round_decimal("x", scale, m).cast(f"decimal(20,{scale})").alias(m) for m in PY_MODES]
    return df.select("x", *cols).collect()


@pytest.mark.parametrize("scale", [2, 0])
def test_rounding_fixture_all_modes(spark, scale):
    for row, v in zip(spark_round(spark, FIXTURE, scale), FIXTURE):
        for m in PY_MODES:
            assert row[m] == expected(v, scale, m), (v, scale, m)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.decimals(min_value=-10**6, max_value=10**6, places=4, allow_nan=False, allow_infinity=False),
                min_size=1, max_size=20))
def test_rounding_property(spark, values):
    vals = [str(v) for v in values]
    for row, v in zip(spark_round(spark, vals, 2), vals):
        for m in PY_MODES:
            assert row[m] == expected(v, 2, m)


def test_unnecessary(spark):
    df = spark.createDataFrame([("1.50",)], "s string").select(F.col("s").cast("decimal(10,4)").alias("x"))
    assert df.select(C.round_decimal("x", 2, "unnecessary")).first()[0] == Decimal("1.50")
    bad = spark.createDataFrame([("1.505",)], "s string").select(F.col("s").cast("decimal(10,4)").alias("x"))
    with pytest.raises(Exception):
        bad.select(C.round_decimal("x", 2, "unnecessary")).collect()


def test_typed_coercion_lenient(spark):
    vals = ["", " ", "\\N", "it's", "12x", "42", "2015-03-01"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = df.select(C.coerce_value("v", "int").alias("i"), C.coerce_value("v", "string").alias("s"),
                    C.coerce_value("v", "date").cast("string").alias("d")).collect()
    assert [r.i for r in got] == [0, 0, 0, None, None, 42, None]
    assert [r.s for r in got] == ["", " ", "", "its", "12x", "42", "2015-03-01"]
    assert [r.d for r in got][-1] == "2015-03-01" and [r.d for r in got][3] is None


def test_typed_coercion_strict_fails(spark):
    df = spark.createDataFrame([("12x",)], "v string")
    with pytest.raises(Exception):
        C.cast_strict(df, ["int"]).collect()
    ok = spark.createDataFrame([("12", "3.5")], "a string, b string")
    assert tuple(C.cast_strict(ok, ["int", "double"]).first()) == (12, 3.5)


def test_null_tokens_and_scrub(spark):
    df = spark.createDataFrame([("",), (None,), ("NULL",), ("a\x01b\x02c",)], "v string")
    assert [r[0] for r in df.select(C.encode_null("v")).collect()] == ["\\N", "\\N", "NULL", "a\x01b\x02c"]
    assert [r[0] for r in df.select(C.decode_null("v")).collect()] == ["", None, "", "a\x01b\x02c"]
    assert df.select(C.scrub_controls("v")).collect()[3][0] == "abc"


def test_render_line_escapes(spark):
    from sluice.functions.render import render_json, render_line
    df = spark.createDataFrame([("a\tb", "l1\nl2", None)], "x string, y string, z string")
    assert df.transform(render_line("|")).first().value == "a\\tb|l1\\nl2|"
    assert df.transform(render_json()).first().value == '{"x":"a\\tb","y":"l1\\nl2","z":null}'
