from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sluice.functions.template import (TemplateError, enum_values, expand_template, expand_values, format_number,
                                       parse_template, range_values, resolve_template, resolve_time, template_column,
                                       time_column)


def test_enum_half_open_and_width():
    assert expand_values("${enum:0~4,6}") == ["000000", "000001", "000002", "000003"]


def test_range_inclusive():
    assert expand_values("${range:1,3,1,2}") == ["01", "02", "03"]
    assert range_values(("5",)) == ["5"]


def test_composite_first_factor_slowest():
    assert expand_values("a${enum:0~2,1}-${range:1,2}") == ["a0-1", "a0-2", "a1-1", "a1-2"]


def test_enum_items_literals_steps_and_order():
    assert enum_values(("x", "3", "0~6^2", "0")) == ["x", "3", "0", "2", "4"]
    with pytest.raises(TemplateError):
        enum_values(("0~4",))


def test_number_format():
    assert format_number(-5, 2) == "-05"
    assert format_number(2.5) == "2.5"
    assert format_number(0.1 + 0.2) == "0.3"
    assert format_number(7, 0) == "7"


def test_calendar_diff_is_ordered_and_clamps():
    assert resolve_time("yyyy-MM-dd", "-1M", "20150331000000") == "2015-02-28"
    assert resolve_time("yyyy-MM-dd", "-1M+1d", "20150331000000") == "2015-03-01"
    assert resolve_time("yyyy-MM-dd", "+1d-1M", "20150331000000") == "2015-03-01"
    assert resolve_time("yyyyMMddHHmmss", "+1w-2H", "20151101120000") == "20151108100000"
    assert resolve_time("dt=yyyy/MM", None, datetime(2016, 2, 29)) == "dt=2016/02"


def test_target_template_uses_first_values():
    assert resolve_template("dt=${time:yyyy-MM-dd,-1d}/${enum:0~4,6}", "20151101000000") == "dt=2015-10-31/000000"


def test_parse_errors_and_escape():
    with pytest.raises(TemplateError):
        parse_template("a${time:yyyy")
    with pytest.raises(TemplateError):
        parse_template("a${nope:1}")
    assert parse_template("a\\${x}") == parse_template("a\\${x}")
    assert expand_values("a\\${x}") == ["a\\${x}"]


def test_time_column_per_row_matches_driver(spark):
    df = spark.createDataFrame([("2015-03-31 10:11:12",), ("2016-02-29 00:00:00",)], "s string") \
        .select(F.to_timestamp("s").alias("ts"))
    got = [r[0] for r in df.select(time_column("ts", "dt=yyyy-MM-dd/HH", "-1M+1d")).collect()]
    want = [resolve_time("dt=yyyy-MM-dd/HH", "-1M+1d", datetime(2015, 3, 31, 10, 11, 12)),
            resolve_time("dt=yyyy-MM-dd/HH", "-1M+1d", datetime(2016, 2, 29))]
    assert got == want


def test_expand_template_per_row(spark):
    df = spark.createDataFrame([(1, "2015-11-01 00:00:00")], "k int, s string").select("k", F.to_timestamp("s").alias("ts"))
    out = df.transform(expand_template("p=${time:yyyyMMdd,-1d}/${enum:a,b,0}", base="ts", keep=["k"],
                                       with_position=True))
    assert [(r.pos, r.value) for r in out.orderBy("pos").collect()] == [(0, "p=20151031/a"), (1, "p=20151031/b")]
    first = df.select(template_column("p=${time:yyyyMMdd,-1d}/${enum:a,b,0}", "ts").alias("v")).first().v
    assert first == "p=20151031/a"
