"""Smaller surfaces: line-level NULL tokens, re-encoding, console, UDFs in scripts, writer modes."""

import os

import pytest
from pyspark.sql import functions as F

from sluice.functions import coerce as C
from sluice.operators import process as P
from sluice.sinks.documents import write_documents
from sluice.sinks.text import write_delimited, write_mode
from sluice.sources.sql_script import scan_sql


def test_line_null_tokens(spark):
    df = spark.createDataFrame([("NULL\ta\tNULLx\tNULL",), ("\tb\t\t",)], "value string")
    dec = [r[0] for r in df.select(C.decode_line_nulls("value")).collect()]
    assert dec == ["\ta\tNULLx\t", "\tb\t\t"]
    enc = [r[0] for r in df.select(C.encode_line_nulls("value")).collect()]
    assert enc == ["NULL\ta\tNULLx\tNULL", "\\N\tb\t\\N\t\\N"]
    piped = spark.createDataFrame([("|x||",)], "value string").select(C.encode_line_nulls("value", "|")).first()[0]
    assert piped == "\\N|x|\\N|\\N"


def test_reencode(spark):
    df = spark.createDataFrame([("café",)], "v string")
    # bytes of UTF-8 text read as Latin-1, then repaired
    mojibake = df.select(C.reencode("v", "UTF-8", "ISO-8859-1").alias("m")).first().m
    assert mojibake == "cafÃ©"
    back = spark.createDataFrame([(mojibake,)], "v string").select(C.reencode("v", "ISO-8859-1", "UTF-8")).first()[0]
    assert back == "café"


def test_console_passes_through(spark, capsys):
    df = spark.range(3)
    assert df.transform(P.console(2)).count() == 3


def test_udf_inside_script(spark):
    spark.udf.register("shout", lambda s: s.upper() + "!", "string")
    out = scan_sql(spark, "SELECT shout('a') AS v; SELECT shout('b')")
    assert sorted(r.v for r in out.collect()) == ["A!", "B!"]


def test_parallel_writers_and_modes(spark, outdir):
    df = spark.range(1000).select(F.col("id").cast("string").alias("v"))
    write_delimited(df, outdir + "/k13", num_files=4)
    parts = [f for f in os.listdir(outdir.replace("file:", "") + "/k13") if f.startswith("part-")]
    assert len(parts) == 4
    with pytest.raises(Exception):
        write_delimited(df, outdir + "/k13", mode=write_mode(2))


def test_documents_append_and_overwrite(spark, outdir):
    df = spark.createDataFrame([("1", "a")], "id string, name string")
    write_documents(df, outdir + "/docs", {"id": "long", "name": "string"})
    write_documents(df, outdir + "/docs", {"id": "long", "name": "string"}, append=True)
    assert spark.read.json(outdir + "/docs").count() == 2
    write_documents(df, outdir + "/docs", {"id": "long", "name": "string"})
    assert spark.read.json(outdir + "/docs").count() == 1
