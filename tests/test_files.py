"""Files: wide charsets, compressed members, SequenceFiles, bulk requests, checksums, sized writers."""

import bz2
import gzip
import hashlib
import os
import random

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.functions.charsets import wide_delim
from sluice.functions.coerce import reencode
from sluice.functions.writables import read_vint, vint
from sluice.operators.documents import bulk_requests, to_bulk_docs
from sluice.sinks.checksum import verify_checksums, write_checksums, write_manifest
from sluice.sinks.documents import write_bulk
from sluice.sinks.sequence import write_sequence
from sluice.sinks.text import write_delimited
from sluice.sources import ranges
from sluice.sources import text as text_source
from sluice.sources.sequence import scan_sequence, scan_sequence_typed
from sluice.sources.text import scan_codec, scan_delimited, scan_text


def local(p):
    return p.replace("file:", "")


def cut_by_ranges(read, path, size):
    length = os.path.getsize(path)
    return [list(read(path, s, min(s + size, length), length)) for s in range(0, length, size)]


# ---- wide charsets ----------------------------------------------------------------------

ODD = ["a", "", "਀\u000d", "ਊ", "ഊ਍", "Ċਁ", "日本\U0001f600ੁ", "x\ty", " ", "\u000b"]


@pytest.mark.parametrize("charset", ["UTF-16LE", "UTF-16BE", "UTF-32LE", "UTF-32BE", "UTF-16", "UTF-32"])
def test_wide_records_come_once_wherever_ranges_begin(tmp_path, charset, monkeypatch):
    monkeypatch.setattr(ranges, "CHUNK", 10)
    rng, name = random.Random(1), charset.lower().replace("16le", "16-le").replace("16be", "16-be").replace("32le", "32-le").replace("32be", "32-be")
    width = 2 if "16" in charset else 4
    lines = [rng.choice(ODD) + rng.choice(ODD) for _ in range(60)]
    for end in ("", "\n"):
        path = tmp_path / f"f{len(end)}"
        path.write_bytes(("\n".join(lines) + end).encode(name))
        want = [x.rstrip("\r") if x.endswith("\r") else x for x in lines] if end or lines[-1] else lines[:-1]
        for size in (4, 8, 12, 40, 64, 100000):
            parts = cut_by_ranges(ranges.wide_records(charset.lower(), width), str(path), size)
            assert [x for p in parts for x in p] == want
        assert sum(map(bool, cut_by_ranges(ranges.wide_records(charset.lower(), width), str(path), 64))) > 3


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.characters(blacklist_characters="\n\r", blacklist_categories=["Cs"]), max_size=6), max_size=12), st.sampled_from([4, 8, 16]))
def test_wide_records_property(tmp_path_factory, lines, size):
    path = tmp_path_factory.mktemp("w") / "f"
    path.write_bytes("".join(x + "||" for x in lines).encode("utf-16-le"))
    read = ranges.wide_records("utf-16le", 2, "||")
    whole = "".join(x + "||" for x in lines)
    if "|||" not in whole:  # overlapping separators have no one reading
        assert [x for p in cut_by_ranges(read, str(path), size) for x in p] == whole.split("||")[:-1]


@pytest.mark.parametrize("charset", ["UTF-16LE", "UTF-16BE", "UTF-32LE"])
def test_wide_round_trip_over_several_tasks(spark, outdir, charset, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("doc_id").cast("string").alias("id"), F.translate("text", "\n\r\t", " ").alias("text"))
    write_delimited(docs.coalesce(1), outdir, "\\t", encode=charset)
    assert wide_delim("\\n", charset).encode() == "\n".encode(charset)
    flags = {k: spark.conf.get(k, None) for k in ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction")}
    monkeypatch.setattr(text_source._wide_text, "__defaults__", (1 << 16,))
    got = scan_delimited(spark, outdir, ["id", "text"], "\\t", encode=charset)
    assert got.rdd.getNumPartitions() >= 3
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, docs.collect()))
    assert flags == {k: spark.conf.get(k, None) for k in flags}
    with pytest.raises(ValueError, match="write UTF-16LE"):
        write_delimited(docs, outdir, "\\t", encode="UTF-16")


def test_other_charsets_leave_the_session_as_it_is(spark, outdir):
    flags = ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction")
    before = [spark.conf.get(f, None) for f in flags]
    rows = spark.createDataFrame([("中文", "é"), ("b", None)], "a string, b string")
    write_delimited(rows, outdir, "\\t", encode="GBK")
    assert sorted(map(tuple, scan_delimited(spark, outdir, ["a", "b"], "\\t", encode="GBK").collect())) == [("b", ""), ("中文", "é")]
    raw = b"".join(open(os.path.join(local(outdir), f), "rb").read() for f in sorted(os.listdir(local(outdir))) if f.startswith("part"))
    assert "中文".encode("gbk") in raw
    broken = rows.select(reencode("a", "GBK", "ISO-8859-1").alias("x")).collect()
    assert [r.x for r in broken] == ["中文".encode("gbk").decode("latin-1"), "b"]
    back = spark.createDataFrame(broken, "x string").select(reencode("x", "ISO-8859-1", "GBK").alias("a"))
    assert [r.a for r in back.collect()] == ["中文", "b"]
    assert before == [spark.conf.get(f, None) for f in flags]


# ---- compressed members -----------------------------------------------------------------


def _lines(n=4000):
    rng = random.Random(5)
    return [b"%d %s" % (i, bytes(rng.choices(b"abcdefgh \xc3\xa9", k=rng.randint(0, 60)))) for i in range(n)]


def _members(codec, lines):
    """The lines in several members that are cut at any byte, and one of them empty."""
    data, rng = b"\n".join(lines) + b"\n", random.Random(6)
    cuts = sorted({0, len(data), len(data) // 3, *rng.sample(range(len(data)), 12)})
    pack = {"gzip": gzip.compress, "zstd": zstandard.ZstdCompressor().compress, "bz2": bz2.compress}[codec]
    return b"".join([pack(data[a:b]) for a, b in zip(cuts, cuts[1:])] + [pack(b"")])


@pytest.mark.parametrize("codec", ["gzip", "zstd", "bz2"])
def test_members_are_read_by_several_tasks(tmp_path, codec, monkeypatch):
    lines, path = _lines(), tmp_path / "file"
    path.write_bytes(_members(codec, lines))
    read = ranges.member_records(codec)
    for size in (1000, 5000, 20000, 1 << 30):
        parts = cut_by_ranges(read, str(path), size)
        assert [x for p in parts for x in p] == lines
        assert size > 5000 or sum(map(bool, parts)) > 3
    path.write_bytes({"gzip": gzip.compress, "zstd": zstandard.ZstdCompressor().compress, "bz2": bz2.compress}[codec](b"no feed"))
    assert [x for p in cut_by_ranges(read, str(path), 8) for x in p] == [b"no feed"]


def test_blocks_of_one_bzip2_stream_are_split(tmp_path):
    lines, path = _lines(60000), tmp_path / "file"
    path.write_bytes(bz2.compress(b"\n".join(lines), 1))  # blocks of 100 kB
    parts = cut_by_ranges(ranges.member_records("bz2"), str(path), 100000)
    assert [x for p in parts for x in p] == lines and sum(map(bool, parts)) > 3


def test_codec_named_files_split_over_tasks(spark, outdir):
    os.makedirs(local(outdir))
    lines = _lines()
    for codec in ("gzip", "bz2", "zstd"):
        os.makedirs(f"{local(outdir)}/{codec}")
        with open(f"{local(outdir)}/{codec}/data", "wb") as f:
            f.write(_members(codec, lines))
        got = scan_codec(spark, f"{outdir}/{codec}", codec, range_bytes=4096, encode="ISO-8859-1")
        assert got.rdd.getNumPartitions() > 5
        assert sorted(r.value for r in got.collect()) == sorted(x.decode("latin-1") for x in lines)
        assert got.select(F.spark_partition_id()).distinct().count() > 3


# ---- SequenceFiles ----------------------------------------------------------------------


@given(st.integers(-(1 << 63), (1 << 63) - 1))
def test_vint(n):
    assert read_vint(b"x" + vint(n) + b"y", 1) == (n, 1 + len(vint(n)))


@pytest.mark.parametrize("compression,codec", [("NONE", None), ("RECORD", "default"), ("RECORD", "gzip"), ("BLOCK", "default"), ("BLOCK", "bzip2"), ("BLOCK", "zstd")])
@pytest.mark.parametrize("key,value", [("Text", "Text"), ("IntWritable", "LongWritable"), ("LongWritable", "DoubleWritable"), ("BooleanWritable", "BytesWritable"), (None, "FloatWritable")])
def test_sequence_classes_round_trip(spark, outdir, monkeypatch, compression, codec, key, value):
    from sluice.sinks import sequence as sink

    monkeypatch.setattr(sink, "STRETCH", 300)
    sql = {"Text": "concat('é', id)", "IntWritable": "cast(id - 50 as int)", "LongWritable": "id * 10000000000", "DoubleWritable": "id / 7",
           "BooleanWritable": "id % 2 = 0", "BytesWritable": "cast(repeat('x', int(id)) as binary)", "FloatWritable": "cast(id / 4 as float)"}
    df = spark.range(150).selectExpr(f"{sql[key] if key else 'id'} as k", f"{sql[value]} as v").coalesce(2)
    df = df if key else df.select("v")
    write_sequence(df, outdir, "k" if key else None, codec=codec, key_class=key, value_class=value, compression=compression)
    got = scan_sequence_typed(spark, outdir, range_bytes=400)
    assert got.rdd.getNumPartitions() >= 3
    want = [tuple(r) if key else (None, r.v) for r in df.collect()]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    if codec not in ("zstd", "bzip2") and value != "BytesWritable":  # what the JVM's own reader says
        theirs = spark.sparkContext.sequenceFile(outdir).collect()
        assert sorted(theirs, key=str) == sorted(want, key=str)


def test_sequence_edges(spark, outdir):
    df = spark.createDataFrame([("k", None, "b"), (None, "a", "")], "k string, v string, w string")
    write_sequence(df, outdir + "/a", "k", "|")
    assert sorted(r.value for r in scan_sequence(spark, outdir + "/a", ignore_key=False, field_delim="|").collect()) == ["k||b", "|a|"]
    write_sequence(df.limit(0), outdir + "/b", 0)
    assert scan_sequence(spark, outdir + "/b").collect() == [] and spark.sparkContext.sequenceFile(outdir + "/b").collect() == []
    with pytest.raises(ValueError):
        write_sequence(df, outdir + "/c", "k", value_class="IntWritable")
    with pytest.raises(Exception, match="NULL"):
        write_sequence(df.select("k", F.lit(None).cast("int").alias("v")), outdir + "/d", "k", value_class="IntWritable")
    spark.sparkContext.parallelize([(1, "a"), (2, "b")], 1).saveAsSequenceFile(outdir + "/e")
    assert sorted(r.value for r in scan_sequence(spark, outdir + "/e", ignore_key=False, field_delim=",").collect()) == ["1,a", "2,b"]


# ---- bulk requests ----------------------------------------------------------------------


def test_bulk_requests_keep_both_limits(spark, outdir):
    rng = random.Random(2)
    texts = ["x" * rng.randint(0, 300) for _ in range(400)] + ["y" * 5000, "é" * 900]
    docs = spark.createDataFrame(enumerate(texts), "id long, t string").repartition(3).transform(to_bulk_docs("i"))
    rows = bulk_requests(docs, 20, 3000).collect()
    assert sum(r.n_docs for r in rows) == 402
    for r in rows:
        assert r.n_bytes == len(r.value.encode()) + 1 and r.value.count("\n") == 2 * r.n_docs - 1
        assert r.n_docs <= 20 and (r.n_bytes <= 3000 or r.n_docs == 1)
    # no two neighbours of a task would have fitted in one request: at most one small one a task and reason
    assert len(rows) < 2 * max(402 / 20, sum(r.n_bytes for r in rows) / 3000)
    write_bulk(docs, outdir, max_actions=20, max_bytes=3000)
    files = [open(os.path.join(local(outdir), f), "rb").read() for f in os.listdir(local(outdir)) if f.startswith("part")]
    assert sorted(files) == sorted(r.value.encode() + b"\n" for r in rows)
    assert bulk_requests(docs.limit(0)).collect() == []


# ---- checksums --------------------------------------------------------------------------


def test_manifest_finds_changed_missing_and_extra_files(spark, outdir):
    spark.range(40).selectExpr("id", "id % 4 as p").repartition(2).write.partitionBy("p").json(outdir)
    n = write_manifest(spark, outdir)
    found = {r.file: r for r in verify_checksums(spark, outdir).collect()}
    assert len(found) == n and {r.status for r in found.values()} == {"ok"}
    assert spark.read.json(outdir).count() == 40  # the manifest is no data
    names = sorted(found)
    for r in found.values():
        data = open(os.path.join(local(outdir), r.file), "rb").read()
        assert (r.md5, r.length) == (hashlib.md5(data).hexdigest(), len(data))
    with open(os.path.join(local(outdir), names[0]), "r+b") as f:
        f.write(b"X")
    os.remove(os.path.join(local(outdir), names[1]))
    with open(os.path.join(local(outdir), "p=0", "new file+1"), "wb") as f:
        f.write(b"n")
    status = {r.file: r.status for r in verify_checksums(spark, outdir).collect()}
    assert (status.pop(names[0]), status.pop(names[1]), status.pop("p=0/new file+1")) == ("changed", "missing", "extra")
    assert set(status.values()) == {"ok"} and set(status) == set(names[2:])
    assert write_manifest(spark, outdir) == n


def test_sidecars_are_hidden_from_scans(spark, outdir):
    spark.range(10).selectExpr("cast(id as string)").repartition(2).write.text(outdir)
    assert write_checksums(spark, outdir) == 2
    assert scan_text(spark, outdir).count() == 10
    for r in scan_text(spark, outdir + "/_md5").collect():
        md5, name = r.value.split(" ")
        assert md5 == hashlib.md5(open(os.path.join(local(outdir), name), "rb").read()).hexdigest()


# ---- sized writers ----------------------------------------------------------------------


def test_files_have_the_stated_size_on_a_skewed_partition_column(spark, outdir):
    rows = spark.range(60000).selectExpr("id", "sha2(cast(id as string), 256) as t", "case when id % 10 < 8 then 'hot' when id = 9 then null else concat('c', id % 10) end as p")
    write_delimited(rows, outdir, "|", partition_cols=["p"], file_bytes=200_000)
    sizes = {}
    for folder, _, files in os.walk(local(outdir)):
        sizes.setdefault(os.path.basename(folder), []).extend(os.path.getsize(os.path.join(folder, f)) for f in files if f.startswith("part"))
    hot = sizes["p=hot"]
    assert 15 < len(hot) < 20 and all(0.8 * 200_000 < s < 1.2 * 200_000 for s in hot)
    assert len(sizes["p=__HIVE_DEFAULT_PARTITION__"]) == 1 and sum(map(len, sizes.values())) < 30
    assert spark.read.text(outdir).count() == 60000
    write_delimited(rows.limit(0), outdir + "-none", "|", file_bytes=1000)
    same = spark.range(0, 20000, 1, 20).selectExpr("repeat('z', 99) as t")
    write_delimited(same, outdir + "-same", "|", file_bytes=400_000)
    even = [os.path.getsize(f.path) for f in os.scandir(local(outdir) + "-same") if f.name.startswith("part")]
    assert len(even) > 2 and max(even) < 4 * 400_000 and sum(even) == 2_000_000
