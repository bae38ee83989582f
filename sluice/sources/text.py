"""Delimited text scans.

One ``spark.read.text`` over every path: splittable files are split across tasks,
compressed files (``.gz .bz2 .deflate .zst`` ...) are decoded by the codec chosen from the
extension, and a template that expands to many paths still becomes one scan, not a union
of scans.

Charsets: Spark's text source keeps each line's raw bytes, so decoding happens JVM-side:
UTF-8 lines go through ``make_valid_utf8`` (malformed bytes -> U+FFFD, as the reference's
decoder does) and any other charset through ``decode(cast(value as binary), charset)``.
Line splitting happens on the raw ``lineSep`` byte(s), which is correct for ASCII-compatible
charsets (GBK, Big5, ISO-8859-x, Shift-JIS ...). UTF-16 and UTF-32, whose line feeds have two or
four bytes, are cut by :mod:`sluice.sources.ranges` where a separator is aligned, over byte ranges
of the files. No setting of the session changes.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.charsets import is_utf8, java_charsets, plain_name, unit_width
from sluice.functions.delimiters import unescape_delim
from sluice.functions.template import expand_values
from sluice.operators.process import split_line
from sluice.sources.ranges import RANGE, batched, file_ranges, member_records, wide_records

def glob_to_regex(pattern: str) -> str:
    """Path glob -> Java regex: ``**/`` any directories, ``*`` / ``?`` within one segment."""
    out = []
    i = 0
    while i < len(pattern):
        if pattern.startswith("**/", i):
            out.append("(?:[^/]*/)*")
            i += 3
        elif pattern.startswith("**", i):
            out.append(".*")
            i += 2
        elif pattern[i] == "*":
            out.append("[^/]*")
            i += 1
        elif pattern[i] == "?":
            out.append("[^/]")
            i += 1
        else:
            out.append(re.escape(pattern[i]))
            i += 1
    return "".join(out)


def scan_text(spark: SparkSession, paths: str | Sequence[str], line_delim: str | None = None,
              encode: str | None = "UTF-8", name_glob: str | None = None, recursive: bool = False,
              path_regex: str | None = None, with_path: bool = False) -> DataFrame:
    """One row per record, column ``value`` (decoded string).

    * ``line_delim``: record separator (default: any of ``\\n``, ``\\r\\n``, ``\\r``);
    * ``name_glob``: file-name filter (``part-*``), ``recursive``: descend directories;
    * ``path_regex``: full-path filter, used for ``**`` patterns (see :func:`scan_glob`);
    * ``with_path``: add the source file as ``path``.
    """
    if unit_width(encode) > 1:
        if path_regex or with_path:
            raise ValueError(f"{encode} is read by byte ranges, without paths")
        return _wide_text(spark, paths, line_delim, encode, name_glob, recursive)
    reader = spark.read
    sep = unescape_delim(line_delim) if line_delim else None
    if sep and sep not in ("\n", "\r\n", "\r"):
        reader = reader.option("lineSep", sep)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.text(list(paths) if not isinstance(paths, str) else paths)
    cols = []
    if with_path or path_regex:
        # the metadata path is URL-encoded, except that a plus sign stands for itself
        cols.append(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))).alias("path"))
    out = _decoded(df, encode, *cols)
    if path_regex:
        out = out.filter(F.col("path").rlike(path_regex))
        if not with_path:
            out = out.drop("path")
    return out


def _decoded(df: DataFrame, encode: str | None, *cols: Column) -> DataFrame:
    """``value`` decoded from the raw bytes that the text source keeps, and ``cols``."""
    if is_utf8(encode):
        return df.select(F.make_valid_utf8("value").alias("value"), *cols)
    with java_charsets(df.sparkSession):
        return df.select(F.decode(F.col("value").cast("binary"), encode).alias("value"), *cols)


def _wide_text(spark: SparkSession, paths: str | Sequence[str], line_delim: str | None, encode: str, name_glob: str | None,
               recursive: bool, size: int = RANGE) -> DataFrame:
    sep = unescape_delim(line_delim) if line_delim else None
    read = batched(wide_records(plain_name(encode), unit_width(encode), None if sep in (None, "\n", "\r\n") else sep))
    frames = [file_ranges(spark, p, size, recursive, name_glob).mapInArrow(read, "value string") for p in ([paths] if isinstance(paths, str) else paths)]
    return reduce(lambda a, b: a.union(b), frames)


def scan_glob(spark: SparkSession, root: str, pattern: str, **kw) -> DataFrame:
    """S5 ``**`` patterns: recursive listing under ``root``, full path matched by the glob."""
    if "**" not in pattern:
        return scan_text(spark, root.rstrip("/") + "/" + pattern.lstrip("/"), **kw)
    # Hadoop writes a local root with one slash (file:/x), and so do the paths it is compared with
    plain = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root).toString()
    regex = re.escape(plain.rstrip("/")) + "/" + glob_to_regex(pattern.lstrip("/")) + "$"
    return scan_text(spark, root, recursive=True, path_regex=regex, **kw)


def scan_delimited(spark: SparkSession, paths: str | Sequence[str], fields: Sequence[str],
                   field_delim: str = "\\t", line_delim: str | None = None, encode: str | None = "UTF-8",
                   regex: bool = False, **kw) -> DataFrame:
    """Text scan + split into named string fields (trailing empties kept)."""
    lines = scan_text(spark, paths, line_delim=line_delim, encode=encode, **kw)
    keep = ["path"] if kw.get("with_path") else []
    return lines.transform(split_line(fields, field_delim, regex=regex, keep=keep))


def expand_sources(template: str, base: str | datetime | None = None) -> list[str]:
    """A location template -> every concrete path (first factor slowest)."""
    return expand_values(template, base)


def scan_template(spark: SparkSession, template: str, base: str | datetime | None = None, **kw) -> DataFrame:
    """S16 + S1: expand the template and read every path in **one** scan."""
    return scan_text(spark, expand_sources(template, base), **kw)


# ---- codec named in config (files without a codec extension) -------------------------

CODEC_NAMES = {"gzip": "gzip", "gz": "gzip", "default": "gzip", "bzip2": "bz2", "bz2": "bz2",
               "zstd": "zstd", "lz4": "lz4", "brotli": "brotli"}


def _codec_lines(codec: str, sep: bytes, batch_lines: int, chunk: int = 8 << 20):
    from sluice.sources.inventory import open_stream

    def gen(batches):
        import pandas as pd

        for pdf in batches:
            for p in pdf["path"]:
                out: list[bytes] = []
                tail = b""
                with open_stream(p, compression=codec) as stream:
                    while True:
                        data = stream.read(chunk)
                        if not data:
                            break
                        pieces = (tail + data).split(sep)
                        tail = pieces.pop()
                        out.extend(pieces)
                        if len(out) >= batch_lines:
                            yield pd.DataFrame({"value": out})
                            out = []
                if tail:
                    out.append(tail)
                if out:
                    yield pd.DataFrame({"value": out})

    return gen


def scan_codec(spark: SparkSession, path: str, codec: str, line_delim: str = "\\n", encode: str | None = "UTF-8",
               name_glob: str | None = None, batch_lines: int = 10000, range_bytes: int = RANGE) -> DataFrame:
    """S2 for files whose codec is named in config rather than by extension.

    Files are listed without reading them; each task streams a range of a file through the
    decompressor and yields bounded batches of raw line bytes (never a whole file in one
    row), decoded JVM-side afterwards. gzip and zstd files of several members, and bzip2 files,
    are split at members or blocks, so that several tasks read one file. A file of one gzip or
    zstd member, any other codec, and separators of more than one byte make a file one unit of work.
    """
    from sluice.sources.inventory import list_files

    name = CODEC_NAMES.get(codec.lower().rsplit(".", 1)[-1].replace("codec", ""), codec.lower())
    sep = unescape_delim(line_delim).encode("utf-8")
    if name in ("gzip", "zstd", "bz2") and len(sep) == 1:
        raw = file_ranges(spark, path, range_bytes, name_glob=name_glob).mapInArrow(batched(member_records(name, sep), batch_lines), "value binary")
    else:
        files = list_files(spark, path, recursive=True, name_glob=name_glob).select("path")
        raw = files.mapInPandas(_codec_lines(name, sep, batch_lines), "value binary")
    text = raw.select(F.col("value").cast("string").alias("value"))
    text = _decoded(text, encode)
    return text.select(F.regexp_replace("value", r"\r\z", "").alias("value")) if sep == b"\n" else text
