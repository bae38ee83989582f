"""Delimited text sink.

Rows are rendered to one line with the literal field delimiter (NULL -> empty), then
written by Spark's text writer: one part file per task, committed by Spark's output
committer (temp dir + rename, so a lost executor never leaves a half-written target).
Non-UTF-8 charsets are encoded JVM-side: ``encode(value, charset)`` gives the bytes, and
a binary -> string cast hands them to the text writer unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.charsets import is_utf8, java_charsets, wide_delim
from sluice.functions.delimiters import unescape_delim
from sluice.operators.process import join_fields
from sluice.sinks.sized import dealt_by_size

# ---- fixed values (must equal the reference's rules) --------------------------------
WRITE_TYPES = {"1": "overwrite", "2": "errorifexists"}
# -------------------------------------------------------------------------------------


def write_mode(write_type: str | int | None) -> str:
    """K2: ``1`` replace, ``2`` fail if the target exists; anything else overwrites."""
    if write_type is None:
        return "overwrite"
    return WRITE_TYPES.get(str(write_type).strip(), "overwrite")


def render_lines(df: DataFrame, field_delim: str | None = "\\t", cols: Sequence[str] | None = None,
                 encode: str | None = None, kept: Sequence[Column] = ()) -> DataFrame:
    """P7 rendering into the single ``value`` column the text writer takes, beside the ``kept`` ones."""
    if field_delim is None:
        if df.columns != ["value"] and not kept:
            raise ValueError("without a field delimiter the frame must be a single 'value' column")
        line = F.col("value")
    else:
        line = join_fields(list(cols or df.columns), field_delim)
    if is_utf8(encode):
        return df.select(line.alias("value"), *kept)
    with java_charsets(df.sparkSession):
        return df.select(F.encode(line, encode).cast("string").alias("value"), *kept)


def write_delimited(df: DataFrame, path: str, field_delim: str | None = "\\t", line_delim: str = "\\n",
                    mode: str = "overwrite", compression: str | None = None, cols: Sequence[str] | None = None,
                    encode: str | None = None, num_files: int | None = None, file_bytes: int | None = None,
                    partition_cols: Sequence[str] = ()) -> None:
    """Write rows as delimited text lines.

    ``compression``: ``gzip | bzip2 | deflate | zstd | lz4 | snappy`` (K3);
    ``num_files``: K13 parallel writers -- ``repartition(n)`` spreads rows evenly over ``n``
    tasks/files (a round-robin shuffle; use it only to fix the file count);
    ``file_bytes``: K13 by size -- as many files as the lines need at about so many bytes each, before
    compression, also within each value of ``partition_cols`` (see :mod:`sluice.sinks.sized`);
    ``partition_cols``: these columns become folders and are no fields of the line.
    """
    kept = [F.col(c) for c in partition_cols]
    fields = [c for c in (cols or df.columns) if c not in partition_cols] if field_delim is not None else cols
    lines = render_lines(df, field_delim, fields, encode, kept)
    if file_bytes:
        lines = dealt_by_size(lines, F.octet_length("value") + len(unescape_delim(line_delim).encode()), file_bytes, partition_cols)
    elif num_files:
        lines = lines.repartition(num_files)
    writer = lines.write.mode(mode).option("lineSep", wide_delim(line_delim, encode))
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)
