"""K4: SequenceFile sink -- one field becomes the key, the rest (joined) the value, in Writable classes.

Records are laid out in Arrow batches, and the files are written by Spark's own text sink: a row is
a stretch of raw file bytes, and the sink's line separator is the file's sync mark. So files are
committed like any Spark output, and can be split at their marks when they are read. Every file
has a header, also one without a record. Strings are ``Text``; without a key, keys are
``NullWritable``.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.writables import CODECS, ESCAPE, Header, codec_class, vint, writable
from sluice.operators.process import join_fields

# ---- fixed values -----------------------------------------------------------------------
COMPRESSIONS = ("NONE", "RECORD", "BLOCK")
# -------------------------------------------------------------------------------------------

#: bytes between two sync marks, or of a block before compression
STRETCH = 1 << 20


def _stretches(header: Header):
    pack = CODECS[header.codec][0] if header.compressed else None
    key, value = writable(header.key), writable(header.value)

    def plain(pairs) -> bytes:
        out = []
        for k, v in pairs:
            v = pack(v) if pack else v
            out += [struct.pack(">ii", len(k) + len(v), len(k)), k, v]
        return b"".join(out)

    def block(pairs) -> bytes:
        sizes = lambda i: b"".join(vint(len(p[i])) for p in pairs)
        parts = [sizes(0), b"".join(p[0] for p in pairs), sizes(1), b"".join(p[1] for p in pairs)]
        return b"".join([vint(len(pairs)), *[x for part in map(pack, parts) for x in (vint(len(part)), part)]])

    def run(batches):
        def row(data: bytes):
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["value"])

        yield row(header.bytes_before_sync())
        if header.blocks:
            yield row(ESCAPE)
        pairs, size = [], 0
        for batch in batches:
            for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if (k is None and key.name != "NullWritable") or (v is None and value.name != "NullWritable"):
                    raise ValueError("a SequenceFile has no NULL except NullWritable")
                pairs.append((key.write(k), value.write(v)))
                size += len(pairs[-1][0]) + len(pairs[-1][1]) + 8
                if size >= STRETCH:
                    yield row((block if header.blocks else plain)(pairs) + ESCAPE)
                    pairs, size = [], 0
        if pairs:
            yield row((block if header.blocks else plain)(pairs) + ESCAPE)

    return run


def write_sequence(df: DataFrame, path: str, key_field: str | int | None = None, field_delim: str = "\\t",
                   codec: str | None = None, cols: Sequence[str] | None = None, key_class: str | None = None,
                   value_class: str = "Text", compression: str | None = None, mode: str = "errorifexists") -> None:
    """``key_field``: a column name or 0-based index (``-1``/``None`` = no key).

    ``key_class`` / ``value_class``: Writable classes (default ``Text``; a key field may be missing,
    then ``NullWritable``). A value class other than ``Text`` takes the one field that is left.
    ``compression``: ``NONE``, ``RECORD`` or ``BLOCK`` with a ``codec`` of ``default gzip bzip2 zstd``; a codec
    alone means ``RECORD``. A NULL in a typed field fails the job; in ``Text`` it is the empty text.
    """
    names = list(cols or df.columns)
    if isinstance(key_field, int):
        key_field = None if key_field < 0 else names[key_field]
    value_cols = [c for c in names if c != key_field]
    found = codec_class(codec or ("default" if compression and compression.upper() != "NONE" else None))
    compression = (compression or ("RECORD" if found else "NONE")).upper()
    if compression not in COMPRESSIONS:
        raise ValueError(f"compression {compression!r} is none of {COMPRESSIONS}")
    key, value = writable(key_class or ("Text" if key_field else "NullWritable")), writable(value_class)
    if (key.name == "NullWritable") != (key_field is None):
        raise ValueError("a key field and its class go together")
    if value.name != "Text" and len(value_cols) != 1:
        raise ValueError(f"{value.name} takes one field, not {value_cols}")
    v = join_fields(value_cols, field_delim) if value.name == "Text" else F.col(value_cols[0]).cast(value.sql_type)
    k = F.lit(None).cast("string") if key_field is None else F.col(key_field).cast(key.sql_type)
    pairs = df.select((F.coalesce(k, F.lit("")) if key.name == "Text" else k).alias("k"), v.alias("v"))
    sync = uuid.uuid4().hex[:16]  # plain characters, as the text sink's separator must be
    header = Header(key.name, value.name, compression != "NONE", compression == "BLOCK", found if compression != "NONE" else None, sync.encode(), 0)
    rows = pairs.mapInArrow(_stretches(header), "value binary").select(F.col("value").cast("string").alias("value"))
    rows.write.mode(mode).option("lineSep", sync).text(path)
