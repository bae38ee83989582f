"""Charsets: which ones Spark decodes by itself, and how others are used without changing a session."""

from __future__ import annotations

import codecs
from contextlib import contextmanager

from pyspark.sql import SparkSession

from sluice.functions.delimiters import unescape_delim

# ---- fixed values: charsets whose code units are wider than a byte -----------------------
WIDE = {"utf-16": 2, "utf-16le": 2, "utf-16be": 2, "utf-32": 4, "utf-32le": 4, "utf-32be": 4}
# charsets that Spark's encode and decode take without a flag
BUILT_IN = {"us-ascii", "iso-8859-1", "utf-8", "utf-16be", "utf-16le", "utf-16", "utf-32"}
# -------------------------------------------------------------------------------------------

_FLAGS = ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction")


def plain_name(encode: str | None) -> str:
    name = (encode or "UTF-8").strip().lower().replace("_", "-")
    return {"utf8": "utf-8", "utf16": "utf-16", "utf32": "utf-32", "utf-16-le": "utf-16le", "utf-16-be": "utf-16be",
            "utf-32-le": "utf-32le", "utf-32-be": "utf-32be"}.get(name, name)


def is_utf8(encode: str | None) -> bool:
    return plain_name(encode) == "utf-8"


def unit_width(encode: str | None) -> int:
    """Bytes of a code unit: 1 for charsets in which a line feed is one byte."""
    return WIDE.get(plain_name(encode), 1)


def wide_delim(delim: str, encode: str | None) -> str:
    """A record separator as the text that, written in UTF-8, has the bytes it has in ``encode``."""
    sep = unescape_delim(delim)
    if unit_width(encode) == 1:
        return sep
    name = plain_name(encode)
    if name in ("utf-16", "utf-32"):
        raise ValueError(f"{encode} needs a mark at the beginning of every file; write {encode}LE or {encode}BE")
    try:
        return codecs.encode(sep, name).decode("ascii")
    except UnicodeDecodeError:
        raise ValueError(f"the record separator {sep!r} is no ASCII text, so it cannot be written in {encode}") from None


@contextmanager
def java_charsets(spark: SparkSession):
    """While a frame is built: any charset of the JVM, malformed input replaced.

    Spark fixes both in the expression when the frame is analysed, which is at once; the session
    has its own settings back afterwards.
    """
    before = {f: spark.conf.get(f, None) for f in _FLAGS}
    for f in _FLAGS:
        spark.conf.set(f, "true")
    try:
        yield
    finally:
        for f, v in before.items():
            spark.conf.unset(f) if v is None else spark.conf.set(f, v)
