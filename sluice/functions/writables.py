"""SequenceFile parts in plain bytes: Writable values, variable-length numbers, codecs, headers.

The layouts are those of the public Hadoop file format, version 6.
"""

from __future__ import annotations

import bz2
import gzip
import struct
import zlib
from collections.abc import Callable
from dataclasses import dataclass

# ---- fixed values: the file format ------------------------------------------------------
MAGIC = b"SEQ\x06"
ESCAPE = b"\xff\xff\xff\xff"
SYNC_BYTES = 16
PACKAGE = "org.apache.hadoop.io."
CODEC_PACKAGE = "org.apache.hadoop.io.compress."
# -------------------------------------------------------------------------------------------


def vint(n: int) -> bytes:
    """A number of one byte if it lies in -112..127, else a length byte and big-endian bytes."""
    if -112 <= n <= 127:
        return struct.pack("b", n)
    mark, n = (-120, ~n) if n < 0 else (-112, n)
    size = (n.bit_length() + 7) // 8
    return struct.pack("b", mark - size) + n.to_bytes(size, "big")


def read_vint(data: bytes, at: int) -> tuple[int, int]:
    """The number at ``at``, and where what follows it begins."""
    first = data[at] - 256 if data[at] > 127 else data[at]
    if first >= -112:
        return first, at + 1
    size = -(first + 120) if first < -120 else -(first + 112)
    n = int.from_bytes(data[at + 1 : at + 1 + size], "big")
    return (~n if first < -120 else n), at + 1 + size


def _text(value) -> bytes:
    data = value.encode() if isinstance(value, str) else bytes(value)
    return vint(len(data)) + data


def _of_text(data: bytes) -> str:
    return data[read_vint(data, 0)[1] :].decode("utf-8", errors="replace")


@dataclass(frozen=True)
class Writable:
    """A class of keys or values: its SQL type, and its bytes."""

    name: str
    sql_type: str
    write: Callable[[object], bytes]
    read: Callable[[bytes], object]


def _number(name: str, sql_type: str, layout: str) -> Writable:
    return Writable(name, sql_type, lambda v: struct.pack(layout, v), lambda data: struct.unpack(layout, data)[0])


CLASSES = {w.name: w for w in (
    Writable("NullWritable", "string", lambda v: b"", lambda data: None),
    Writable("Text", "string", _text, _of_text),
    Writable("BytesWritable", "binary", lambda v: struct.pack(">i", len(v)) + bytes(v), lambda data: data[4:]),
    _number("BooleanWritable", "boolean", ">?"), _number("ByteWritable", "tinyint", ">b"), _number("IntWritable", "int", ">i"),
    _number("LongWritable", "bigint", ">q"), _number("FloatWritable", "float", ">f"), _number("DoubleWritable", "double", ">d"))}


def writable(name: str) -> Writable:
    """By simple or full class name."""
    found = CLASSES.get(name.removeprefix(PACKAGE))
    if found is None:
        raise ValueError(f"{name} is none of {', '.join(CLASSES)}")
    return found


def _zstd(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor().compress(data)


def _of_zstd(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompressobj().decompress(data)


#: by codec class: compress, decompress
CODECS = {
    CODEC_PACKAGE + "DefaultCodec": (zlib.compress, zlib.decompress),
    CODEC_PACKAGE + "GzipCodec": (gzip.compress, gzip.decompress),
    CODEC_PACKAGE + "BZip2Codec": (bz2.compress, bz2.decompress),
    CODEC_PACKAGE + "ZStandardCodec": (_zstd, _of_zstd),
}
SHORT_CODECS = {"default": "DefaultCodec", "deflate": "DefaultCodec", "gzip": "GzipCodec", "bzip2": "BZip2Codec", "zstd": "ZStandardCodec"}


def codec_class(name: str | None) -> str | None:
    """The class of a codec given by short or class name."""
    if not name:
        return None
    found = CODEC_PACKAGE + SHORT_CODECS[name.lower()] if name.lower() in SHORT_CODECS else name
    if found not in CODECS:
        raise ValueError(f"codec {name!r} is none of {', '.join(SHORT_CODECS)}")
    return found


@dataclass(frozen=True)
class Header:
    key: str
    value: str
    compressed: bool
    blocks: bool
    codec: str | None
    sync: bytes
    size: int

    def bytes_before_sync(self) -> bytes:
        return b"".join([MAGIC, _text(PACKAGE + self.key), _text(PACKAGE + self.value), bytes([self.compressed, self.blocks]),
                         _text(self.codec) if self.compressed else b"", struct.pack(">i", 0)])


def read_header(data: bytes) -> Header:
    """The header at the beginning of a file; ``data`` must hold it whole."""
    if data[:3] != MAGIC[:3] or data[3] != MAGIC[3]:
        raise ValueError("not a SequenceFile of version 6")
    at = 4

    def text() -> str:
        nonlocal at
        n, at = read_vint(data, at)
        at += n
        return data[at - n : at].decode()

    key, value = text(), text()
    compressed, blocks = bool(data[at]), bool(data[at + 1])
    at += 2
    codec = text() if compressed else None
    (pairs,) = struct.unpack_from(">i", data, at)
    at += 4
    for _ in range(2 * pairs):
        text()
    if len(data) < at + SYNC_BYTES:
        raise ValueError("the header of a SequenceFile is cut")
    return Header(key.removeprefix(PACKAGE), value.removeprefix(PACKAGE), compressed, blocks, codec, data[at : at + SYNC_BYTES], at + SYNC_BYTES)
