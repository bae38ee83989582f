"""Byte ranges of files as units of work, and records that are cut out of them.

Files are listed without being read, and dealt in ranges of a stated size, one range a task. A
reader finds the first record that belongs to its range and goes beyond the range's end only to
finish its last one, so each record comes once, wherever ranges begin:

* :func:`wide_records`: text in charsets whose code units are two or four bytes. A separator counts
  only where it is aligned to a unit; a byte pair that merely looks like one does not.
* :func:`member_records`: compressed files of several members (gzip, zstd) or blocks (bzip2). A
  range decodes the members that begin in it. A file of one member is one unit of work.

Files are opened through ``pyarrow.fs`` by URI.
"""

from __future__ import annotations

import bz2
import zlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.sources.inventory import list_files, open_file

RANGE = 128 << 20
MOST_TASKS = 100_000
CHUNK = 4 << 20
#: output that a member's beginning must give without an error to be taken for one
PROBE = 1 << 20

RANGE_SCHEMA = "path string, start long, end long, length long"


def file_ranges(spark: SparkSession, path: str, size: int = RANGE, recursive: bool = True, name_glob: str | None = None) -> DataFrame:
    """``path, start, end, length``: ranges of every visible file, each in a task of its own."""
    if size < 4 or size % 4:
        raise ValueError("ranges must be whole four-byte units")
    files = list_files(spark, path, recursive, name_glob).where("length > 0")
    ranges = files.select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long"))).alias("start"), "length")
    ranges = ranges.select("path", "start", F.least(F.col("start") + size, "length").alias("end"), "length")
    # a fixed number of tasks: adaptive execution would put the small rows of all ranges together
    return ranges.repartition(max(1, min(ranges.count(), MOST_TASKS)))


def batched(read: Callable[[str, int, int, int], Iterator], rows: int = 10_000, size: int = 16 << 20):
    """``mapInArrow`` function giving the records of each range, in batches bounded by rows and bytes."""

    def run(batches):
        import pyarrow as pa

        kind = None
        for batch in batches:
            for r in batch.to_pylist():
                out, n = [], 0
                for record in read(r["path"], r["start"], r["end"], r["length"]):
                    kind = kind or (pa.string() if isinstance(record, str) else pa.binary())
                    out.append(record)
                    n += len(record)
                    if len(out) >= rows or n >= size:
                        yield pa.RecordBatch.from_arrays([pa.array(out, kind)], names=["value"])
                        out, n = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(out, kind)], names=["value"])

    return run


# ---- charsets with wide code units --------------------------------------------------------


def _codec(head: bytes, name: str) -> tuple[str, int]:
    """The charset with its byte order, and the bytes of a mark; without one it is big-endian."""
    if name == "utf-16":
        return {b"\xff\xfe": ("utf-16le", 2), b"\xfe\xff": ("utf-16be", 2)}.get(head[:2], ("utf-16be", 0))
    if name == "utf-32":
        return {b"\xff\xfe\0\0": ("utf-32le", 4), b"\0\0\xfe\xff": ("utf-32be", 4)}.get(head[:4], ("utf-32be", 0))
    return name, 0


def wide_records(charset: str, width: int, delim: str | None = None):
    """Reader of a range's records as text, malformed input replaced; ``delim`` None: line feeds, with a
    carriage return before them or not."""

    def read(path: str, start: int, end: int, length: int) -> Iterator[str]:
        with open_file(path) as f:
            name, mark = _codec(f.read(4), charset)
            sep, cr = (delim or "\n").encode(name), "\r".encode(name) if delim is None else None
            skip = start > 0
            end = max(end, mark + 1)  # the first record is the first range's, wherever that ends
            # a separator that ends where the range begins makes its first record whole
            base = max(mark, start - len(sep)) if skip else mark
            f.seek(base)
            data = b""
            while True:
                chunk = f.read(CHUNK)
                data += chunk
                at = 0
                while True:
                    found = data.find(sep, at)
                    while found >= 0 and (base + found) % width:
                        found = data.find(sep, found + 1)
                    if found < 0:
                        break
                    if not skip:
                        if base + at >= end:
                            return
                        record = data[at:found]
                        yield (record[: -len(cr)] if cr and record.endswith(cr) else record).decode(name, errors="replace")
                    skip, at = False, found + len(sep)
                data, base = data[at:], base + at
                if not skip and base >= end:
                    return
                if not chunk:
                    if data and not skip:
                        yield data.decode(name, errors="replace")
                    return

    return read


# ---- compressed files of several members --------------------------------------------------


def _gzip():
    return zlib.decompressobj(31)


def _zstd():
    import zstandard

    return zstandard.ZstdDecompressor().decompressobj()


#: by codec: what a member begins with, and its decoder
MEMBERS = {"gzip": (b"\x1f\x8b\x08", _gzip), "zstd": (b"\x28\xb5\x2f\xfd", _zstd)}


def _begins(f, at: int, new) -> bool:
    """Whether a member begins at ``at``: it decodes to its end, or for PROBE bytes, without an error."""
    import zstandard

    f.seek(at)
    decoder, got = new(), 0
    try:
        while got < PROBE and not decoder.eof:
            data = f.read(1 << 16)
            if not data:
                return False
            got += len(decoder.decompress(data))
    except (zlib.error, zstandard.ZstdError):
        return False
    return True


def _first_member(f, start: int, end: int, magic: bytes, new) -> int | None:
    """Where the first member that begins in ``[start, end)`` does."""
    if start == 0:
        return 0
    at = start
    while at < end:
        f.seek(at)
        data = f.read(min(CHUNK, end - at) + len(magic) - 1)
        found = data.find(magic)
        while found >= 0 and at + found < end:
            if _begins(f, at + found, new):
                return at + found
            found = data.find(magic, found + 1)
        at += CHUNK
    return None


def _members(codec: str):
    """Reader of decoded bytes: yields ``(data, inside)``; ``inside`` ends with the range's last member."""
    magic, new = MEMBERS[codec]

    def read(path: str, start: int, end: int) -> Iterator[tuple[bytes, bool]]:
        with open_file(path) as f:
            at = _first_member(f, start, end, magic, new)
            if at is None:
                return
            f.seek(at)
            decoder, data, inside = new(), f.read(CHUNK), True
            at += len(data)  # where the file's next unread byte is
            while data:
                yield decoder.decompress(data), inside
                if decoder.eof:
                    data = decoder.unused_data.lstrip(b"\0") if codec == "gzip" else decoder.unused_data
                    inside = at - len(data) < end
                    decoder = new()
                else:
                    data = b""
                if not data:
                    data = f.read(CHUNK)
                    at += len(data)

    return read


# ---- fixed values of the bzip2 format -----------------------------------------------------
_BLOCK, _FOOT = 0x314159265359, 0x177245385090
# -------------------------------------------------------------------------------------------


def _bit_marks(data: bytes, mark: int) -> list[int]:
    """Bit offsets at which the 48-bit ``mark`` stands in ``data``."""
    found = []
    for shift in range(8):
        pattern = (mark << (8 - shift)).to_bytes(7, "big")
        # the five bytes in the middle are whole at every shift
        inner = pattern[1:6] if shift else pattern[:6]
        lead = 1 if shift else 0
        at = data.find(inner)
        while at >= 0:
            first = 8 * (at - lead) + shift
            if first >= 0 and first + 48 <= 8 * len(data):
                window = int.from_bytes(data[first // 8 : first // 8 + 7].ljust(7, b"\0"), "big")
                if window >> (8 - shift) & (1 << 48) - 1 == mark:
                    found.append(first)
            at = data.find(inner, at + 1)
    return sorted(found)


def _block_bytes(data: bytes, first: int, last: int) -> bytes:
    """The block of bits ``[first, last)`` as a stream of its own; fails if it isn't whole."""
    bits = (int.from_bytes(data[first // 8 : -(-last // 8)], "big") >> (-last % 8)) & ((1 << (last - first)) - 1)
    check = bits >> (last - first - 80) & 0xFFFFFFFF  # follows the 48 bits of the mark
    whole = ((bits << 48 | _FOOT) << 32) | check
    size = last - first + 80
    return bz2.decompress(b"BZh9" + (whole << (-size % 8)).to_bytes(-(-size // 8), "big"))


def _blocks(path: str, start: int, end: int) -> Iterator[tuple[bytes, bool]]:
    """As :func:`_members`, for the blocks of bzip2 streams that begin in the range."""
    with open_file(path) as f:
        at, data, done = start, b"", False
        f.seek(start)
        while not done:
            chunk = f.read(CHUNK)
            done = not chunk
            data += chunk
            blocks = _bit_marks(data, _BLOCK)
            marks = sorted(blocks + _bit_marks(data, _FOOT))
            used = 0
            for first in blocks:
                if first < used:
                    continue  # within a block that took a false mark for a part of itself
                for last in (m for m in marks if m > first):
                    try:
                        out = _block_bytes(data, first, last)
                    except (OSError, ValueError):
                        continue  # not the block's end
                    yield out, 8 * at + first < 8 * end
                    used = last
                    break
                else:
                    if done:
                        raise ValueError(f"{path}: the bzip2 block at bit {8 * at + first} has no end")
                    break
            keep = min(used // 8 if used else len(data), next((b // 8 for b in blocks if b >= used), len(data)), max(0, len(data) - 8))
            data, at = data[keep:], at + keep


def member_records(codec: str, sep: bytes = b"\n"):
    """Reader of a range's records as bytes.

    A range that begins in the file drops what comes before its first separator, and each range
    goes on to the first separator after its own members: so a record belongs to the range in
    which it begins, or ends if it begins with the range.
    """
    if len(sep) != 1:
        raise ValueError("files are split between members only at separators of one byte")
    parts = _blocks if codec == "bz2" else _members(codec)

    def read(path: str, start: int, end: int, length: int) -> Iterator[bytes]:
        skip, tail = start > 0, b""
        for data, inside in parts(path, start, end):
            if skip:
                if not inside:
                    return  # no separator in the whole range: the one before has it all
                cut = data.find(sep)
                if cut < 0:
                    continue
                skip, data = False, data[cut + 1 :]
            if not inside:
                cut = data.find(sep)
                if cut >= 0:
                    yield tail + data[:cut]
                    return
                tail += data
                continue
            *whole, tail = (tail + data).split(sep)
            yield from whole
        if tail and not skip:
            yield tail

    return read
