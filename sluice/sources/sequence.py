"""S3: SequenceFile scan -- typed keys and values, or one text line per record.

Files are dealt in byte ranges. A range has the records from the first sync mark that begins in it up
to the first one beyond it, so several tasks read one file. Records come in Arrow batches, and
all of NONE, RECORD and BLOCK compression are read. ``NullWritable`` sides are NULL.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.delimiters import unescape_delim
from sluice.functions.writables import CODECS, ESCAPE, SYNC_BYTES, Header, read_header, read_vint, writable
from sluice.sources.inventory import list_files, open_file
from sluice.sources.ranges import RANGE, file_ranges

HEAD = 1 << 16
CHUNK = 1 << 20
ROWS = 10_000


class _Reader:
    """Bytes of a file from a place on, as many as are asked for."""

    def __init__(self, f, at: int):
        f.seek(at)
        self.f, self.data, self.base, self.at = f, b"", at, 0

    @property
    def place(self) -> int:
        return self.base + self.at

    def peek(self, n: int) -> bytes:
        while len(self.data) - self.at < n:
            more = self.f.read(max(CHUNK, n))
            if not more:
                break
            self.base, self.data, self.at = self.place, self.data[self.at :] + more, 0
        return self.data[self.at : self.at + n]

    def take(self, n: int) -> bytes:
        out = self.peek(n)
        if len(out) < n:
            raise ValueError(f"the file ends within a record at byte {self.place}")
        self.at += n
        return out

    def vint(self) -> int:
        data = self.peek(9)
        n, used = read_vint(data, 0)
        self.take(used)
        return n

    def seek_mark(self, mark: bytes, end: int) -> bool:
        """Go to the first ``mark`` that begins before ``end``."""
        while self.place < end:
            data = self.peek(CHUNK)
            found = data.find(mark)
            if found >= 0:
                self.at += found
                return self.place < end
            if len(data) < CHUNK:
                return False
            self.at += len(data) - len(mark) + 1
        return False


def _pairs(path: str, start: int, end: int) -> Iterator[tuple[bytes, bytes, Header]]:
    """Raw ``(key, value)`` of every record of a range, decompressed."""
    with open_file(path) as f:
        header = read_header(f.read(HEAD))
        unpack = CODECS[header.codec][1] if header.compressed else None
        mark = ESCAPE + header.sync
        reader = _Reader(f, header.size if start == 0 else start)
        if start and not reader.seek_mark(mark, end):
            return
        while True:
            head = reader.peek(4)
            if not head:
                return
            if head == ESCAPE:
                if reader.place >= end:
                    return
                if reader.take(4 + SYNC_BYTES) != mark:
                    raise ValueError(f"{path}: no sync mark at byte {reader.place}")
                if not header.blocks or not reader.peek(1):
                    continue
                n = reader.vint()
                key_sizes, keys, value_sizes, values = (unpack(reader.take(reader.vint())) for _ in range(4))
                k = v = ks = vs = 0
                for _ in range(n):
                    key_size, ks = read_vint(key_sizes, ks)
                    value_size, vs = read_vint(value_sizes, vs)
                    yield keys[k : k + key_size], values[v : v + value_size], header
                    k, v = k + key_size, v + value_size
                continue
            size, key_size = struct.unpack(">ii", reader.take(8))
            record = reader.take(size)
            value = record[key_size:]
            yield record[:key_size], unpack(value) if unpack else value, header


def _records(as_text: bool, key_class: str | None, value_class: str | None):
    def run(batches):
        import pyarrow as pa

        kinds = [pa.string() if as_text else _ARROW[writable(c).sql_type] for c in (key_class, value_class)] if not as_text else [pa.string()] * 2

        def made(keys, values):
            return pa.RecordBatch.from_arrays([pa.array(keys, kinds[0]), pa.array(values, kinds[1])], names=["key", "value"])

        for batch in batches:
            for r in batch.to_pylist():
                keys, values, key, value = [], [], None, None
                for k, v, header in _pairs(r["path"], r["start"], r["end"]):
                    if key is None:
                        if not as_text and (header.key, header.value) != (key_class, value_class):
                            raise ValueError(f"{r['path']} holds {header.key} and {header.value}, not {key_class} and {value_class}")
                        key, value = (_shown if as_text else lambda w: w.read)(writable(header.key)), (_shown if as_text else lambda w: w.read)(writable(header.value))
                    keys.append(key(k))
                    values.append(value(v))
                    if len(keys) >= ROWS:
                        yield made(keys, values)
                        keys, values = [], []
                if keys:
                    yield made(keys, values)

    return run


def _shown(w):
    """Reader of a value as text; NULL stays."""
    if w.sql_type == "string":
        return w.read
    if w.sql_type == "binary":
        return lambda data: w.read(data).decode("utf-8", errors="replace")
    return lambda data: str(w.read(data))


def _arrow_types() -> dict:
    import pyarrow as pa

    return {"string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "tinyint": pa.int8(), "int": pa.int32(),
            "bigint": pa.int64(), "float": pa.float32(), "double": pa.float64()}


_ARROW = _arrow_types()


def sequence_classes(spark: SparkSession, path: str) -> tuple[str, str]:
    """Simple class names of keys and values, from the header of one file below ``path``."""
    first = list_files(spark, path).where("length > 0").orderBy("path").select("path").first()
    if first is None:
        raise ValueError(f"no file below {path}")
    head = spark.createDataFrame([first], "path string").mapInPandas(_heads, "key string, value string").first()
    return head.key, head.value


def _heads(batches):
    import pandas as pd

    for pdf in batches:
        for p in pdf["path"]:
            with open_file(p) as f:
                header = read_header(f.read(HEAD))
            yield pd.DataFrame([(header.key, header.value)], columns=["key", "value"])


def scan_sequence_typed(spark: SparkSession, path: str, key_class: str | None = None, value_class: str | None = None,
                        range_bytes: int = RANGE) -> DataFrame:
    """``(key, value)`` in the types of their Writable classes (default: those of the first file)."""
    if key_class is None or value_class is None:
        found = sequence_classes(spark, path)
        key_class, value_class = key_class or found[0], value_class or found[1]
    key, value = writable(key_class), writable(value_class)
    return file_ranges(spark, path, range_bytes).mapInArrow(_records(False, key.name, value.name), f"key {key.sql_type}, value {value.sql_type}")


def scan_sequence_pairs(spark: SparkSession, path: str, range_bytes: int = RANGE) -> DataFrame:
    """``(key, value)`` as strings; NULL for ``NullWritable``."""
    return file_ranges(spark, path, range_bytes).mapInArrow(_records(True, None, None), "key string, value string")


def scan_sequence(spark: SparkSession, path: str, ignore_key: bool = True, field_delim: str = "\\t",
                  range_bytes: int = RANGE) -> DataFrame:
    """One ``value`` line per record: the value, or ``key<delim>value`` when keys are kept."""
    pairs = scan_sequence_pairs(spark, path, range_bytes)
    if ignore_key:
        return pairs.select(F.col("value"))
    d = unescape_delim(field_delim)
    line = F.concat_ws(d, F.col("key"), F.col("value"))  # concat_ws skips a NULL (NullWritable) side
    return pairs.select(line.alias("value"))
