"""Line de-duplication with two Bloom filters and exact confirmation (operator 10).

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with A-Z lower-cased. Keys of
at least :data:`MIN_CHARS` code points that occur in two documents or more lose all their lines,
except in the least ``doc_id`` that holds the key.

1. Every task fills two Bloom filters with the keys of its documents: *once* holds every key,
   *twice* every key that was in *once* already. Filters are cut into segments and merged by a tree
   of grouped jobs: bits set in either *twice*, or in both *once*, are set in *twice*. There are no
   false negatives. Filters have :data:`BITS_A_KEY` bits for each distinct key (counted by a sketch
   first), so at most about one key in fifty is a suspect without repeating, at any size.
2. Keys that *twice* holds are suspects; only they are shuffled, as 128-bit fingerprints, and a
   map-side combined ``min``/``max`` of ``doc_id`` confirms which are in two documents.
3. Each document meets the keys that it has to lose by one join on ``doc_id``.

A filter has at most :data:`BITS` bits (16 MB). Beyond that the fingerprints are written once, sorted by a
slice of their hash, and the filters go over one slice after the other, so each key is read by one
pass. An explicit ``bits`` fixes the size of one pass. Defined cases: a NULL or empty text is one empty line; a document whose
lines all go has an empty text; a key that repeats within one document only is no repeat; rows
with a NULL ``doc_id`` neither give nor lose lines; rows that repeat a ``doc_id`` are one document.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.frames import documents_view, numbered, position, store

MIN_CHARS = 10
BITS = 1 << 27
LEAST_BITS = 1 << 16
BITS_A_KEY = 16
SEGMENTS = 64
FAN_IN = 32
_STRIP = b" \t\n\x0b\x0c\r"


def key_of(line: bytes) -> bytes | None:
    """The key of a line in UTF-8, or None if it is shorter than MIN_CHARS code points."""
    key = line.strip(_STRIP)
    n = len(key)
    if n < MIN_CHARS or (n < 4 * MIN_CHARS and len(key.decode()) < MIN_CHARS):
        return None
    return key.lower()  # bytes.lower() changes A-Z only


def fingerprint(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _places(prints: np.ndarray, bits: int) -> np.ndarray:
    """Two bit positions for every 16-byte fingerprint, one from each half."""
    halves = prints.reshape(-1, 2)
    return (halves & np.uint64(bits - 1)).astype(np.int64)


def _document_prints(texts: pa.Array) -> list[set[bytes]]:
    out = []
    for text in texts.cast(pa.large_string()).cast(pa.large_binary()).to_pylist():
        keys = {k for line in text.split(b"\n") if (k := key_of(line)) is not None}
        out.append({fingerprint(k) for k in keys})
    return out


def _of_texts(batch: pa.RecordBatch) -> tuple[np.ndarray, bytes]:
    """The documents' ids, one for each of their distinct keys, and the keys' fingerprints."""
    prints = _document_prints(batch.column(1))
    return np.repeat(np.asarray(batch.column(0)), [len(p) for p in prints]), b"".join(b"".join(p) for p in prints)


def _of_prints(batch: pa.RecordBatch) -> tuple[np.ndarray, bytes]:
    return np.asarray(batch.column(0)), b"".join(batch.column(1).to_pylist())


def _sized(view: DataFrame) -> tuple[int, int]:
    """Bits of a filter and the number of slices, both powers of two, from a sketch of the keys."""
    keys = view.select(F.explode(F.split("text", "\n")).alias("line")).select(F.btrim("line", F.lit(_STRIP.decode())).alias("line"))
    n = keys.where(F.char_length("line") >= MIN_CHARS).agg(F.approx_count_distinct(F.xxhash64(F.lower("line")), 0.02).alias("n")).first().n
    whole = 1 << max(n * BITS_A_KEY - 1, 1).bit_length()
    return max(LEAST_BITS, min(whole, BITS)), max(1, whole // BITS)


def _sliced(view: DataFrame, slices: int) -> DataFrame:
    """``doc_id, line_key, slice`` of all keys, written once and sorted by slice within each file."""
    shift = np.uint64(65 - slices.bit_length())

    def cut(batches):
        for batch in batches:
            ids, flat = _of_texts(batch)
            part = np.frombuffer(flat, "<u8").reshape(-1, 2)[:, 1] >> shift
            keys = [flat[i : i + 16] for i in range(0, len(flat), 16)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(part.astype(np.int64))],
                                             names=["doc_id", "line_key", "slice"])

    return store(view.mapInArrow(cut, "doc_id long, line_key binary, slice long").sortWithinPartitions("slice"), "prints")


def _filter_builder(bits: int, of):
    def build(batches):
        from pyspark import TaskContext

        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        any_row = False
        for batch in batches:
            _, prints = of(batch)
            if not prints:
                continue
            any_row = True
            halves, count = np.unique(np.frombuffer(prints, "S16"), return_counts=True)
            at = _places(np.frombuffer(halves.tobytes(), "<u8"), bits)
            byte, bit = at >> 3, (1 << (at & 7)).astype(np.uint8)
            again = (count > 1) | ((once[byte] & bit) != 0).all(axis=1)
            np.bitwise_or.at(twice, byte[again].ravel(), bit[again].ravel())
            np.bitwise_or.at(once, byte.ravel(), bit.ravel())
        if any_row:
            size, task = bits // 8 // SEGMENTS, TaskContext.get().partitionId()
            cut = lambda a, s: zlib.compress(a[s * size : (s + 1) * size].tobytes(), 1)
            yield pa.RecordBatch.from_pydict({
                "segment": pa.array(range(SEGMENTS), pa.int32()), "grp": pa.array([task] * SEGMENTS, pa.int64()),
                "once": pa.array([cut(once, s) for s in range(SEGMENTS)], pa.binary()),
                "twice": pa.array([cut(twice, s) for s in range(SEGMENTS)], pa.binary())})

    return build


def _merge(table: pa.Table) -> pa.Table:
    once = twice = None
    for a, b in zip(table.column("once"), table.column("twice")):
        a, b = (np.frombuffer(zlib.decompress(x.as_py()), np.uint8) for x in (a, b))
        once, twice = (a, b) if once is None else (once | a, twice | b | (once & a))
    pack = lambda x: pa.array([zlib.compress(x.tobytes(), 1)], pa.binary())
    return pa.table({"segment": table.column("segment")[:1], "grp": table.column("grp")[:1], "once": pack(once), "twice": pack(twice)})


def twice_filter(view: DataFrame, bits: int = BITS, of=_of_texts) -> bytes:
    """The merged *twice* filter of ``bits / 8`` bytes over all keys that ``of`` reads from ``view``."""
    schema = "segment int, grp long, once binary, twice binary"
    parts = store(view.mapInArrow(_filter_builder(bits, of), schema), "filters")
    groups = parts.agg(F.max("grp").alias("m")).first().m
    while groups is not None and groups >= 0:
        parts = parts.withColumn("grp", F.floor(F.col("grp") / FAN_IN))
        parts = store(parts.groupBy("segment", "grp").applyInArrow(_merge, schema), "filters")
        groups = groups // FAN_IN if groups >= FAN_IN else -1
    size = bits // 8 // SEGMENTS
    out = bytearray(bits // 8)
    for row in parts.select("segment", "twice").collect():  # SEGMENTS rows
        out[row.segment * size : (row.segment + 1) * size] = zlib.decompress(row.twice)
    return bytes(out)


def _suspects(seen, bits: int, of):
    def find(batches):
        held = np.frombuffer(seen.value, np.uint8)
        for batch in batches:
            ids, flat = of(batch)
            if not flat:
                continue
            at = _places(np.frombuffer(flat, "<u8"), bits)
            hit = ((held[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)
            keys = np.frombuffer(flat, "V16")[hit]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[hit], pa.int64()), pa.array([k.tobytes() for k in keys], pa.binary())], names=["doc_id", "line_key"])

    return find


def suspects(view: DataFrame, bits: int | None = None) -> DataFrame:
    """``doc_id, line_key`` of all keys that *twice* holds, slice by slice where the filter needs it."""
    spark = view.sparkSession

    def held(part: DataFrame, size: int, of) -> DataFrame:
        seen = spark.sparkContext.broadcast(twice_filter(part, size, of))
        found = store(part.mapInArrow(_suspects(seen, size, of), "doc_id long, line_key binary"), "suspects")
        seen.destroy()
        return found

    size, slices = (bits, 1) if bits else _sized(view)
    if slices == 1:
        return held(view, size, _of_texts)
    prints = _sliced(view, slices)
    found = [held(prints.where(F.col("slice") == n).select("doc_id", "line_key"), size, _of_prints) for n in range(slices)]
    return reduce(DataFrame.unionByName, found)


def repeated_lines(docs: DataFrame, bits: int | None = None) -> DataFrame:
    """``doc_id, line_key``: for each document the fingerprints of the keys that it has to lose."""
    doubtful = suspects(documents_view(docs).where("doc_id IS NOT NULL"), bits)
    confirmed = (doubtful.groupBy("line_key").agg(F.min("doc_id").alias("holder"), F.max("doc_id").alias("last"))
                 .where("holder < last").select("line_key", "holder"))
    return doubtful.join(confirmed, "line_key").where("doc_id <> holder").select("doc_id", "line_key")


def dedup_lines(docs: DataFrame, bits: int | None = None) -> DataFrame:
    """The rows of ``docs`` without their repeated lines, plus ``n_lines`` and ``n_dropped``.

    ``text`` keeps its type and ``n_chars``, if there is one, follows the text. A row that loses
    nothing keeps its text as it is, NULL included.
    """
    plain, names = numbered(docs), docs.columns
    n, text = len(names), position(docs, "text")
    lost = (repeated_lines(docs, bits).groupBy("doc_id").agg(F.collect_set("line_key").alias("lost")))
    both = (plain.withColumn("sluice_id", F.col(f"c{position(docs, 'doc_id')}").cast("long"))
            .join(lost, F.col("sluice_id") == F.col("doc_id"), "left").select(*plain.columns, "lost"))
    schema = T.StructType([*plain.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def apply(batches):
        for batch in batches:
            column = batch.column(text)
            texts, lines, dropped = column.to_pylist(), [], []
            for i, gone in enumerate(batch.column(n).to_pylist()):
                if not gone:
                    lines.append((texts[i] or "").count("\n") + 1)
                    dropped.append(0)
                    continue
                gone, whole = set(gone), texts[i].encode().split(b"\n")
                stay = [x for x in whole if (k := key_of(x)) is None or fingerprint(k) not in gone]
                lines.append(len(whole))
                dropped.append(len(whole) - len(stay))
                texts[i] = b"\n".join(stay).decode()
            columns = [*batch.columns[:n], pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
            columns[text] = pa.array(texts, column.type)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    out = both.mapInArrow(apply, schema)
    if "n_chars" in names:
        count = position(docs, "n_chars")
        out = out.withColumn(f"c{count}", F.when(F.col("n_dropped") > 0, F.char_length(f"c{text}").cast(plain.schema[count].dataType))
                             .otherwise(F.col(f"c{count}")))
    return out.toDF(*names, "n_lines", "n_dropped")


def line_digest(docs: DataFrame, bits: int | None = None) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` per row."""
    out = dedup_lines(documents_view(docs), bits)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def drop_repeated_lines(docs: DataFrame, bits: int | None = None) -> DataFrame:
    """The rows of ``docs`` with the same columns, without their repeated lines."""
    out = numbered(dedup_lines(docs, bits))
    return out.select(*out.columns[: len(docs.columns)]).toDF(*docs.columns)
