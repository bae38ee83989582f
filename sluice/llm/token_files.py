"""Token ids in bit-packed files with block offsets (operator 7).

A shard file holds the ids of consecutive documents, each id in the fewest bits that the
vocabulary needs. All numbers are little-endian::

    magic "SLTOK\\x001\\n", u32 bits, u32 ids a block, u64 ids, u64 documents, u64 blocks, i64 part, i64 shard
    documents x (i64 doc_id, u64 first id in the shard, u64 ids)    NULL doc_id: the least i64
    (blocks + 1) x u64 byte offsets of the blocks in the payload
    payload: each block starts at a byte; its ids are big-endian bit fields one after the other
    a closing newline

Block offsets make any id reachable without reading what is before it, and a block unpacks in a
few numpy calls. Ranges of ``doc_id`` are cut from that column alone. Texts are encoded, and their ids,
which are smaller, go straight to their range and are sorted there, so (part, shard) is the order of
documents and no copy of the ids is stored but the files. Files are written by Spark's own text sink, one row of raw bytes a file, so they are
committed like any Spark output and may lie in any store that Spark reaches. They are read back with
the ``binaryFile`` source. A shard has at most :data:`SHARD` ids unless one document has more.

Defined cases: a NULL or empty text is the end id alone; rows that repeat a ``doc_id`` follow each
other in the order of their ids' bytes; an empty table writes no shard.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from sluice.llm.chunks import ChunkEncoder
from sluice.llm.frames import documents_view, scratch_dir, store

MAGIC = b"SLTOK\x001\n"
HEADER = "<8sIIQQQqq"
BLOCK = 4096
SHARD = 4_000_000
NO_ID = -(1 << 63)


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """The ids as consecutive big-endian fields of ``bits`` bits, padded to a whole byte."""
    if bits == 16:
        return ids.astype(">u2").tobytes()
    fields = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)[:, 32 - bits :]
    return np.packbits(fields).tobytes()


def unpack_bits(data: bytes, n: int, bits: int) -> np.ndarray:
    if bits == 16:
        return np.frombuffer(data, ">u2", n).astype("<u4")
    fields = np.zeros((n, 32), np.uint8)
    fields[:, 32 - bits :] = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits).reshape(n, bits)
    return np.packbits(fields, axis=1).view(">u4").ravel().astype("<u4")


def shard_bytes(docs: list[int | None], ids: list[np.ndarray], bits: int, part: int, shard: int) -> bytes:
    """One shard file, without the closing newline."""
    sizes = np.array([len(i) for i in ids], np.uint64)
    flat = np.concatenate(ids)
    blocks = [pack_bits(flat[a : a + BLOCK], bits) for a in range(0, len(flat), BLOCK)]
    index = np.empty((len(docs), 3), "<u8")
    index[:, 0] = np.array([NO_ID if d is None else d for d in docs], "<i8").view("<u8")
    index[:, 1], index[:, 2] = np.cumsum(sizes) - sizes, sizes
    offsets = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    head = struct.pack(HEADER, MAGIC, bits, BLOCK, len(flat), len(docs), len(blocks), part, shard)
    return b"".join([head, index.tobytes(), offsets.tobytes(), *blocks])


class Shard:
    """Random access to a shard file's bytes."""

    def __init__(self, data: bytes):
        magic, self.bits, self.block, self.n_ids, n_docs, n_blocks, self.part, self.shard = struct.unpack_from(HEADER, data)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = struct.calcsize(HEADER)
        index = np.frombuffer(data, "<u8", 3 * n_docs, at).reshape(-1, 3)
        self.docs, self.first, self.sizes = index[:, 0].view("<i8") if n_docs else index[:, 0], index[:, 1].astype(np.int64), index[:, 2].astype(np.int64)
        at += 24 * n_docs
        self.offsets = np.frombuffer(data, "<u8", n_blocks + 1, at).astype(np.int64)
        self.payload = memoryview(data)[at + 8 * (n_blocks + 1) :]

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from id number ``start`` on; only the blocks that hold them are touched."""
        if not n:
            return np.empty(0, "<u4")
        first, last = start // self.block, (start + n - 1) // self.block
        parts = [unpack_bits(self.payload[self.offsets[b] : self.offsets[b + 1]], min(self.block, self.n_ids - b * self.block), self.bits)
                 for b in range(first, last + 1)]
        return np.concatenate(parts)[start - first * self.block :][:n]


def range_cuts(df: DataFrame, column: str) -> np.ndarray:
    """Ascending last values of about equal ranges of a column of longs, one range a shuffle partition at most."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if parts < 2:
        return np.empty(0, np.int64)
    shares = [i / parts for i in range(1, parts)]
    cuts = df.agg(F.percentile_approx(column, shares, max(10_000, 10 * parts)).alias("cuts")).first().cuts
    return np.unique(np.array(cuts or [], np.int64))


def write_tokens(docs: DataFrame, folder: str, path: str, end: int, kind: str = "spaced", shard_ids: int = SHARD) -> None:
    """Encode every text, append ``end``, and write shard files below ``folder``."""
    view = documents_view(docs)
    cuts = range_cuts(view, "doc_id")

    def encode(batches):
        encoder = ChunkEncoder.of(path, kind)
        wide = "<u4" if max(encoder.tokenizer.get_vocab_size() - 1, end) >> 16 else "<u2"
        last = np.array([end], wide).tobytes()
        for whole in batches:
            for at in range(0, len(whole), 2048):
                batch = whole.slice(at, 2048)
                ids = [i.astype(wide, copy=False).tobytes() + last for i in encoder.encode(batch.column(1).to_pylist())]
                # NULL lies before all others, as in the sort
                part = np.searchsorted(cuts, batch.column(0).fill_null(NO_ID).to_numpy()).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(part), batch.column(0), pa.array(ids, pa.binary())], names=["part", "doc_id", "ids"])

    def lay(batches):
        from pyspark import TaskContext

        top, part = max(Tokenizer.from_file(path).get_vocab_size() - 1, end, 1), TaskContext.get().partitionId()
        docs_, ids_, size, shard = [], [], 0, 0
        for batch in batches:
            for doc, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(data.as_buffer(), "<u4" if top >> 16 else "<u2")
                if size and size + len(ids) > shard_ids:
                    yield pa.RecordBatch.from_pydict({"shard": pa.array([shard_bytes(docs_, ids_, top.bit_length(), part, shard)], pa.binary())})
                    docs_, ids_, size, shard = [], [], 0, shard + 1
                docs_.append(doc)
                ids_.append(ids)
                size += len(ids)
        if docs_:
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard_bytes(docs_, ids_, top.bit_length(), part, shard)], pa.binary())})

    # each range is a partition of its own; repartitionByRange would read, and encode, its input twice
    encoded = view.mapInArrow(encode, "part int, doc_id long, ids binary").repartitionById(len(cuts) + 1, "part")
    shards = encoded.select("doc_id", "ids").sortWithinPartitions("doc_id", "ids").mapInArrow(lay, "shard binary")
    shards.select(F.col("shard").cast("string")).write.option("maxRecordsPerFile", 1).text(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids array<int>, part, shard, shard_ids`` of every document."""

    def decode(batches):
        for batch in batches:
            for data in batch.column(0):
                s = Shard(data.as_py())
                for at in range(0, len(s.docs), 512):
                    some = slice(at, at + 512)
                    sizes = s.sizes[some]
                    # neighbours share blocks, and a block is unpacked once for all of them
                    flat = s.ids(int(s.first[at]), int(sizes.sum())).astype(np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat))
                    m = len(ids)
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array([None if d == NO_ID else d for d in s.docs[some].tolist()], pa.int64()),
                        "first": pa.array(s.first[some]), "n_tokens": pa.array(sizes), "ids": ids,
                        "part": pa.array([s.part] * m, pa.int64()), "shard": pa.array([s.shard] * m, pa.int64()),
                        "shard_ids": pa.array([s.n_ids] * m, pa.int64())})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    return files.mapInArrow(decode, "doc_id long, first long, n_tokens long, ids array<int>, part long, shard long, shard_ids long")


def _checked(batches):
    for batch in batches:
        crc = [zlib.crc32(np.asarray(i.values).astype("<u4").tobytes()) for i in batch.column("ids")]
        keep = [c for c in batch.schema.names if c != "ids"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(crc, pa.int64())], names=[*keep, "ids_crc32"])


def token_digest(docs: DataFrame, path: str, end: int, kind: str = "spaced") -> DataFrame:
    """Write the ids of ``docs`` to files, read them back, and return each document's digest."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "tokens")
    write_tokens(docs, folder, path, end, kind)
    rows = store(read_tokens(spark, folder).mapInArrow(
        _checked, "doc_id long, first long, n_tokens long, part long, shard long, shard_ids long, ids_crc32 long"), "digest")
    # running sums within a part, and over the parts, of which there is one a task of the writer
    shards = rows.groupBy("part", "shard").agg(F.max("shard_ids").alias("shard_ids"))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("shard_ids").alias("part_ids"))
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("part_ids").over(over), F.lit(0)).alias("part_before"))
    shards = (shards.withColumn("shard_before", F.coalesce(F.sum("shard_ids").over(within), F.lit(0))).join(parts, "part")
              .select("part", "shard", (F.col("part_before") + F.col("shard_before")).alias("before")))
    return rows.join(shards, ["part", "shard"]).select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
