"""Packing documents into sequences by minimum bin slack (operator 5).

Documents become token ids and an end id; only those longer than a sequence are cut. What the
packing needs to know of the corpus is how many pieces there are of each length: at most
``capacity`` numbers, whatever the input. On that histogram, a bin takes the longest length left
and the fullest feasible combination of the others with it, found by a subset-sum dynamic program
whose reachable sums are the bits of one integer. The combination is removed as many times as
the histogram allows, so one solved bin serves many sequences.

Pieces then find their places in parallel: a piece's rank among those of its length (a window over
salted groups plus their running counts) names its combination, copy and offset by binary search
in the table of combinations, which has a few thousand rows.

Defined cases: a NULL or empty text is the end id alone; repeated rows and NULL ``doc_id`` are
documents like others; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.llm.chunks import ChunkEncoder
from sluice.llm.frames import documents_view, store

CAPACITY = 4096
END = 1
RANKED = 100_000


def minimum_bin_slack(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """``(times, [(length, copies), ...])`` combinations that use up the counts, fullest first."""
    left = {n: c for n, c in counts.items() if c > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError(f"lengths must lie in 1..{capacity}")
    lengths = sorted(left, reverse=True)
    out = []
    while lengths:
        head = lengths[0]
        room = capacity - head
        reach, steps, goal, mask = 1, [], 1 << room, (1 << (room + 1)) - 1
        for n in lengths:
            if n > room or reach & goal:
                continue
            free, k = min(left[n] - (n == head), room // n), 1
            while free > 0 and not reach & goal:
                k = min(k, free)
                steps.append((n, k, reach))
                reach = (reach | (reach << (n * k))) & mask
                free, k = free - k, 2 * k
        total, use = reach.bit_length() - 1, {head: 1}
        for n, k, before in reversed(steps):
            if not before >> total & 1:
                use[n] = use.get(n, 0) + k
                total -= n * k
        times = min(left[n] // c for n, c in use.items())
        for n, c in use.items():
            left[n] -= times * c
        out.append((times, sorted(use.items(), reverse=True)))
        lengths = [n for n in lengths if left[n]]
    return out


def _places(patterns) -> tuple[np.ndarray, ...]:
    """Columns by (length, first rank): copies a bin, first sequence, offset in the bin."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for times, use in patterns:
        offset = 0
        for n, copies in use:
            first = rank.get(n, 0)
            rows.append((n, first, copies, sequence, offset))
            rank[n] = first + times * copies
            offset += n * copies
        sequence += times
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows)) if rows else (np.empty(0, np.int64),) * 5


def token_pieces(docs: DataFrame, path: str, kind: str, end: int = END, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece of every document."""

    def cut(batches):
        encoder = ChunkEncoder.of(path, kind)
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist())):
                ids = np.append(ids, end).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    for column, value in zip(rows, (doc, piece, start, len(part), zlib.crc32(part.tobytes()))):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return documents_view(docs).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any columns, with a ``length``) plus ``sequence_id`` and ``offset``."""
    pieces = store(pieces, "pieces")
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    table = _places(minimum_bin_slack(counts, capacity))
    salt = max(1, -(-max(counts.values(), default=1) // RANKED))
    spread = [c for c in pieces.columns if c != "length"]
    dealt = pieces.withColumn("salt", F.pmod(F.xxhash64(*spread), F.lit(salt)))
    sums = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = (dealt.groupBy("length", "salt").agg(F.count("*").alias("n"))
              .select("length", "salt", F.coalesce(F.sum("n").over(sums), F.lit(0)).alias("before")))
    order = Window.partitionBy("length", "salt").orderBy(*spread)
    ranked = (dealt.withColumn("nth", F.row_number().over(order).cast("long")).join(before, ["length", "salt"])
              .select(*pieces.columns, (F.col("before") + F.col("nth") - 1).alias("nth")))
    names = [*pieces.columns, "sequence_id", "offset"]
    at, nth = pieces.columns.index("length"), len(pieces.columns)
    schema = ranked.drop("nth").schema.add("sequence_id", "long").add("offset", "long")

    def place(batches):
        n, first, copies, sequence, offset = table
        wide = np.int64(1) << 40
        keys = n * wide + first
        for batch in batches:
            length, rank = (np.asarray(batch.column(i)).astype(np.int64) for i in (at, nth))
            row = np.searchsorted(keys, length * wide + rank, side="right") - 1
            copy, turn = divmod(rank - first[row], copies[row])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:nth], pa.array(sequence[row] + copy), pa.array(offset[row] + turn * length)], names=names)

    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, path: str, kind: str = "plain", end: int = END, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise and pack whole documents; one row a piece."""
    return pack(token_pieces(docs, path, kind, end, capacity), capacity)
