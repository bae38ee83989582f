"""Ranked lexical search of many items at once, with shared parts computed once (operator 12).

Items are taken in blocks of bounded size. For a block, terms that occur in the same items are one
*atom*: whoever needs one of them needs all. Then shared sets are mined: the pair of nodes that
most items hold together becomes a new node, again and again, until no pair is in two items. This
gives a graph in which a node is the sum of two others and an item the sum of a few nodes.

1. One pass over the documents finds their terms, and stores of each the number of terms and the
   occurrences of the block's terms (whole texts, cut to what the items ask for).
2. Counts over all documents give every term's weight.
3. One pass over the stored occurrences evaluates the graph, many documents at a time: atoms are
   summed from their terms, each shared node is added up once from its two parts, and items
   combine nodes. A bounded heap per item keeps the task's best documents, and a ranking of
   what the tasks kept, a partition of an item's rows first, gives the best of all.

Scores are sums of 64-bit integers, so no order of adding changes them, and the result is exact.

Terms are maximal runs of characters other than ASCII non-alphanumerics, with A-Z lower-cased; in
UTF-8 those are runs of the bytes 0-9, A-Z, a-z and 80-FF. Defined cases: a NULL or empty text has no
term; a NULL ``item_id`` names no item, rows that repeat an ``item_id`` are one item with the
terms of all; every row of the documents is a document, also one that repeats a ``doc_id`` or
has none (it ranks behind others of equal score); an item without a scoring document has no row.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.frames import documents_view, pick, store

BEST = 50
#: an item block ends at so many items, or so many (item, term) pairs
BLOCK_ITEMS = 512
BLOCK_TERMS = 200_000
#: mined nodes a block at most; the pairs left then are simply added by each item
NODES = 50_000
#: an item's most shared nodes that take part in mining; what is not mined is added as it is
MINED = 64
#: documents evaluated at a time: so many, or fewer where the graph has many nodes
DOCUMENTS = 512
ACCUMULATORS = 1 << 22
PIECE = 1 << 22
SALTS = 32

_FOLD = bytearray(b" " * 256)
for _b in [*range(48, 58), *range(97, 123), *range(128, 256)]:
    _FOLD[_b] = _b
for _b in range(65, 91):
    _FOLD[_b] = _b + 32
_FOLD = bytes(_FOLD)


def terms_of(text: str):
    """Yield lists of the terms of a text, as bytes; a long text comes in pieces cut between terms."""
    data = text.encode().translate(_FOLD)
    at = 0
    while at < len(data):
        end = at + PIECE
        if end < len(data):
            cut = data.find(b" ", end)
            end = len(data) if cut < 0 else cut
        yield data[at:end].split()
        at = end


def shared_graph(items: list[list[int]], limit: int = NODES) -> tuple[list[list[int]], list[tuple[int, int]], list[list[int]]]:
    """``(atoms, sums, uses)`` for items given as lists of distinct term numbers.

    ``atoms``: the terms of nodes 0, 1, ...; ``sums``: the two parts of every node after them;
    ``uses``: the nodes whose sum is the item. Mining is greedy: most shared pair first.
    """
    holders: dict[int, list[int]] = defaultdict(list)
    for i, terms in enumerate(items):
        for t in terms:
            holders[t].append(i)
    groups: dict[tuple[int, ...], list[int]] = defaultdict(list)
    for t in sorted(holders):
        groups[tuple(holders[t])].append(t)
    atoms = list(groups.values())
    of_node = [set(g) for g in groups]
    uses: list[set[int]] = [set() for _ in items]
    for node, held in enumerate(of_node):
        for i in held:
            uses[i].add(node)
    # how many items hold a pair; only nodes in two items can be in a shared pair
    pairs: Counter = Counter()
    for nodes in uses:
        several = sorted(sorted((n for n in nodes if len(of_node[n]) > 1), key=lambda n: (-len(of_node[n]), n))[:MINED])
        pairs.update((a, b) for k, a in enumerate(several) for b in several[k + 1 :])
    queue = [(-c, p) for p, c in pairs.items() if c > 1]
    heapq.heapify(queue)
    sums: list[tuple[int, int]] = []
    while queue and len(sums) < limit:
        count, (a, b) = heapq.heappop(queue)
        both = of_node[a] & of_node[b]
        if len(both) != -count:  # an older count
            if len(both) > 1:
                heapq.heappush(queue, (-len(both), (a, b)))
            continue
        new = len(of_node)
        sums.append((a, b))
        of_node.append(both)
        of_node[a], of_node[b] = of_node[a] - both, of_node[b] - both
        near: Counter = Counter()
        for i in both:
            uses[i] -= {a, b}
            near.update(n for n in uses[i] if len(of_node[n]) > 1)
            uses[i].add(new)
        for n, c in near.items():
            if c > 1:
                heapq.heappush(queue, (-c, (n, new)))
    return atoms, sums, [sorted(u) for u in uses]


class Plan:
    """A block's graph as arrays, and its evaluation."""

    def __init__(self, items: list[list[int]], n_terms: int):
        atoms, self.sums, self.uses = shared_graph(items)
        self.n_atoms = len(atoms)
        self.atom = np.empty(n_terms, np.int64)
        for node, terms in enumerate(atoms):
            self.atom[terms] = node

    def scores(self, doc: np.ndarray, term: np.ndarray, value: np.ndarray, n_docs: int):
        """Yield the scores of the ``n_docs`` documents for every item, from (document, term, value) triples."""
        nodes = np.zeros((self.n_atoms + len(self.sums), n_docs), np.int64)
        np.add.at(nodes.reshape(-1), self.atom[term] * n_docs + doc, value)
        for k, (a, b) in enumerate(self.sums, self.n_atoms):
            np.add(nodes[a], nodes[b], out=nodes[k])
        for used in self.uses:
            yield nodes[used].sum(axis=0)


def _occurrences(vocabulary):
    """Per document: how many terms, and which of the block's terms how often."""

    def run(batches):
        find = vocabulary.value.get
        for batch in batches:
            sizes, terms, counts, offsets = [], [], [], [0]
            for text in batch.column(1).to_pylist():
                seen: Counter = Counter()
                n = 0
                for words in terms_of(text):
                    n += len(words)
                    seen.update(map(find, words))
                seen.pop(None, None)
                sizes.append(n)
                terms += seen.keys()
                counts += seen.values()
                offsets.append(len(terms))
            lists = lambda x: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), lists(terms), lists(counts)],
                                             names=["doc_id", "n", "terms", "counts"])

    return run


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _ranked(block, n_docs: int, n_all: int, best: int):
    """Per task: each item's best documents, at most ``best``."""

    def run(batches):
        plan, weights, names = block.value
        heaps: list[list] = [[] for _ in names]
        floor = np.zeros(len(names), np.int64)
        some = max(1, min(DOCUMENTS, ACCUMULATORS // (plan.n_atoms + len(plan.sums))))
        for whole in batches:
            for at in range(0, len(whole), some):
                part = whole.slice(at, some)
                ids, n = part.column(0).to_pylist(), part.column(1).to_numpy()
                m = 50 + (50 * n * n_docs) // n_all
                lists = part.column(2)
                doc = np.repeat(np.arange(len(part)), np.diff(lists.offsets.to_numpy()))
                term, tf = lists.flatten().to_numpy(), part.column(3).flatten().to_numpy().astype(np.int64)
                value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
                for i, score in enumerate(plan.scores(doc, term, value, len(part))):
                    for d in np.flatnonzero((score > 0) & (score >= floor[i])).tolist():
                        # the least entry of a heap is the worst document: low score, then high id, none last
                        entry = (int(score[d]), ids[d] is not None, -(ids[d] or 0))
                        if len(heaps[i]) < best:
                            heapq.heappush(heaps[i], entry)
                        elif entry > heaps[i][0]:
                            heapq.heapreplace(heaps[i], entry)
                        if len(heaps[i]) == best:
                            floor[i] = heaps[i][0][0]
        for i, heap in enumerate(heaps):
            if heap:
                yield pa.RecordBatch.from_pydict({"item_id": pa.array([names[i]] * len(heap), pa.int64()), "score": pa.array([e[0] for e in heap], pa.int64()),
                                                  "doc_id": pa.array([-e[2] if e[1] else None for e in heap], pa.int64())})

    return run


def item_blocks(items: DataFrame):
    """Yield blocks ``[(item_id, terms), ...]`` in ascending order of ids, one at a time on the driver."""
    rows = pick(items, item_id="long", text="string").where("item_id IS NOT NULL AND text IS NOT NULL").orderBy("item_id")
    block: dict[int, set[bytes]] = {}
    pairs = 0
    for r in rows.toLocalIterator():
        if r.item_id not in block and (len(block) >= BLOCK_ITEMS or pairs >= BLOCK_TERMS):
            yield block
            block, pairs = {}, 0
        held = block.setdefault(r.item_id, set())
        pairs -= len(held)
        for words in terms_of(r.text):
            held.update(words)
        pairs += len(held)
    if block:
        yield block


def _best(rows: DataFrame, best: int) -> DataFrame:
    """An item's best rows: of each of a few parts of its rows first, so that no task sorts them all."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*order))).where(F.col("rank") <= best)
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= best)
            .select("item_id", "rank", "doc_id", "score"))


def search(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """``item_id, rank, doc_id, score``: the best documents of every item; see the module."""
    spark = docs.sparkSession
    view, out = documents_view(docs), None
    for block in item_blocks(items):
        names, words = list(block), sorted(set().union(*block.values()))
        number = {w: i for i, w in enumerate(words)}
        if not words:
            continue
        vocabulary = spark.sparkContext.broadcast(number)  # bounded by the block
        found = store(view.mapInArrow(_occurrences(vocabulary), "doc_id long, n long, terms array<int>, counts array<int>"), "occurrences")
        total = found.where("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        if not total.docs:
            continue
        held = {r.term: r["count"] for r in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}  # the block's terms
        weights = np.array([weight(held[t], total.docs) if t in held else 0 for t in range(len(words))], np.int64)
        plan = Plan([[number[w] for w in block[i]] for i in names], len(words))
        shared = spark.sparkContext.broadcast((plan, weights, names))  # bounded by the block
        kept = found.where(F.size("terms") > 0).mapInArrow(_ranked(shared, total.docs, total.terms, best), "item_id long, score long, doc_id long")
        kept = store(kept, "kept")
        out = kept if out is None else out.unionByName(kept)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return _best(out, best)
