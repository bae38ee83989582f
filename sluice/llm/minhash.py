"""MinHash near-duplicate detection by an LSH forest (operator 1).

Every document becomes the set of its distinct five-word shingles. Documents with equal sets are
one class, so copies never meet each other again. Each class has a 128-value MinHash signature;
the forest holds it in :data:`TREES` sorted orders, and order ``t`` sorts by the signature read
from value ``4 * t`` on. Orders are dealt by ranges of the whole sort key, so a crowded prefix is
split over tasks; nothing is joined or grouped on a prefix. Classes that agree in the first
:data:`DEPTH` values of an order stand side by side there: a *run*. A pair at the threshold
shares at least one run but for a chance of ``(1 - 0.75**4)**32 < 6e-6``.

Candidates are found in rounds, and every link is confirmed on the full shingle sets:

* in each order a class meets the class before and the one behind it if they belong to other
  components (first and last rows of the ranges meet as well). Over all orders it takes the
  neighbour with the longest common prefix, and its least neighbour. The depth adapts itself:
  where a region is crowded, neighbours agree deeper. So a group of ``n`` near copies costs about
  ``2 n`` pairs a round. Runs that are one component by then are finished;
* after :data:`ROUNDS` rounds, or when no new pair comes up, runs that still hold more than one
  component are compared whole, in tiles of bounded size: every class outside a run's largest
  component meets every class of the run, once over all orders. Tiles return a spanning forest
  of the links found, never all pairs. Only pairs whose signatures agree in too few values for a
  link are left out: an estimate of 0.6 for a true 0.75 is four standard deviations off.

Defined cases: NULL or empty text, or one without a word: ``n_shingles`` 0, its own component.
A NULL ``doc_id`` can't be told from others: such a row comes back with a NULL component and
``kept`` true. Rows that repeat a ``doc_id`` come back once, with the largest set size. All their
texts are searched, and what any of them is linked to is linked with the document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.frames import documents_view, numbered, position, store, store_counting
from sluice.llm.graph import connected_components
from sluice.llm.shingles import SIGNATURE, mix, set_key, shingle_sets, signature

TREES = 32
DEPTH = 4
ROUNDS = 3
REGION = 1024
NEAR = 0.6
THRESHOLD = 75

_ORDER = "tree int, hi long, lo long, node long, comp long"
_RUN = _ORDER + ", before long, after long, shared_before int, shared_after int, region long, n long, main long, most long, border boolean, tip boolean"


def _sign(batches):
    for batch in batches:
        ids, sizes, keys, signs = batch.column(0), [], [], []
        for s in shingle_sets(batch.column(1)):
            sizes.append(len(s))
            keys.append(set_key(s) if len(s) else None)
            signs.append(signature(s) if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signs, pa.binary())],
            names=["doc_id", "n_shingles", "set_key", "sign"])


def _sets(batches):
    for batch in batches:
        sets = list(shingle_sets(batch.column(1)))
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        flat = np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([set_key(s) for s in sets], pa.binary()),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array([signature(s) for s in sets], pa.binary())],
            names=["doc_id", "set_key", "shingles", "sign"])


def _ordered(batches):
    """Every class once for each order, with the eight values that the order reads first."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            node, comp = part.column(0).to_numpy(), part.column(1).to_numpy()
            words = np.frombuffer(b"".join(part.column(2).to_pylist()), ">i8").reshape(len(node), TREES).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(TREES, dtype=np.int32), len(node))), pa.array(words.ravel()),
                 pa.array(np.roll(words, -1, axis=1).ravel()), pa.array(np.repeat(node, TREES)), pa.array(np.repeat(comp, TREES))],
                names=["tree", "hi", "lo", "node", "comp"])


def _open_runs(table: pa.Table, head: bool, tail: bool) -> pa.RecordBatch:
    """The rows of whole runs that hold several components, and those of runs that may go on in another range."""
    tree, hi, lo, node, comp = (table.column(c).to_numpy() for c in ("tree", "hi", "lo", "node", "comp"))
    size = len(node)
    start = np.flatnonzero(np.concatenate([[True], (hi[1:] != hi[:-1]) | (tree[1:] != tree[:-1])]))
    n = np.diff(np.append(start, size))
    border = np.zeros(len(start), bool)
    border[0] |= head
    border[-1] |= tail
    kept = border | (np.minimum.reduceat(comp, start) != np.maximum.reduceat(comp, start))
    # runs of the same classes are one region, in whatever order they are found
    mark = mix(node.view(np.uint64))
    region = mix(np.add.reduceat(mark, start) ^ mix(np.bitwise_xor.reduceat(mark, start) + n.astype(np.uint64)))
    # the component with most rows of each run
    run = np.repeat(np.arange(len(start)), n)
    by = np.lexsort((comp, run))
    first = np.flatnonzero(np.concatenate([[True], (run[by][1:] != run[by][:-1]) | (comp[by][1:] != comp[by][:-1])]))
    count, owner = np.diff(np.append(first, size)), run[by][first]
    best = np.lexsort((count, owner))
    best = best[np.append(owner[best][1:] != owner[best][:-1], True)]
    main, most = comp[by][first][best], count[best]
    # neighbours of other components, and how many values they share
    meets = (run[1:] == run[:-1]) & (comp[1:] != comp[:-1])
    x = (lo[1:] ^ lo[:-1]).view(np.uint64)
    shared = DEPTH + sum((x >> np.uint64(s)) == 0 for s in (48, 32, 16, 0)).astype(np.int32)
    none, tip = np.array([False]), np.zeros(size, bool)
    tip[0], tip[-1] = head, tail
    before, after = np.concatenate([none, meets]), np.concatenate([meets, none])
    rows = np.flatnonzero(kept[run])
    of = run[rows]
    pick = lambda values, there: pa.array(values[rows], mask=~there[rows])
    return pa.RecordBatch.from_arrays(
        [pa.array(c[rows]) for c in (tree, hi, lo, node, comp)]
        + [pick(np.roll(node, 1), before), pick(np.roll(node, -1), after),
           pick(np.append(np.int32(0), shared).astype(np.int32), before), pick(np.append(shared, 0).astype(np.int32), after),
           pa.array(region.view(np.int64)[of]), pa.array(n[of]), pa.array(main[of]), pa.array(most[of].astype(np.int64)),
           pa.array(border[of]), pa.array(tip[rows])],
        names=[c.split()[0] for c in _RUN.split(", ")])


def _walk(batches):
    """Sorted rows of one range, cut where a run begins; at most a run and a batch are held."""
    held, head = [], True
    for batch in batches:
        if not batch.num_rows:
            continue
        tree, hi = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        begins = np.flatnonzero((hi[1:] != hi[:-1]) | (tree[1:] != tree[:-1])) + 1
        if not len(begins):
            held.append(batch)
            continue
        yield _open_runs(pa.Table.from_batches([*held, batch.slice(0, int(begins[-1]))]), head, False)
        held, head = [batch.slice(int(begins[-1]))], False
    if held:
        yield _open_runs(pa.Table.from_batches(held), head, True)


def _forest(nodes: DataFrame) -> DataFrame:
    """``nodes(node, comp, sign)`` -> the rows of all open runs, with their neighbours."""
    orders = nodes.select("node", "comp", "sign").mapInArrow(_ordered, _ORDER)
    key = ["tree", "hi", "lo", "node"]
    rows = store(orders.repartitionByRange(*key).sortWithinPartitions(*key).mapInArrow(_walk, _RUN), "runs")
    # a range has two border runs at most, so this table is bounded by the number of partitions
    borders = (rows.where("border").groupBy("tree", "hi")
               .agg(F.count("*").alias("all_rows"), F.min("comp").alias("low"), F.max("comp").alias("high"),
                    F.max(F.struct("most", "main")).alias("best")).where("low <> high"))
    edge = (rows.where("border").join(F.broadcast(borders), ["tree", "hi"])
            .withColumns({"region": F.xxhash64("tree", "hi"), "n": F.col("all_rows"), "main": F.col("best.main"), "most": F.col("best.most")}))
    return rows.where("NOT border").unionByName(edge.select(*rows.columns))


def _candidates(rows: DataFrame) -> DataFrame:
    """``(a, b)``: each class with its longest-prefix and its least neighbour, and rows that meet where ranges do."""
    sides = (rows.select("node", F.explode(F.array(F.struct(F.col("before").alias("other"), F.col("shared_before").alias("shared")),
                                                   F.struct(F.col("after").alias("other"), F.col("shared_after").alias("shared")))).alias("s"))
             .select("node", "s.other", "s.shared").where("other IS NOT NULL"))
    found = (sides.groupBy("node").agg(F.max(F.struct("shared", "other")).alias("deep"), F.min("other").alias("least"))
             .select("node", F.explode(F.array("deep.other", "least")).alias("other")))
    line = Window.partitionBy("tree").orderBy("hi", "lo", "node")  # two rows a range
    tips = (rows.where("tip").select("node", F.lag("node").over(line).alias("other"), "hi", F.lag("hi").over(line).alias("was"),
                                     "comp", F.lag("comp").over(line).alias("old")).where("hi = was AND comp <> old").select("node", "other"))
    return found.unionByName(tips).select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _confirm(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Pairs ``(a, b)`` that are links on their full sets. A class is in a pair of few others, two an order at most."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"), F.size("shingles").alias("na"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"), F.size("shingles").alias("nb"))
    both = F.size(F.array_intersect("sa", "sb"))
    # merge joins at every size: the plan on a small input is the plan on a large one
    return (pairs.join(right.hint("merge"), "b").join(left.hint("merge"), "a")
            .where(100 * F.least("na", "nb") >= threshold * F.greatest("na", "nb"))
            .where(100 * both >= threshold * (F.col("na") + F.col("nb") - both))
            .select("a", "b"))


def _linker(threshold: int):
    """For one tile: the links between its components, confirmed on full sets, as a spanning forest.

    A pair that shares a run of an earlier order is left to that order.
    """

    def link(table: pa.Table) -> pa.Table:
        ids, first = np.unique(table.column("node").to_numpy(), return_index=True)
        table = table.take(pa.array(first))
        signs = np.frombuffer(b"".join(table.column("sign").to_pylist()), ">u2").reshape(-1, SIGNATURE).astype(np.uint16)
        comp, tree = table.column("comp").to_numpy(), table.column("tree")[0].as_py()
        sets = table.column("shingles").combine_chunks()
        edges = sets.offsets.to_numpy()
        size = np.diff(edges)
        values, local = np.unique(sets.flatten().to_numpy(), return_inverse=True)
        local = [local[s:e] for s, e in zip(edges - edges[0], edges[1:] - edges[0])]
        here = np.zeros(len(values), bool)
        root = {c: c for c in comp.tolist()}

        def top(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        a, b = [], []
        for i in range(len(ids) - 1):
            others = np.flatnonzero(comp[i + 1 :] != comp[i]) + i + 1
            equal = signs[others] == signs[i]
            agree = equal.mean(axis=1)
            near = agree > NEAR
            if tree:
                near &= ~equal[:, : DEPTH * tree].reshape(len(others), tree, DEPTH).all(axis=2).any(axis=1)
            near &= 100 * np.minimum(size[others], size[i]) >= threshold * np.maximum(size[others], size[i])
            if not near.any():
                continue
            here[local[i]] = True
            for j in others[near][np.argsort(-agree[near], kind="stable")].tolist():
                x, y = top(int(comp[i])), top(int(comp[j]))
                if x != y:
                    both = int(np.count_nonzero(here[local[j]]))
                    if 100 * both >= threshold * (int(size[i]) + int(size[j]) - both):
                        root[max(x, y)] = min(x, y)
                        a.append(int(ids[i]))
                        b.append(int(ids[j]))
            here[local[i]] = False
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return link


def _tiled(rows: DataFrame) -> DataFrame:
    """Rows of open runs in tiles of bounded size in which every pair of other components of a run meets.

    Pairs within the run's largest component are settled, so it is enough that every row
    outside it meets every row. Both are dealt into parts, and each tile holds one of each.
    """
    once = rows.groupBy("region", "node", "comp", "n", "main", "most").agg(F.min("tree").alias("tree"))
    once = once.withColumn("parts", F.ceil(F.col("n") / REGION)).withColumn("strips", F.greatest(F.lit(1), F.ceil((F.col("n") - F.col("most")) / REGION)))
    whole = once.where("parts = 1").withColumn("part", F.lit(0).cast("long")).withColumn("strip", F.lit(0).cast("long"))
    large = once.where("parts > 1")
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    every = large.withColumn("part", F.pmod(F.xxhash64("node"), "parts")).withColumn("strip", upto("strips"))
    outer = (large.where("comp <> main").withColumn("strip", F.pmod(F.xxhash64("node", F.lit(1)), "strips"))
             .withColumn("part", upto("parts")))
    return (whole.unionByName(every).unionByName(outer)
            .select(F.xxhash64("region", "part", "strip").alias("tile"), "tree", "node", "comp"))


def _classes(known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(set_key, rep, sign, node)`` for every distinct set, and the links between texts of one ``doc_id``.

    ``rep`` is the least ``doc_id`` with the set. It names the class too, unless a ``doc_id`` that
    repeats with other texts is the least of several classes: all but one of them are named by hash.
    """
    plain = store(known.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("sign").alias("sign")), "sets")
    crowded = (plain.groupBy("rep").agg(F.min("set_key").alias("least_key"), F.count("*").alias("of")).where("of > 1")
               .select("rep", "least_key"))
    classes = store(plain.join(crowded, "rep", "left")
                    .withColumn("node", F.expr("CASE WHEN least_key <> set_key THEN xxhash64(set_key) ELSE rep END"))
                    .drop("least_key"), "classes")
    twins = store(known.groupBy("doc_id").agg(F.min("set_key").alias("a_key"), F.max("set_key").alias("z_key")).where("a_key <> z_key")
                  .select("doc_id", "a_key"), "twins")
    keys = known.join(twins, "doc_id").where("a_key <> set_key").select("a_key", "set_key").distinct()
    named = classes.select("set_key", "node")
    same = (keys.join(named.withColumnRenamed("node", "b"), "set_key")
            .join(named.toDF("a_key", "a"), "a_key").select("a", "b"))
    return classes, store(same, "same")


def _labels(classes: DataFrame, comps: DataFrame) -> DataFrame:
    """``(set_key, comp)`` where ``comp`` is the least ``doc_id`` of all classes of the component."""
    named = classes.select("set_key", "rep", "node").join(comps, "node")
    least = named.groupBy("comp").agg(F.min("rep").alias("least"))
    linked = named.join(least, "comp").select("node", "least")
    return classes.select("set_key", "rep", "node").join(linked, "node", "left").select("set_key", F.coalesce("least", "rep").alias("comp"))


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every document; see the module."""
    view = documents_view(docs)
    signed = store(view.mapInArrow(_sign, "doc_id long, n_shingles long, set_key binary, sign binary"), "signed")
    known = signed.where("doc_id IS NOT NULL AND set_key IS NOT NULL")
    classes, links = _classes(known)
    comps = connected_components(links)

    def grown(nodes: DataFrame) -> DataFrame:
        return nodes.join(comps, "node", "left").select("node", F.coalesce("comp", "node").alias("comp"), "sign")

    nodes = classes.select("node", "sign")
    rows = _forest(grown(nodes))
    wanted = store(rows.select("node").distinct(), "wanted")
    nodes = store(nodes.join(wanted, "node", "left_semi"), "nodes")
    named = classes.join(wanted, "node", "left_semi").select("set_key", "rep", "node")
    texts = view.where("doc_id IS NOT NULL").join(named.select(F.col("rep").alias("doc_id")).hint("merge"), "doc_id", "left_semi")
    sets = store(texts.mapInArrow(_sets, "doc_id long, set_key binary, shingles array<long>, sign binary")
                 .join(named.hint("merge"), "set_key").where("doc_id = rep")
                 .groupBy("set_key").agg(F.first(F.struct("node", "shingles", "sign")).alias("s")).select("s.*"), "shingles")

    tried = None
    for _ in range(ROUNDS):
        pairs = _candidates(rows)
        pairs, found = store_counting(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        if not found:
            break
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = links.unionByName(store(_confirm(pairs, sets, threshold), "links"))
        comps = connected_components(links)
        rows = _forest(grown(nodes))
    tiles = _tiled(rows).join(sets.hint("merge"), "node")
    rest, found = store_counting(tiles.groupBy("tile").applyInArrow(_linker(threshold), "a long, b long"), "rest")
    if found:
        comps = connected_components(links.unionByName(rest))

    result = (signed.where("doc_id IS NOT NULL").join(_labels(classes, comps), "set_key", "left")
              .select("doc_id", "n_shingles", F.coalesce("comp", "doc_id").alias("comp"))
              .groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"), F.min("comp").alias("component_id"))
              .select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept")))
    nameless = signed.where("doc_id IS NULL").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"))
    return result.unionByName(nameless)


def drop_near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of the documents that stay: the least ``doc_id`` of every component."""
    gone = near_duplicates(docs, threshold).where(~F.col("kept")).select(F.col("doc_id").alias("gone_id"))
    key = F.col(f"c{position(docs, 'doc_id')}").cast("long")
    return numbered(docs).join(gone, key == F.col("gone_id"), "left_anti").toDF(*docs.columns)
