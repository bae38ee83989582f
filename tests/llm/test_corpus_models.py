"""Language-model scores, ranked search and centroid clustering against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from sluice.llm import centroids, mixing, ranked

WORDS = [f"w{i}" for i in range(60)] + ["über", "naïve", "日本", "x"]


def _some_texts(n=60, seed=3):
    rng = random.Random(seed)
    texts = [" ".join(rng.choices(WORDS, k=rng.randint(1, 60))) + rng.choice(["", "\n", " The END."]) for _ in range(n)]
    return texts + [None, "", " \t\n\x0b\x0c\r", "a" * 500, "W1  w2\x1cw3 \0 é", texts[0], texts[0]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, "clash", t, t, "x") for i, t in enumerate(_some_texts())] + [(None, "clash", "no id w1", None, "y"), (5, "clash", "other text", None, "z")]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        return spark.createDataFrame(rows, "doc_id long, Text string, text string, TEXT string, row string").repartition(3)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


# ---- operator 11 ------------------------------------------------------------------------


def _lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def _tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", _lower(text)) + [None]


def _held(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 == 2


def _slow_key(data, i, k):
    """Hashed context of byte ``i`` in plain integers."""
    mask, m = (1 << 32) - 1, [int(x) for x in mixing._MULTIPLY]
    before = bytes(mixing.LEAD) + data[:i]
    if k < 2:
        context = sum(before[-j] << 8 * (j - 1) for j in range(1, k + 4))
    else:
        word = re.split(rb"[\0\x20\x09-\x0D]", before[-mixing.LEAD + 1 :])[-1]
        context, power = 0, 1
        for b in word:
            power = power * mixing._POWER & mask
            context = (context + (b + 1) * power) & mask
    h = (context ^ (k * 0x01000193 + 1)) * m[k] & mask
    return ((h ^ (h >> 15)) * m[k + 1] & mask) >> (32 - mixing.KEY_BITS)


def _slow_steps(byte):
    """``(what is known, half byte)`` for each step of a byte."""
    usual = mixing.USUAL + bytes(sorted(set(range(256)) - set(mixing.USUAL)))
    n = usual.index(byte)
    if n < 12:
        return [(0, n)]
    if n < 60:
        high, low = divmod(n - 12, 16)
        return [(0, 12 + high), (13 + high, low)]
    high, low = divmod(n - 60, 16)
    return [(0, 15), (16, high), (17 + high, low)]


def _slow_costs(training, texts):
    """The model bit by bit, with dictionaries; contexts that lose their block are unknown."""
    as_bytes = lambda t: _lower(t).encode() + bytes([mixing.END])

    def place(key, known, k):
        at, check = mixing.places_of(np.array([key], np.uint32), np.array([known], np.uint32), mixing.BLOCK_BITS[k])
        return int(at[0]), int(check[0])

    met, seen = Counter(), Counter()
    for d in map(as_bytes, training):
        for i, b in enumerate(d):
            for k in range(mixing.PREDICTORS):
                key = _slow_key(d, i, k)
                for step, (known, half) in enumerate(_slow_steps(b)):
                    met[k, key, known, step] += 1
                    seen[k, key, known, half] += 1
    users = {}
    for k, key, known, step in met:
        users.setdefault((k, place(key, known, k)[0]), []).append((-met[k, key, known, step], step, key, known))
    holder = {at: min(u) for at, u in users.items()}
    out = []
    for data in map(as_bytes, texts):
        weights = np.array([[list(mixing.START[g]) for g in range(mixing.GATES)] for _ in range(4)])
        nats, at, size = 0.0, 0, mixing.FIRST_BLOCK
        steps = [(i, *s) for i, b in enumerate(data) for s in _slow_steps(b)]
        ends = [n for n, (i, *_) in enumerate(steps) if n and i != steps[n - 1][0] and i % mixing.PIECE == 0] + [len(steps)]
        while at < len(steps):
            to = min(at + size, next(e for e in ends if e > at))
            moves = np.zeros_like(weights)
            for i, known, half in steps[at:to]:
                held = []
                for k in range(mixing.PREDICTORS):
                    key = _slow_key(data, i, k)
                    where, check = place(key, known, k)
                    mine = holder.get((k, where))
                    held.append(mine and place(mine[2], mine[3], k)[1] == check and mine)
                gate = sum(-held[-1][0] >= m for m in mixing.MET) if held[-1] else 0
                for j in range(4):
                    x = []
                    for k, mine in enumerate(held):
                        n = [0, 0]
                        for h in range(16) if mine else ():
                            if h >> (4 - j) == half >> (4 - j):
                                n[(h >> (3 - j)) & 1] += seen[k, mine[2], mine[3], h]
                        odds = math.log((n[1] + mixing.PRIOR) / (n[0] + mixing.PRIOR))
                        x.append(max(-127, min(127, round(mixing.SCALE * odds))) / mixing.SCALE)
                    bit, z = (half >> (3 - j)) & 1, float(np.dot(weights[j, gate], x))
                    p = 1 / (1 + math.exp(-z))
                    nats -= math.log(p if bit else 1 - p)
                    moves[j, gate] += (bit - p) * np.array(x)
            weights += mixing.RATE / (to - at) * moves
            at, size = to, min(2 * size, mixing.LAST_BLOCK)
        out.append(nats)
    return out


def test_lm_base_and_model_match_brute_force(docs, none, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_BITS", (8, 9, 10))  # contexts must fight for blocks
    monkeypatch.setattr(mixing, "KEPT_PAIRS", 2000)
    monkeypatch.setattr(mixing, "KEPT_WORDS", 50)
    monkeypatch.setattr(mixing, "PIECE", 300)
    monkeypatch.setattr(mixing, "BATCH", 700)
    monkeypatch.setattr(mixing, "FAN_IN", 2)
    rows = [(r[0], r[2]) for r in docs.collect()]
    training = [t for i, t in rows if not _held(i)]
    counts = Counter(w for t in training for w in _tokens(t))
    n, kinds = sum(counts.values()), len(counts)
    some = list(range(0, len(rows), 5)) + [i for i, (d, t) in enumerate(rows) if t in (None, "", "a" * 500)]
    slow = dict(zip(some, _slow_costs(training, [rows[i][1] for i in some])))
    for frequent in (mixing.FREQUENT, 7, 0):
        got = mixing.score(docs, frequent).collect()
        by = {}
        for r in got:
            by.setdefault((r.doc_id, r.n_bytes), []).append(r)
        assert len(got) == len(rows)
        for i, (doc, text) in enumerate(rows):
            tokens = _tokens(text)
            r = by[doc, len((text or "").encode()) + 1][0]
            base = sum(math.log10((counts[w] + 1) / (n + kinds + 1)) for w in tokens)
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (_held(doc), len(tokens), sum(counts[w] > 0 for w in tokens), n)
            assert math.isclose(r.base_score, base, rel_tol=1e-12)
            if i in slow:
                assert math.isclose(r.score, -slow[i] / math.log(10), rel_tol=1e-4), text
                assert math.isclose(r.bits_per_byte, slow[i] / math.log(2) / r.n_bytes, rel_tol=1e-4)
    assert mixing.score(none).collect() == []


def test_lm_weights_move_after_every_bit(monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_BITS", (8, 9, 10))
    for name, n in (("SIDE", 300), ("STRIP", 40), ("TURNS", 3)):
        monkeypatch.setattr(mixing, name, n, raising=False)
    rng = np.random.default_rng(5)
    tables = [np.concatenate([rng.integers(-90, 90, 16 << bits), np.zeros(16)]).astype(np.int8) for bits in mixing.BLOCK_BITS]
    for bits, table in zip(mixing.BLOCK_BITS, tables):  # one check for all, and any number of meetings
        table[: 16 << bits : 16] = 3 << 3 | rng.integers(0, 4, 1 << bits)
    monkeypatch.setattr(mixing, "CHECK_BITS", 2)
    texts = ["a", "", "some words, some more words and a word", "über 日本 " * 20, "x" * 90, "The END. " * 60]
    for text, (size, nats) in zip(texts, mixing.text_costs(texts, tables)):
        data = _lower(text).encode() + bytes([mixing.END])
        weights = np.array([[list(mixing.START[g]) for g in range(mixing.GATES)] for _ in range(4)])
        want = 0.0
        for i, b in enumerate(data):
            for known, half in _slow_steps(b):
                blocks, gate = [], 0
                for k in range(mixing.PREDICTORS):
                    key = np.array([_slow_key(data, i, k)], np.uint32)
                    at, check = mixing.places_of(key, np.array([known], np.uint32), mixing.BLOCK_BITS[k])
                    head = int(tables[k][int(at[0])]) & 255
                    gate = head & 7 if head >> 3 == check[0] else 0
                    blocks.append(tables[k][int(at[0]) :][:16] if gate else np.zeros(16, np.int8))
                for j in range(4):
                    x = np.array([float(block[1 << j | half >> (4 - j)]) for block in blocks]) / mixing.SCALE
                    p = 1 / (1 + math.exp(-float(weights[j, gate] @ x)))
                    bit = half >> (3 - j) & 1
                    want -= math.log(p if bit else 1 - p)
                    weights[j, gate] += mixing.RATE * (bit - p) * x  # before the next bit is guessed
        assert size == len(data) and math.isclose(nats, want, rel_tol=1e-4), text


def test_lm_without_training_rows_costs_a_bit_a_decision(spark):
    held = [i for i in range(100) if _held(i)][:3]
    rows = mixing.score(spark.createDataFrame([(i, "abc") for i in held], "doc_id long, text string")).collect()
    assert [(r.n_known, r.train_tokens, r.base_score, r.bits_per_byte) for r in rows] == [(0, 0, 0.0, pytest.approx(7.0))] * 3  # a takes one step, b, c and the end two


def test_lm_learns_what_held_out_texts_are_made_of(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.score(docs).collect()
    # printable letters alone would cost over four bits a byte
    for held in (True, False):
        part = [r for r in rows if r.held_out == held]
        assert -sum(r.score for r in part) * math.log2(10) / sum(r.n_bytes for r in part) < 2.6
    moved = mixing.score(docs.repartition(7)).collect()
    assert {r.doc_id: round(r.score, 2) for r in rows} == {r.doc_id: round(r.score, 2) for r in moved}


# ---- operator 12 ------------------------------------------------------------------------


def _terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", _lower(text))


def _slow_search(docs, items, best):
    found = [(d, _terms(t)) for d, t in docs]
    n_docs, n_all = sum(bool(w) for _, w in found), sum(len(w) for _, w in found)
    df = Counter(x for _, w in found for x in set(w))
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(_terms(t))
    out = []
    for i, terms in asked.items():
        scores = []
        for d, w in found:
            tf, m = Counter(w), 50 + 50 * len(w) * n_docs // n_all if w else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m)) for t in terms if tf[t])
            if s:
                scores.append((-s, d is None, d))
        out += [(i, k, d, -s) for k, (s, _, d) in enumerate(sorted(scores)[:best], 1)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_ranked_search(spark, docs, none, monkeypatch, small):
    if small:
        monkeypatch.setattr(ranked, "BLOCK_ITEMS", 3)
        monkeypatch.setattr(ranked, "DOCUMENTS", 4)
        monkeypatch.setattr(ranked, "PIECE", 40)
        monkeypatch.setattr(ranked, "MINED", 3)
    rng = random.Random(9)
    items = [(i, " ".join(rng.choices(WORDS, k=rng.randint(1, 30))), "no") for i in range(20)]
    items += [(30, None, ""), (31, "", ""), (32, "!? --", ""), (33, "never heard", ""), (None, "w1", ""), (3, "w9 X日本 w9", ""), (34, "É é W1", "")]
    frame = spark.createDataFrame(items, "item_id long, text string, Item_ID2 string")
    got = sorted(map(tuple, ranked.search(docs, frame, 12).collect()))
    assert got == _slow_search([(r[0], r[2]) for r in docs.collect()], [i[:2] for i in items], 12)
    assert ranked.search(none, frame).collect() == []
    assert ranked.search(docs, frame.limit(0)).collect() == []


def test_shared_graph_adds_up_to_the_items_and_shares():
    rng = random.Random(1)
    common = [rng.sample(range(200), 12) for _ in range(5)]
    items = [sorted({*rng.choice(common), *rng.choice(common), *rng.sample(range(200, 400), 3)}) for _ in range(40)] + [[], [7]]
    atoms, sums, uses = ranked.shared_graph(items)
    content = [list(a) for a in atoms]
    for a, b in sums:
        content.append(content[a] + content[b])
    assert [sorted(t for n in u for t in content[n]) for u in uses] == items
    assert len(sums) > 5 and sum(map(len, uses)) + len(sums) < sum(map(len, items)) / 2
    plan = ranked.Plan(items, 400)
    used = np.array(sorted(set().union(*items)))
    scores = list(plan.scores(np.zeros(len(used), int), used, used, 1))
    assert [int(s[0]) for s in scores] == [sum(i) for i in items]


# ---- operator 13 ------------------------------------------------------------------------


def _slow_clusters(rows, k=16, rounds=3):
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in good if i is not None)
    middle = [v for _, v in order[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((dist(v, c), j) for j, c in enumerate(middle))
    if not middle:
        return []
    for _ in range(rounds):
        held = {}
        for _, v in good:
            held.setdefault(near(v)[1], []).append(v)
        middle = [[sum(x) // len(x) for x in zip(*held[j])] if j in held else c for j, c in enumerate(middle)]
    placed = [(i, *near(v)) for i, v in good]
    of = Counter()
    for _, d, j in placed:
        of[j] += d
    digest = lambda j: hashlib.sha256(",".join(map(str, middle[j])).encode()).hexdigest()
    return sorted(((i, j, d, of[j], sum(of.values()), digest(j)) for i, d, j in placed), key=str)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_centroids(spark, kind):
    rng = random.Random(2)
    rows = [(i, [rng.gauss((i % 5) / 9, 0.2) for _ in range(64)]) for i in range(150)] + [(200 + i, [0.25] * 64) for i in range(60)]
    rows += [(i, [float(np.float32(x)) for x in v]) for i, v in rows[:10]] + [(None, [-0.5] * 64), (300, [100000.0] + [0.0] * 63)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    rows += [(400, None), (401, [0.1] * 63), (402, []), (403, [None] + [0.1] * 63), (404, [math.nan] + [0.1] * 63), (405, [math.inf] + [0.1] * 63)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], f"vec_id long, embedding array<{kind}>, cluster int, v string").repartition(5)
    assert sorted(map(tuple, centroids.clusters(frame).collect()), key=str) == _slow_clusters(rows)
    few = [r for r in rows if r[0] in (1, 2, 3)]
    got = centroids.clusters(spark.createDataFrame(few, f"vec_id long, embedding array<{kind}>")).collect()
    assert sorted(map(tuple, got), key=str) == _slow_clusters(few) and len({r.cluster for r in got}) <= 6
    assert centroids.clusters(frame.limit(0)).collect() == []
    assert centroids.clusters(frame.where("vec_id IS NULL")).collect() == []


def test_cells_bound_distances_and_spare_fetches():
    rng = np.random.default_rng(4)
    middle = rng.integers(-30, 30, (16, 64))
    v = (middle[rng.integers(0, 16, 3000)] + rng.integers(-6, 7, (3000, 64))).astype(np.int64)
    cells = centroids.Cells(v.mean(axis=0), v.std(axis=0), v.min(axis=0), v.max(axis=0))
    small = centroids.unpack(centroids.pack(cells.number(v)))
    low, high = cells.tables(middle)
    exact = ((v[:, None] - middle) ** 2).sum(axis=2)
    at = np.arange(64)
    assert (low[at, small].sum(axis=1) <= exact).all() and (high[at, small].sum(axis=1) >= exact).all()
    near, fetched = centroids.nearest(small, v, (low, high), middle)
    assert (near == exact.argmin(axis=1)).all() and fetched.mean() < 0.2


def test_centroids_refuse_what_does_not_fit(spark):
    frame = spark.createDataFrame([(1, [2.0**21] + [0.0] * 63)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="do not fit a long"):
        centroids.clusters(frame).collect()


@pytest.mark.parametrize("name", ["op12_ranked_search", "op13_centroids"])
def test_registered_query_matches_its_sql(spark, name):
    import __spark_entry__ as E
    from tests.oracle_compare import compare, duck

    sf = "/root/testdata/sf0.001"
    result = compare(spark, name, E.queries()[name], E.oracle_sql()[name], sf, duck(sf))
    assert result["ok"], result


def test_frequent_words_are_found_by_their_hashes_at_once():
    words = [b"", b"the", b"of", b"rare", b"\xc3\xa9"] + [b"w%d" % i for i in range(500)]
    hashed = mixing._signed([xxhash.xxh3_64_digest(w) for w in words])
    assert (hashed < 0).any() and hashed.view(np.uint64).tolist() == [xxhash.xxh3_64_intdigest(w) for w in words]
    kept = {int(h): n for n, h in enumerate(hashed[::3].tolist(), 1)}
    frequent, times = np.array(sorted(kept.items()), np.int64).T.copy()
    assert mixing._times(hashed, frequent, times).tolist() == [kept.get(h, -1) for h in hashed.tolist()]
    assert mixing._times(hashed, frequent[:0], times[:0]).tolist() == [-1] * len(words)
    assert mixing._times(hashed[:0], frequent, times).tolist() == []
