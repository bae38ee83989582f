"""Language-model scores by online logistic context mixing (operator 11).

A text is its bytes in UTF-8 with A-Z lower-cased, and one end byte. A byte is one to three steps of
four binary decisions each, by a fixed code that gives the most usual bytes one step. Three predictors guess every bit from a hashed context: the last three and four
bytes, and the word so far. A predictor's guess is the logarithm of the odds that the bit had after
that context, and after the bits already known of the byte, in all training texts. A mixer
adds up the guesses with one weight each, and the logistic function of the sum is the probability.
Weights are gated: every bit of a step has four sets, and how often training met the word so far
chooses among them. Along a text the weights are refined online: after every bit, those that took
part in its guess move along the gradient of its cost. They start the same for each text, so a
text's score depends on the training counts and on itself only.

1. Counting. Each task sorts the (context, symbol) pairs of its training texts and returns them with
   their counts, cut into segments of the context hash. A tree of grouped jobs merges them, and
   the last turns each segment into its part of the predictors' tables. Tables have a fixed size,
   at most ``2**21`` blocks of 16 bytes: 15 guesses, and a head with a check of the context and how
   often it was met. Of contexts that share a block, the one that training met most often holds
   it; to the others the check says that they were not met.
2. Words. The tokens of all training texts are counted, for the smoothed unigram base score; a word
   is its 64-bit hash there. The most frequent :data:`FREQUENT` words go to every task; others,
   each rare by that, meet their counts in a join.
3. Scoring. One pass over all texts. A bit's weights are those of its place in the step and of its
   gate, so a text is 16 chains of decisions that share no weight. The chains of many texts
   take their next decision at the same time, each after its own last move.

Weights, sums and probabilities are in single precision, the steps' costs are added in double.

Defined cases: a NULL or empty text is the end alone; a NULL ``doc_id`` is hashed as the empty
text (so it is training); every row is a document, also repeated ones; without any training row the
base score is 0 and every decision costs one bit; an empty table gives no rows. A word's context is
its last 24 bytes at most; texts of any length are read whole, in pieces that carry the
state on.
"""

from __future__ import annotations

import math
from collections import Counter
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.frames import documents_view, store

FOLDS, HELD = 7, 2
FREQUENT = 1 << 17
#: distinct words a task keeps before it hands them on
KEPT_WORDS = 400_000
#: (context, symbol) pairs a task keeps before it sorts them
KEPT_PAIRS = 4_000_000
FAN_IN = 32

PREDICTORS = 3
#: a gate opens from so many times that the word so far was met
MET = (1, 8, 64)
GATES = len(MET) + 1
#: weights at the start of a text, by gate: the oftener the word was met, the more its guess counts
START = ((0.4, 0.6, 0.25), (0.35, 0.55, 0.55), (0.2, 0.25, 0.7), (0.15, 0.3, 0.65))
RATE = 0.02
#: steps between two moves of a text's weights, at first and at most: every step is followed by one
FIRST_BLOCK = LAST_BLOCK = 1
PIECE = 1 << 16
BATCH = 1 << 15
#: bytes that are scored side by side, a strip of each text; of so many bytes of texts that a task holds for it
SIDE, STRIP = 1 << 17, 1 << 10
HELD_BYTES = 16 << 20
#: turns that are taken with the same number of chains
TURNS = 16

KEY_BITS = 24
SEGMENT_BITS = 6
CHECK_BITS = 5
#: a predictor's table has so many blocks: a head, and a guess for each state of half a byte
BLOCK_BITS = (18, 20, 21)
SCALE = 16
PRIOR = 0.4
END = 0xFF
#: bytes of context before the first of a piece
LEAD = 25

# ---- fixed code: bytes by how usual they are in texts, the rest in ascending order -----------
USUAL = b" eaoinrstlhdcumpgbfvy.,wk-\n'0123456789zjqx\"():;!?/\xc3\xa9\xa8\xa1\xb3\xad\xa4\xb6\xbc" + bytes([END])
#: symbols of one step, and of two
SHORT, MIDDLE = 12, 60
STEPS = 3

_U = np.uint32
_SYMBOL = np.empty(256, _U)
_SYMBOL[np.frombuffer(USUAL + bytes(sorted(set(range(256)) - set(USUAL))), np.uint8)] = np.arange(256)
_ALL = np.arange(256)
_LENGTH = 1 + (_ALL >= SHORT) + (_ALL >= MIDDLE)
#: by step and symbol: the half byte that is coded, and what is known of the symbol before it
_HALF = np.stack([np.where(_ALL < SHORT, _ALL, np.where(_ALL < MIDDLE, SHORT + ((_ALL - SHORT) >> 4), 15)),
                  np.where(_ALL < MIDDLE, (_ALL - SHORT) & 15, (_ALL - MIDDLE) >> 4), (_ALL - MIDDLE) & 15]).astype(_U)
_KNOWN = np.stack([np.zeros(256, _U), 1 + _HALF[0], 17 + _HALF[1]])
#: by half byte: 1 where a bit is set, else -1, and the node of each bit in a block
_TOWARDS = np.array([[2 * (half >> (3 - j) & 1) - 1 for j in range(4)] for half in range(16)], np.int8)
_NODES = np.array([[(1 << j) | (half >> (4 - j)) for j in range(4)] for half in range(16)], np.int64).view("V32").ravel()
_SPACE = np.zeros(256, bool)
_SPACE[[0, 9, 10, 11, 12, 13, 32]] = True
_MULTIPLY = np.random.default_rng(11).integers(0, 2**32, 8, dtype=np.uint64).astype(_U) | _U(1)
_POWER = 0x2545F491
_UP = np.cumprod(np.full(3 * PIECE, _POWER, _U), dtype=_U)
_DOWN = np.cumprod(np.full(3 * PIECE, pow(_POWER, -1, 1 << 32), _U), dtype=_U)


def context_keys(data: np.ndarray) -> list[np.ndarray]:
    """By predictor: the hashed context of every byte of ``data`` after the first LEAD ones."""
    d, n = data.astype(_U), len(data)
    one, two, three, four = (d[LEAD - k : n - k] for k in range(1, 5))
    # the word so far: a difference of running sums, scaled back to its start
    sums = np.cumsum((d + _U(1)) * _UP[:n], dtype=_U)
    before = np.arange(LEAD - 1, n - 1)
    gap = np.maximum.accumulate(np.where(_SPACE[data], np.arange(n), 0))[before]
    gap = np.maximum(gap, before - (LEAD - 1))
    word = (sums[before] - sums[gap]) * _DOWN[gap]
    three = one | two << _U(8) | three << _U(16)
    out = []
    for k, context in enumerate((three, three | four << _U(24), word)):
        h = (context ^ _U(k * 0x01000193 + 1)) * _MULTIPLY[k]
        h = (h ^ (h >> _U(15))) * _MULTIPLY[k + 1]
        out.append(h >> _U(32 - KEY_BITS))
    return out


def places_of(key: np.ndarray, known: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the block of a context and of what is known of the symbol begins, and its check."""
    h = (key * _U(37) + known + _U(1)) * _MULTIPLY[6]
    h = (h ^ (h >> _U(13))) * _MULTIPLY[7]
    inner = bits - SEGMENT_BITS
    block = (key >> _U(KEY_BITS - SEGMENT_BITS)) << _U(inner) | h >> _U(32 - inner)
    return block.astype(np.int64) << 4, ((h >> _U(32 - inner - CHECK_BITS)) & _U((1 << CHECK_BITS) - 1)).astype(np.uint8)


def nodes_of(half: np.ndarray) -> list[np.ndarray]:
    """For each of the four bits of a step, the state that the bits before it leave."""
    return [((1 << j) | (half >> _U(4 - j))).astype(np.int64) for j in range(4)]


def _pieces(text: str):
    """``(lead, bytes)`` of a text, each lead being the LEAD bytes before."""
    data = text.encode().lower() + bytes([END])  # bytes.lower() changes A-Z only
    for at in range(0, len(data), PIECE):
        yield data[max(0, at - LEAD) : at].rjust(LEAD, b"\0"), data[at : at + PIECE]


def _batches(texts):
    """Lists of ``(number of the text, lead, bytes)`` of about BATCH bytes, with one piece a text."""
    some, size = [], 0
    for number, text in enumerate(texts):
        for lead, data in _pieces(text):
            if size >= BATCH or some and some[-1][0] == number:
                yield some
                some, size = [], 0
            some.append((number, lead, data))
            size += LEAD + len(data)
    if some:
        yield some


def _joined(some) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a batch, and where those that count begin (after the first lead)."""
    data = np.frombuffer(b"".join(x for _, lead, part in some for x in (lead, part)), np.uint8)
    sizes = np.array([len(part) for _, _, part in some])
    return data, np.cumsum(sizes + LEAD) - sizes - LEAD


# ---- counting ---------------------------------------------------------------------------


def _reduced(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs (or the sum of its counts)."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    if counts is None:
        return keys[first], np.diff(first, append=len(keys)).astype(np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _count_contexts(batches):
    """Per task: for each predictor and segment, the sorted (context, symbol) pairs and their counts."""
    from pyspark import TaskContext

    held: list[list] = [[] for _ in range(PREDICTORS)]
    done = [(np.empty(0, _U), np.empty(0, np.int64))] * PREDICTORS
    fresh: list[list] = [[] for _ in range(PREDICTORS)]
    size = 0

    def settle(last: bool = False):
        """Sort what is held; merge it into what is done when there is as much of it, and at the end."""
        nonlocal size
        for k in range(PREDICTORS):
            fresh[k].append(_reduced(np.concatenate([*held[k], np.empty(0, _U)])))
            held[k].clear()
            if last or sum(len(keys) for keys, _ in fresh[k]) >= max(KEPT_PAIRS // 2, len(done[k][0])):
                parts = [done[k], *fresh[k]]
                done[k] = _reduced(np.concatenate([keys for keys, _ in parts]), np.concatenate([counts for _, counts in parts]))
                fresh[k].clear()
        size = 0

    for batch in batches:
        for some in _batches(batch.column(0).to_pylist()):
            data, first = _joined(some)
            real = np.zeros(len(data) - LEAD, bool)
            for start, (_, _, part) in zip(first.tolist(), some):
                real[start : start + len(part)] = True
            symbol = _SYMBOL[data[LEAD:][real]]
            for k, key in enumerate(context_keys(data)):
                held[k].append(key[real] << _U(8) | symbol)
            size += len(symbol)
            if size >= KEPT_PAIRS:
                settle()
    settle(True)
    if not len(done[0][0]):
        return
    task, shift = TaskContext.get().partitionId(), _U(8 + KEY_BITS - SEGMENT_BITS)
    for k, (keys, counts) in enumerate(done):
        cuts = np.searchsorted(keys >> shift, np.arange((1 << SEGMENT_BITS) + 1))
        for s, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            if b > a:
                yield _part(k, s, task, keys[a:b], counts[a:b])


PARTS = "predictor int, segment int, task long, keys binary, counts binary"


def _part(predictor: int, segment: int, task: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "predictor": pa.array([predictor], pa.int32()), "segment": pa.array([segment], pa.int32()), "task": pa.array([task], pa.int64()),
        "keys": pa.array([keys.astype("<u4").tobytes()], pa.binary()), "counts": pa.array([_narrow(counts)], pa.binary())})


def _narrow(counts: np.ndarray) -> bytes:
    """Counts in four bytes each, or in eight if one of them needs it; the first byte says which."""
    wide = bool(len(counts)) and int(counts.max()) >= 1 << 32
    return (b"\x08" if wide else b"\x04") + counts.astype("<u8" if wide else "<u4").tobytes()


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = [np.frombuffer(x.as_py(), "<u4") for x in table.column("keys")]
    counts = [np.frombuffer(x.as_py()[1:], f"<u{x.as_py()[0]}").astype(np.int64) for x in table.column("counts")]
    return _reduced(np.concatenate(keys), np.concatenate(counts))


def _merge(table: pa.Table) -> pa.Table:
    first = [table.column(c)[0].as_py() for c in ("predictor", "segment", "task")]
    return pa.Table.from_batches([_part(*first, *_merged(table))])


def guesses(keys: np.ndarray, counts: np.ndarray, segment: int, bits: int) -> np.ndarray:
    """A segment's part of its predictor's table, from sorted (context, symbol) pairs."""
    size = 16 << (bits - SEGMENT_BITS)
    steps = []
    for step in range(STEPS):
        took = _LENGTH[keys & _U(255)] > step
        symbol, context, n = keys[took] & _U(255), keys[took] >> _U(8), counts[took]
        known = _KNOWN[step][symbol]
        at, check = places_of(context, known, bits)
        # symbols that share what is known are neighbours in the code's order
        first = np.flatnonzero(np.concatenate([[True], (context[1:] != context[:-1]) | (known[1:] != known[:-1])])) if len(n) else np.empty(0, np.int64)
        steps.append((symbol, n, at - segment * size, check, first))
    met = np.concatenate([np.add.reduceat(n, first) if len(first) else n for _, n, _, _, first in steps])
    block = np.concatenate([at[first] for _, _, at, _, first in steps])
    check = np.concatenate([c[first] for _, _, _, c, first in steps])
    order = np.lexsort((np.arange(len(met)), -met, block))
    holds = np.zeros(len(met), bool)
    holds[order[np.flatnonzero(np.diff(block[order], prepend=-1))]] = True
    ones, zeros, before = np.zeros(size), np.zeros(size), 0
    for step, (symbol, n, at, _, first) in enumerate(steps):
        held = np.where(np.repeat(holds[before : before + len(first)], np.diff(first, append=len(n))), n, 0)
        before += len(first)
        half = _HALF[step][symbol]
        for j, node in enumerate(nodes_of(half)):
            bit = ((half >> _U(3 - j)) & _U(1)).astype(np.int64)
            ones += np.bincount(at + node, held * bit, size)
            zeros += np.bincount(at + node, held * (1 - bit), size)
    out = np.clip(np.rint(SCALE * np.log((ones + PRIOR) / (zeros + PRIOR))), -127, 127).astype(np.int8)
    out[block[holds]] = (check[holds] << 3 | np.searchsorted(MET, met[holds], side="right").astype(np.uint8)).view(np.int8)
    return out


def _finish(table: pa.Table) -> pa.Table:
    predictor, segment = (table.column(c)[0].as_py() for c in ("predictor", "segment"))
    return pa.table({"predictor": table.column("predictor")[:1], "segment": table.column("segment")[:1],
                     "guesses": pa.array([guesses(*_merged(table), segment, BLOCK_BITS[predictor]).tobytes()], pa.binary())})


def predictor_tables(texts: DataFrame) -> list[np.ndarray]:
    """The predictors' tables, learnt from the one text column of ``texts``; each ends with an empty block."""
    parts = store(texts.mapInArrow(_count_contexts, PARTS), "contexts")
    most = parts.agg(F.max("task").alias("m")).first().m
    while most is not None and most >= FAN_IN:
        parts = parts.withColumn("task", F.floor(F.col("task") / FAN_IN))
        parts = store(parts.groupBy("predictor", "segment", "task").applyInArrow(_merge, PARTS), "contexts")
        most //= FAN_IN
    done = parts.groupBy("predictor", "segment").applyInArrow(_finish, "predictor int, segment int, guesses binary")
    tables = [np.zeros(16 * ((1 << bits) + 1), np.int8) for bits in BLOCK_BITS]
    for r in store(done, "guesses").toLocalIterator():  # at most 192 rows, 54 MB in all
        size = 16 << (BLOCK_BITS[r.predictor] - SEGMENT_BITS)
        tables[r.predictor][r.segment * size : (r.segment + 1) * size] = np.frombuffer(r.guesses, np.int8)
    return tables


# ---- scoring ----------------------------------------------------------------------------


def _side_by_side(texts: list[str]):
    """Lists of ``(number of the text, lead, bytes)``, about SIDE bytes each, with one strip a text.

    Texts that have the most bytes left come first, so that long ones don't end alone.
    """
    coded = [text.encode().lower() + bytes([END]) for text in texts]
    left = [(-len(data), number) for number, data in enumerate(coded)]
    heapify(left)
    while left:
        some, size, rest = [], 0, []
        while left and size < SIDE:
            n, number = heappop(left)
            data, to = coded[number], min(-n, STRIP)
            at = len(data) + n
            some.append((number, data[max(0, at - LEAD) : at].rjust(LEAD, b"\0"), data[at : at + to]))
            size += LEAD + to
            if n + to:
                rest.append((n + to, number))
        yield some
        for one in rest:
            heappush(left, one)


class Mixers:
    """The state that goes along each text: gated weights and the cost so far."""

    def __init__(self, n: int):
        # weights are over, guesses times the root of the rate, so a weight moves by its guess times the error
        start = (np.array(START, np.float32).T / math.sqrt(RATE))[:, None, :, None]
        self.weights = np.tile(start.astype(np.float32), (1, n, 1, 4))  # by predictor, text, gate and bit
        self.nats = np.zeros(n)

    def add(self, texts: np.ndarray, ends: np.ndarray, x: np.ndarray, half: np.ndarray, gate: np.ndarray) -> None:
        """Code the next steps of some texts, the weights moving after every decision.

        ``x[PREDICTORS, n, 4]``: scaled guesses of the bits of half bytes ``half[n]``, ``gate[n]``. The
        steps of ``texts[i]`` end at ``ends[i]``, where those of the next one begin.
        """
        chains = len(texts) * GATES
        chain = np.repeat(np.arange(len(texts)) * GATES, np.diff(ends, prepend=0)) + gate
        steps = np.argsort(chain.astype(np.uint16) if chains <= 1 << 16 else chain, kind="stable")
        size = np.bincount(chain, minlength=chains)
        # the longest chains first: those that still go on are the first ones at any turn
        longest = np.argsort(-size, kind="stable")
        place = np.empty_like(longest)
        place[longest] = np.arange(chains)
        live = np.cumsum(np.bincount(size)[::-1])[::-1][1:]
        # in some turns after one another as many chains as in the first of them, with guesses of 0 after their end
        live = np.repeat(live[::TURNS], TURNS)[: len(live)]
        first = np.cumsum(live) - live
        # turn after turn, a predictor's guesses for all chains, then the next predictor's
        turn = np.arange(len(gate)) - np.repeat(np.cumsum(size) - size, size)
        nth, first, wide = np.repeat(place, size), np.take(first, turn), np.take(live, turn)
        guesses_ = np.zeros(PREDICTORS * int(live.sum()), np.int32)
        to, towards = PREDICTORS * first + nth, np.take(_TOWARDS.view(np.int32).ravel(), half).view(np.int8)
        for k in range(PREDICTORS):
            # positive where it tends to the bit that comes
            guesses_[to] = np.take((x[k].ravel() * towards).view(np.int32), steps)
            to += wide
        guesses_ = guesses_.view(np.int8).astype(np.float32)
        guesses_ *= np.float32(math.sqrt(RATE) / SCALE)
        weights = self.weights[:, texts].reshape(PREDICTORS, chains, 4)
        moved = weights[:, longest].reshape(PREDICTORS, -1)
        sums, powers = np.empty((2, len(guesses_) // PREDICTORS), np.float32)
        _mix(moved, guesses_, sums, powers, live * 4)
        weights[:, longest] = moved.reshape(PREDICTORS, chains, 4)
        self.weights[:, texts] = weights.reshape(PREDICTORS, len(texts), GATES, 4)
        # a step's cost from the product of its bits' inverse probabilities; powers near nothing are left to the sums
        with np.errstate(divide="ignore", over="ignore"):
            inverse = 1 / powers
        inverse += 1
        far = np.flatnonzero(sums < -20)
        inverse[far] = 1
        costs = np.log((inverse[::4] * inverse[1::4]) * (inverse[2::4] * inverse[3::4])).astype(float)
        if len(far):
            np.subtract.at(costs, far >> 2, sums[far])
        self.nats[texts] += np.bincount(np.repeat(np.arange(chains) // GATES, size), np.take(costs, first + nth), len(texts))


def _mix(weights: np.ndarray, guesses_: np.ndarray, sums: np.ndarray, powers: np.ndarray, live: np.ndarray) -> None:
    """Turn after turn: weigh and add the guesses of the ``live`` first chains, then move their weights by the error.

    ``powers`` are the exponentials of the ``sums``.
    """
    ones = np.ones(weights.shape[1], np.float32)
    multiply, add, divide, exp = np.multiply, np.add, np.divide, np.exp
    at = 0
    with np.errstate(over="ignore"):
        for turn in range(0, len(live), TURNS):
            m, turns = int(live[turn]), min(TURNS, len(live) - turn)
            own, one, error, move = weights[:, :m].copy(), ones[:m], np.empty(m, np.float32), np.empty((PREDICTORS, m), np.float32)
            one_by_one = list(move)
            to = at + turns * m
            # a row of each for a turn: they come one after the other without being cut out
            for x, z, power in zip(guesses_[PREDICTORS * at : PREDICTORS * to].reshape(turns, PREDICTORS, m),
                                   sums[at:to].reshape(turns, m), powers[at:to].reshape(turns, m)):
                multiply(own, x, move)
                add(one_by_one[0], one_by_one[1], z)
                for more in one_by_one[2:]:
                    add(z, more, z)
                # the error is the probability of the other bit
                exp(z, power)
                add(power, one, error)
                divide(x, error, move)
                add(own, move, own)
            at = to
            weights[:, :m] = own


def text_costs(texts: list[str], tables: list[np.ndarray]) -> list[tuple[int, float]]:
    """``(bytes, nats)`` of every text, its end included."""
    mixers, sizes = Mixers(len(texts)), [0] * len(texts)
    for some in _side_by_side(texts):
        data, first = _joined(some)
        real = np.concatenate([np.arange(s, s + len(part)) for s, (_, _, part) in zip(first.tolist(), some)])
        symbol = _SYMBOL[data[LEAD:][real]]
        length = _LENGTH[symbol]
        ends = np.cumsum(length)
        step = np.arange(ends[-1]) - np.repeat(ends - length, length)
        real, symbol = np.repeat(real, length), np.repeat(symbol, length)
        step *= 256
        step += symbol
        half, known = np.take(_HALF.ravel(), step, mode="clip"), np.take(_KNOWN.ravel(), step, mode="clip")
        nodes = np.take(_NODES, half).view(np.int64).reshape(-1, 4)
        nodes += 16 * np.arange(len(half))[:, None]
        x = np.empty((PREDICTORS, len(half), 4), np.int8)
        for k, key in enumerate(context_keys(data)):
            at, check = places_of(key[real], known, BLOCK_BITS[k])
            block = np.take(tables[k].view(np.complex128), at >> 4).view(np.int8)  # 16 bytes at a time
            head = block[::16].view(np.uint8)
            gate = np.where(head >> 3 == check, head & 7, 0)  # the last predictor's, the word's, stays
            np.take(block, nodes, out=x[k], mode="clip")
            x[k].view(np.int32)[:, 0] *= gate > 0
        for number, _, part in some:
            sizes[number] += len(part)
        pieces = np.cumsum([len(part) for _, _, part in some])
        mixers.add(np.array([number for number, _, _ in some]), ends[pieces - 1], x, half, gate)
    return list(zip(sizes, mixers.nats.tolist()))


def _words(text: str) -> list[bytes]:
    return text.encode().lower().split()  # bytes.split() cuts at the six white spaces of the contract


def _signed(hashes: list[bytes]) -> np.ndarray:
    """64-bit hashes, in eight bytes each, as longs."""
    return np.frombuffer(b"".join(hashes), ">i8").astype(np.int64)


def _times(words: np.ndarray, frequent: np.ndarray, times: np.ndarray) -> np.ndarray:
    """How often each word was met, where it is among the ``frequent`` ones (in order); else -1."""
    if not len(frequent):
        return np.full(len(words), -1)
    at = np.minimum(np.searchsorted(frequent, words), len(frequent) - 1)
    return np.where(frequent[at] == words, times[at], -1)


def _count_words(batches):
    """Per task: hashes of words and their counts; the empty word is the end."""
    seen: Counter = Counter()

    def handed():
        return pa.RecordBatch.from_arrays([pa.array(_signed(list(map(xxhash.xxh3_64_digest, seen)))), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            seen.update(_words(text))
            seen[b""] += 1
            if len(seen) >= KEPT_WORDS:
                yield handed()
                seen.clear()
    if seen:
        yield handed()


def _costed(batch: pa.RecordBatch, tables: list[np.ndarray]):
    """``(rows, their texts, their costs)``: 256 rows at a time, scored side by side with many more."""
    size = np.cumsum(pc.binary_length(batch.column(3)).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(batch):
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + HELD_BYTES, side="right")))
        texts = batch.column(3).slice(at, to - at).to_pylist()
        costs = text_costs(texts, tables)
        for i in range(0, len(texts), 256):
            some = slice(i, i + 256)
            yield batch.slice(at + i, len(texts[some])), texts[some], costs[some]
        at = to


SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_bytes long, found long, logs double, score double, rare array<struct<word: long, n: int>>"


def _score(model):
    def run(batches):
        tables, frequent, times = model.value
        for batch, texts, costs in ((b, t, c) for whole in batches for b, t, c in _costed(whole, tables)):
            tokens, kinds, hashes, counts = [], [], [], []
            for text in texts:
                words = _words(text)
                tokens.append(len(words) + 1)
                seen = Counter(words)
                seen[b""] = 1
                kinds.append(len(seen))
                hashes += map(xxhash.xxh3_64_digest, seen)
                counts += seen.values()
            words = _signed(hashes)
            known = _times(words, frequent, times)
            n, of = np.array(counts, np.int64), np.repeat(np.arange(len(texts)), kinds)
            there = known >= 0
            found = np.bincount(of[there], n[there], len(texts)).astype(np.int64)
            logs = np.bincount(of[there], n[there] * np.log10(known[there] + 1), len(texts)).astype(float)
            ends = np.concatenate([[0], np.cumsum(np.bincount(of[~there], minlength=len(texts)))])
            others = pa.StructArray.from_arrays([pa.array(words[~there]), pa.array(n[~there].astype(np.int32))], names=["word", "n"])
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:3], pa.array(tokens, pa.int64()), pa.array([size for size, _ in costs], pa.int64()), pa.array(found),
                pa.array(logs), pa.array([-nats / math.log(10) for _, nats in costs], pa.float64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), others)],
                names=["row", "doc_id", "held_out", "n_tokens", "n_bytes", "found", "logs", "score", "rare"])

    return run


def score(docs: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte``.

    ``frequent``: how many of the most frequent words go to every task; 0 joins all words.
    """
    spark = docs.sparkSession
    digest = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8"))
    view = documents_view(docs).select("doc_id", (F.pmod(digest, F.lit(FOLDS)) == HELD).alias("held_out"), "text")
    training = view.where(~F.col("held_out")).select("text")

    counts = store(training.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("kinds")).first()
    # at most FREQUENT pairs of numbers
    most = sorted((r.word, r.n) for r in counts.orderBy(F.desc("n"), "word").limit(frequent).collect())
    known, times = np.array(most, np.int64).reshape(-1, 2).T.copy()
    model = spark.sparkContext.broadcast((predictor_tables(training), known, times))  # 54 MB and FREQUENT pairs of numbers

    rows = view.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    scored = store(rows.mapInArrow(_score(model), SCORED), "scored")
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.word", F.col("r.n").alias("here"))
    # a word in this join is none of the most frequent, so no key is hot
    met = (rare.join(counts, "word").groupBy("row")
           .agg(F.sum("here").alias("more"), F.sum(F.col("here") * F.log10(F.col("n") + 1)).alias("more_logs")))
    space = math.log10(size.tokens + size.kinds + 1)
    return (scored.join(met, "row", "left")
            .select("doc_id", "held_out", "n_tokens", (F.col("found") + F.coalesce("more", F.lit(0))).alias("n_known"),
                    F.lit(size.tokens).cast("long").alias("train_tokens"),
                    (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(space)).alias("base_score"),
                    "score", "n_bytes", (-F.col("score") * F.lit(math.log2(10)) / F.col("n_bytes")).alias("bits_per_byte")))
