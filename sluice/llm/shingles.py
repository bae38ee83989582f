"""Hashed word shingles and MinHash signatures, vectorised over whole Arrow batches of text.

Words are maximal runs of bytes other than space and TAB..CR, with A-Z lower-cased; UTF-8 keeps
every other character above those bytes, so words of bytes are words of characters. A word is
hashed as a sum of table values times position factors, a shingle as a keyed sum of five word
hashes, both through a 64-bit finaliser.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

WORDS = 5
SIGNATURE = 128
CHUNK = 1 << 20

_SEED = np.random.default_rng(20240229)
_BYTE = _SEED.integers(0, 2**64, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_PLACE = _SEED.integers(0, 2**64, WORDS, dtype=np.uint64) | np.uint64(1)
_SHORT = _SEED.integers(0, 2**64, WORDS, dtype=np.uint64)
_FACTOR = (_SEED.integers(0, 2**32, (SIGNATURE, 1), dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_POSITION = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)


def _positions(n: int) -> np.ndarray:
    global _POSITION
    if n > len(_POSITION):
        _POSITION = mix(np.arange(1, 2 * n + 1, dtype=np.uint64)) | np.uint64(1)
    return _POSITION


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``data`` (bytes), and for each the index of the text it is in.

    ``starts``: where each text begins in ``data``; the last one ends with it.
    """
    full = ~_SPACE[data]
    first = full.copy()
    first[1:] &= ~full[:-1]
    inside = starts[starts < len(data)]
    first[inside] = full[inside]
    begin = np.flatnonzero(first)
    if not len(begin):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    at = np.flatnonzero(full)
    word = np.cumsum(first[at]) - 1
    place = at - begin[word]
    values = _BYTE[data[at]] * _positions(int(place.max()) + 1)[place]
    hashes = mix(np.add.reduceat(values, np.flatnonzero(first[at])))
    return hashes, np.searchsorted(starts, begin, side="right") - 1


def _long_words(data: np.ndarray) -> np.ndarray:
    """Word hashes of one long text, piece by piece; pieces end at white space."""
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + CHUNK)
        while end < len(data) and not _SPACE[data[end]]:
            more = np.flatnonzero(_SPACE[data[end : end + CHUNK]])
            end = end + int(more[0]) if len(more) else min(len(data), end + CHUNK)
        out.append(word_hashes(data[at:end], np.zeros(1, np.int64))[0])
        at = end
    return np.concatenate(out)


def _shingles(words: np.ndarray, of: np.ndarray, n_texts: int) -> list[np.ndarray]:
    count = np.bincount(of, minlength=n_texts) if len(of) else np.zeros(n_texts, np.int64)
    ends = np.cumsum(count)
    if len(words) >= WORDS:
        sums = sum(words[k : len(words) - WORDS + 1 + k] * _PLACE[k] for k in range(WORDS))
        hashed = mix(sums)
    else:
        hashed = np.empty(0, np.uint64)
    out = []
    for end, n in zip(ends.tolist(), count.tolist()):
        if n >= WORDS:
            s = np.sort(hashed[end - n : end - WORDS + 1])
            keep = np.empty(len(s), bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        elif n:
            w = words[end - n : end]
            out.append(mix((w * _PLACE[:n]).sum(keepdims=True) + _SHORT[n]))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def shingle_sets(texts: pa.Array):
    """Yield the sorted distinct shingle hashes (uint64) of every text of an Arrow string array."""
    texts = texts.cast(pa.large_string()).cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK, side="right")) - 1)
        j = min(j, len(texts))
        part = data[offsets[i] : offsets[j]]
        if j == i + 1 and len(part) > CHUNK:
            words = _long_words(part)
            yield from _shingles(words, np.zeros(len(words), np.int64), 1)
        else:
            words, of = word_hashes(part, offsets[i:j] - offsets[i])
            yield from _shingles(words, of, j - i)
        i = j


def signature(s: np.ndarray) -> bytes:
    """128 MinHash values of a shingle set, 16 bits each (big-endian, so that bytes sort alike)."""
    high, low = (s >> np.uint64(32)).astype(np.uint32), s.astype(np.uint32)
    least = np.full(SIGNATURE, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(s), 2048):
        hashed = high[k : k + 2048] * _FACTOR
        hashed += low[k : k + 2048]
        np.minimum(least, hashed.min(axis=1), out=least)
    least = (least ^ (least >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    return ((least ^ (least >> np.uint32(13))) >> np.uint32(16)).astype(">u2").tobytes()


def set_key(s: np.ndarray) -> bytes:
    """128-bit fingerprint of a whole set: equal sets, and only those, have equal keys."""
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()
