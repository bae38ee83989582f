"""Fast exact encoding with the tokenizers library: distinct words once, whole texts by lookup.

A token never crosses the start of a space that follows other text, so a text may be cut there
and each piece encoded on its own. Where the tokenizer itself ends a word before a comma or the like, a
text is cut between an ASCII letter and such a mark before a space too: fewer pieces are distinct then. Arrow cuts the texts of a batch and numbers their distinct
pieces; only those are looked up or encoded, by ``encode_batch`` of the library, and a text's ids are
gathered from its pieces' ids. Ids of pieces are kept, up to a number and a size per Python worker;
pieces beyond that are encoded again in each batch that has them.
"""

from __future__ import annotations

import os
import re
import string
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tokenizers
from tokenizers import Tokenizer

#: what a worker keeps: so many pieces, of so many characters in all, none longer than this
KEEP = 300_000
KEEP_CHARS = 16 << 20
LONGEST = 256
#: characters of text that are cut at a time
GROUP = 6 << 20


def worker_cache() -> dict:
    """One dictionary per Python process.

    Task functions of this package are shipped by value, so their own globals are new in every task;
    the library's module is the same for all tasks of a worker.
    """
    return tokenizers.__dict__.setdefault("_sluice_encoders", {})


#: white space before a space: such texts are cut by the slower pattern
_RUN = re.compile(r"\s\x20")
_CUT = re.compile(r"(?<=\S)(?=\x20)")
#: a mark between an ASCII letter and a space
_MARKS = ",.;:!?"
_MARKED = rf"([A-Za-z])([{_MARKS}]) "


def _ends_words(tokenizer: Tokenizer) -> bool:
    """Whether the tokenizer cuts between any ASCII letter and any of the marks before a space."""
    if tokenizer.pre_tokenizer is None:
        return False
    cut = tokenizer.pre_tokenizer.pre_tokenize_str
    return all((1, 2) in [at for _, at in cut(f"{letter}{mark} a")] for letter in string.ascii_letters for mark in _MARKS)


class _Pieces:
    """Ids of pieces by number, in arrays that grow."""

    def __init__(self, width: np.dtype):
        self.number: dict[str, int] = {}
        self.chars = self.used = 0
        self.ends, self.odd, self.flat = np.zeros(1, np.int64), np.zeros(1, bool), np.empty(0, width)

    def add(self, pieces: list[str], sizes: np.ndarray, flat: np.ndarray, odd: np.ndarray) -> int:
        """Keep as many of the pieces as there is room for; how many."""
        n = chars = 0
        for p in pieces:
            if len(self.number) + n >= KEEP or self.chars + chars + len(p) > KEEP_CHARS or len(p) > LONGEST:
                break
            n, chars = n + 1, chars + len(p)
        if n:
            first, tokens = len(self.number), int(sizes[:n].sum())
            self.number.update(zip(pieces[:n], range(first, first + n)))
            self.chars += chars
            self.ends = _put(self.ends, first + 1, self.used + np.cumsum(sizes[:n]))
            self.odd = _put(self.odd, first, odd[:n])
            self.flat = _put(self.flat, self.used, flat[:tokens])
            self.used += tokens
        return n


def _put(grown: np.ndarray, at: int, new: np.ndarray) -> np.ndarray:
    if at + len(new) > len(grown):
        grown = np.concatenate([grown[:at], np.zeros(max(at, len(new)) + 1024, grown.dtype)])
    grown[at : at + len(new)] = new
    return grown


class ChunkEncoder:
    """``kind``: "spaced" if a space belongs to the word after it, "plain" if white space is dropped.

    ``check(pieces, ids)`` is called with all that is encoded; it raises, or returns for each piece
    whether it could not say (``odd``).
    """

    def __init__(self, tokenizer: Tokenizer, kind: str = "spaced", threads: bool = False, check=None):
        self.tokenizer, self.kind, self.threads, self.check = tokenizer, kind, threads, check
        self.width = np.dtype("<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.kept = _Pieces(self.width)
        # byte-level vocabularies write a space as this letter: an id that begins with it begins a word
        names = tokenizer.get_vocab() if not check else {}
        self.leads = None
        if kind == "spaced" and "Ġ" in names:
            self.leads = np.zeros(max(names.values()) + 1, bool)
            self.leads[[i for name, i in names.items() if name.startswith("Ġ")]] = True
        # others write the end of a word in its last id
        ends = [i for name, i in names.items() if name.endswith("</w>")] if kind == "plain" else []
        if ends:
            self.leads = np.zeros(max(names.values()) + 1, bool)
            self.leads[ends] = True
        self.marks = not check and (kind == "plain" or self.leads is not None) and _ends_words(tokenizer)

    @classmethod
    def of(cls, path: str, kind: str) -> "ChunkEncoder":
        """The worker's own encoder for a tokenizer file; it lives as long as the Python worker."""
        loaded = worker_cache()
        if (path, kind) not in loaded:
            loaded[path, kind] = cls(Tokenizer.from_file(path), kind)
        return loaded[path, kind]

    def _cut(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The pieces of all texts one after the other, and where each text's begin."""
        if self.kind == "plain":
            whole = pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " ")
            if self.marks:
                whole = pc.replace_substring_regex(whole, _MARKED, r"\1 \2 ")
            lists = pc.split_pattern(whole, " ")
            return lists.flatten(), lists.offsets.to_numpy()
        slow = [i for i, t in enumerate(texts) if "\0" in t or _RUN.search(t)]
        if slow:
            texts = list(texts)
            cut = {i: _CUT.split(texts[i]) for i in slow}
            for i in slow:
                texts[i] = ""
        # a mark before every space: the cut itself leaves the spaces where they are
        whole = pa.array(texts, pa.large_string())
        if self.marks:
            whole = pc.replace_substring_regex(whole, _MARKED, "\\1\0\\2 ")
        lists = pc.split_pattern(pc.replace_substring(whole, " ", "\0 "), "\0")
        if not slow:
            return lists.flatten(), lists.offsets.to_numpy()
        parts, sizes, at = [], np.diff(lists.offsets.to_numpy()), 0
        for i in slow:
            parts += [lists.slice(at, i - at).flatten(), pa.array(cut[i], pa.large_string())]
            sizes[i], at = len(cut[i]), i + 1
        parts.append(lists.slice(at).flatten())
        return pa.concat_arrays(parts), np.concatenate([[0], np.cumsum(sizes)])

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sizes, ids one after the other, and the odd ones of pieces that aren't kept."""
        if self.leads is not None and pieces and (found := self._together(pieces)):
            return found
        code, flat, sizes = "H" if self.width.itemsize == 2 else "I", [], []
        odd = np.zeros(len(pieces), bool)
        for a in range(0, len(pieces), 8192):
            some = pieces[a : a + 8192]
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            if self.check:
                odd[a : a + 8192] = self.check(some, ids)
            sizes += map(len, ids)
            flat.append(np.frombuffer(array(code, [x for i in ids for x in i]), self.width))
        return np.array(sizes, np.int64), np.concatenate([*flat, np.empty(0, self.width)]), odd

    def _together(self, pieces: list[str]):
        """As :meth:`_encoded`, many words to a call: they are cut again where a word begins, or ends.

        Only words of a space and no further white space are joined, since then the joined text may be
        cut where they meet; with ids that end words, words of ASCII letters. The number of cuts is checked.
        """
        ended = self.kind == "plain"
        if ended:
            plain = [p.isascii() and p.isalpha() for p in pieces]
        else:
            plain = [p[:1] == " " and len(p) > 1 and len(p.split()) == 1 and len(p.split()[0]) == len(p) - 1 for p in pieces]
        if not all(plain):
            one = [p for p, x in zip(pieces, plain) if x]
            if not one:
                return None
            (s1, f1, _), (s2, f2, _) = self._encoded(one), self._alone([p for p, x in zip(pieces, plain) if not x])
            # back into the order of the pieces
            plain = np.array(plain)
            sizes = np.empty(len(pieces), np.int64)
            sizes[plain], sizes[~plain] = s1, s2
            from_first = np.repeat(plain, sizes)
            flat = np.empty(int(sizes.sum()), self.width)
            flat[from_first], flat[~from_first] = f1, f2
            return sizes, flat, np.zeros(len(pieces), bool)
        flat, starts, at = [], [], 0
        joined = [(" " if ended else "").join(pieces[a : a + 512]) for a in range(0, len(pieces), 512)]
        for a in range(0, len(joined), 16):
            for e in self.tokenizer.encode_batch_fast(joined[a : a + 16], add_special_tokens=False):
                ids = np.array(e.ids, self.width)
                flat.append(ids)
                starts.append(np.flatnonzero(self.leads[ids]) + at + ended)
                at += len(ids)
        starts = np.concatenate(starts)
        if len(starts) != len(pieces):
            return self._alone(pieces)
        sizes = np.diff(starts, prepend=0) if ended else np.diff(starts, append=at)
        return sizes, np.concatenate(flat), np.zeros(len(pieces), bool)

    def _alone(self, pieces: list[str]):
        leads, self.leads = self.leads, None
        try:
            return self._encoded(pieces)
        finally:
            self.leads = leads

    def marked(self, texts: list[str]):
        """Yield ``(ids, odd)`` of each text: its ids, and whether one of its pieces is odd."""
        # one task is one core; the library's own threads would only spin beside Spark's
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if self.threads else "false"
        at = 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size + len(texts[to]) <= GROUP):
                size += len(texts[to])
                to += 1
            yield from self._group(texts[at:to])
            at = to

    def _group(self, texts: list[str]):
        # what the last group took is returned before the next one asks for as much
        pa.default_memory_pool().release_unused()
        kept = self.kept
        flat, offsets = self._cut(texts)
        numbered = flat.dictionary_encode()
        pieces, code = numbered.dictionary.to_pylist(), numbered.indices.to_numpy()
        number = np.fromiter((kept.number.get(p, -1) for p in pieces), np.int64, len(pieces))
        missing = np.flatnonzero(number < 0)
        new = [pieces[i] for i in missing.tolist()]
        sizes, ids, odd = self._encoded(new)
        n = kept.add(new, sizes, ids, odd)
        first = len(kept.number)
        number[missing] = np.concatenate([np.arange(first - n, first), first + np.arange(len(new) - n)])
        # what is kept, then what there was no room for
        ends = np.concatenate([kept.ends[: first + 1], kept.used + np.cumsum(sizes[n:])])
        source = np.concatenate([kept.flat[: kept.used], ids[sizes[:n].sum() :]]) if n < len(new) else kept.flat
        strange = np.concatenate([kept.odd[:first], odd[n:]])
        number = number[code]
        lists = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(source[: ends[-1]])).take(pa.array(number))
        out, tokens = lists.flatten().to_numpy(), lists.offsets.to_numpy()[offsets]
        strange = np.concatenate([[0], np.cumsum(strange[number])])[offsets] if strange.any() else np.zeros(len(offsets), np.int64)
        tokens = tokens - tokens[0]
        for i in range(len(texts)):
            yield out[tokens[i] : tokens[i + 1]], bool(strange[i + 1] > strange[i])

    def encode(self, texts: list[str]):
        """Yield the ids of each text as an unsigned numpy array."""
        for ids, _ in self.marked(texts):
            yield ids
