"""SentencePiece encoding and decoding on the tokenizers library (operator 6).

The model file is a protobuf message; a small reader takes the pieces with their scores and types,
the trainer's and the normaliser's settings from it, and rebuilds the same tokenizer: the
normaliser (its compiled character map, extra white space), the metaspace marker, a unigram model
from the scores or a BPE model whose merges are ordered by the scores, and byte fallback. Texts are
encoded in batches, on the library's own threads where the machine grants them, and decoded by the
rebuilt decoder.

Parity with the sentencepiece library is verified on all that is encoded; any difference fails the
task. Where texts may be cut at spaces (no piece of the model has a marker after another
character, so in both libraries nothing crosses the cut), every distinct word is compared when it
is encoded. Texts with a word that can't be compared alone (one without a space before it, or spaces
only), and all texts of models that don't allow the cut, are compared whole.

Defined cases: a NULL or empty text has no ids and decodes to the empty text; repeated rows each
get their own result; a NULL ``doc_id`` stays NULL. Decoding gives the normalised text back; with
a model that keeps white space this is the text itself.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer, decoders, models, normalizers

from sluice.llm.chunks import ChunkEncoder, worker_cache
from sluice.llm.frames import documents_view

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class PieceModel:
    """What of a model file matters for encoding."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    unk_id: int = 0
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True

    @property
    def inner_mark(self) -> bool:
        """Whether a piece has a marker after another character: then texts can't be cut at spaces."""
        return any(MARK in p.lstrip(MARK) for p, _, t in self.pieces if t in (NORMAL, USER))


def _fields(data: bytes):
    """``(field number, value)`` of a protobuf message: ints, or the bytes of everything else."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        wire = key & 7
        if wire == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(wire) or varint()
            yield key >> 3, data[at : at + size]
            at += size


def read_model(path: str) -> PieceModel:
    """Field numbers are those of the published ``sentencepiece_model.proto``."""
    model = PieceModel()
    with open(path, "rb") as f:
        data = f.read()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            model.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
        elif number == 2:
            spec = dict(_fields(value))
            model.kind, model.unk_id, model.byte_fallback = spec.get(3, UNIGRAM), spec.get(40, 0), bool(spec.get(35, 0))
        elif number == 3:
            spec = dict(_fields(value))
            model.charsmap, model.dummy_prefix, model.squeeze = spec.get(2, b""), bool(spec.get(3, 1)), bool(spec.get(4, 1))
    return model


def _merges(model: PieceModel) -> list[tuple[str, str]]:
    """Every way to make a piece of two others; a better score, then a lower id, goes first."""
    rank = {p: i for i, (p, _, t) in enumerate(model.pieces) if t in (NORMAL, USER)}
    order = sorted(rank, key=lambda p: (-model.pieces[rank[p]][1], rank[p]))
    out = []
    for p in order:
        cuts = [(p[:i], p[i:]) for i in range(1, len(p)) if p[:i] in rank and p[i:] in rank]
        out += sorted(cuts, key=lambda c: (rank[c[0]], rank[c[1]]))
    return out


def build_tokenizer(model: PieceModel) -> Tokenizer:
    """The tokenizer of a model, without the dummy prefix, which the encoder puts before a text."""
    unk = model.pieces[model.unk_id][0]
    if model.kind == BPE:
        vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        core = models.BPE(vocab, _merges(model), unk_token=unk, fuse_unk=True, byte_fallback=model.byte_fallback)
    elif model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unk_id, model.byte_fallback)
    else:
        raise ValueError(f"model type {model.kind} is neither unigram nor BPE")
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps.append(normalizers.Replace(Regex(" {2,}"), " "))
    tokenizer.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
    return tokenizer


class PieceEncoder:
    """Batch encoder and decoder of one model file."""

    def __init__(self, path: str):
        self.path, self.model, self.theirs = path, read_model(path), None
        self.tokenizer = build_tokenizer(self.model)
        self.chunks = None if self.model.inner_mark else ChunkEncoder(self.tokenizer, threads=True, check=self._check)

    @classmethod
    def of(cls, path: str) -> "PieceEncoder":
        loaded = worker_cache()
        if path not in loaded:
            loaded[path] = cls(path)
        return loaded[path]

    def library(self):
        """The sentencepiece library's processor of the same model."""
        import sentencepiece

        if self.theirs is None:
            self.theirs = sentencepiece.SentencePieceProcessor(model_file=self.path)
        return self.theirs

    def _check(self, pieces: list[str], ids: list[list[int]]) -> np.ndarray:
        """Compare words with the library's; which of them it can't take alone."""
        # with a dummy prefix the library puts the space before a word by itself
        lead = self.model.dummy_prefix
        odd = np.array([(not p.startswith(" ") or p[1:2] in ("", " ")) if p and lead else bool(p) and (self.model.squeeze or not lead and p.isspace()) for p in pieces])
        plain = [i for i, o in enumerate(odd.tolist()) if not o and pieces[i]]
        for i, want in zip(plain, self.library().encode([pieces[i][1:] if lead else pieces[i] for i in plain], num_threads=1), strict=True):
            if ids[i] != want:
                raise ValueError(f"ids differ from the sentencepiece library's for {pieces[i]!r}")
        return odd

    def _marked(self, texts: list[str]):
        """Yield ``(ids, compared already)`` of each text."""
        if self.model.squeeze:
            texts = [t.strip(" ") for t in texts]
        if self.model.dummy_prefix:
            texts = [" " + t if t else t for t in texts]
        if self.chunks:
            for ids, odd in self.chunks.marked(texts):
                yield ids, not odd
        else:
            for at in range(0, len(texts), 64):
                for e in self.tokenizer.encode_batch_fast(texts[at : at + 64], add_special_tokens=False):
                    yield np.array(e.ids, "<u4"), False

    def encode(self, texts: list[str]):
        """Yield the ids of each text."""
        for ids, _ in self._marked(texts):
            yield ids

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        texts = self.tokenizer.decode_batch([i.tolist() for i in ids], skip_special_tokens=False)
        return [t[1:] if self.model.dummy_prefix and t.startswith(" ") else t for t in texts]

    def verified(self, texts: list[str]):
        """Yield the ids of each text; raise if any differ from the sentencepiece library's."""
        for text, (ids, compared) in zip(texts, self._marked(texts), strict=True):
            if not compared and ids.tolist() != self.library().encode(text):
                raise ValueError(f"ids differ from the sentencepiece library's for a text of {len(text)} characters: {text[:80]!r}")
            yield ids


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids array<int>`` of every row."""

    def encode(batches):
        encoder = PieceEncoder.of(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids = [i.astype(np.int32) for i in encoder.verified(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return documents_view(docs).mapInArrow(encode, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` of rows with ``ids``."""

    def decode(batches):
        encoder = PieceEncoder.of(path)
        for batch in batches:
            texts = []
            for at in range(0, len(batch), 256):
                texts += encoder.decode([np.asarray(i.values) if i.is_valid else np.empty(0, np.int32) for i in batch.column(1).slice(at, 256)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")


def round_trip_digest(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_ids, n_bytes, ids_crc32, decoded_sha256``: both directions in one pass.

    ``n_bytes`` counts the ids that stand for single bytes (byte fallback).
    """
    import hashlib

    def run(batches):
        encoder = PieceEncoder.of(path)
        is_byte = np.array([t == BYTE for _, _, t in encoder.model.pieces])
        for batch in batches:
            found = encoder.verified(batch.column(1).to_pylist())
            for at in range(0, len(batch), 256):
                ids = list(islice(found, 256))
                back = encoder.decode(ids)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).slice(at, 256), "n_ids": pa.array([len(i) for i in ids], pa.int64()),
                    "n_bytes": pa.array([int(is_byte[i].sum()) for i in ids], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(i.astype("<u4").tobytes()) for i in ids], pa.int64()),
                    "decoded_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back], pa.string())})

    return documents_view(docs).mapInArrow(run, "doc_id long, n_ids long, n_bytes long, ids_crc32 long, decoded_sha256 string")
