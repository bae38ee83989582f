"""Operators on documents against brute force, on fixtures with every defined edge case."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sluice.llm import frames, line_dedup, minhash, packing, pieces, pii, quality, token_files
from sluice.llm.chunks import ChunkEncoder

SCHEMA = "doc_id long, Text string, text string, doc_ID string, lang string, n_chars long, c0 int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCAB = [f"w{i}" for i in range(400)]


def _texts():
    rng = random.Random(7)
    base = [rng.choice(VOCAB) for _ in range(120)]
    out = {1: " ".join(base), 2: " ".join(base), 3: " ".join(base).upper() + " \n"}
    near = list(base)
    near[60] = "changed"
    out[4] = "\t".join(near)
    out[5] = " ".join(near[:110])
    out[6], out[7], out[8], out[9] = None, "", " \n\t ", "one two"
    out[10], out[11] = "ONE  two", "café İstanbul one two"
    for i in range(12, 40):
        lines = [" ".join(rng.choice(VOCAB) for _ in range(rng.randint(1, 14))) for _ in range(rng.randint(1, 6))]
        out[i] = "\n".join([*lines, "  Licensed under THIS license  " if i % 3 else "short", lines[0]])
    out[40] = " ".join(["same phrase again and"] * 30)
    out[41] = "!!! ### *** " * 20
    out[42] = " ".join(rng.choice(VOCAB) for _ in range(9000))
    for i in range(43, 75):  # a star of near copies around document 43
        copy = list(base)
        for _ in range(i - 43):
            copy[rng.randrange(120)] = f"x{rng.randrange(9999)}"
        out[i] = " ".join(copy)
    return out


TEXTS = _texts()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, "other", t, "x", None, len(t or ""), None) for i, t in TEXTS.items()]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        return spark.createDataFrame(rows, SCHEMA)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, n_chars long")


def _shingles(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def _components(texts):
    sets = {i: _shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * len(sets[i] | sets[j]):
                    a, b = top(i), top(j)
                    root[max(a, b)] = min(a, b)
    return {i: (len(s), top(i), top(i) == i) for i, s in sets.items()}


def test_near_duplicates(docs):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert got == _components(TEXTS)


@pytest.mark.parametrize("rounds", [0, 1])
def test_near_duplicates_in_tiles(docs, monkeypatch, rounds):
    monkeypatch.setattr(minhash, "REGION", 3)
    monkeypatch.setattr(minhash, "ROUNDS", rounds)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert got == _components(TEXTS)


def test_scratch_of_other_runs_stays(spark, monkeypatch):
    monkeypatch.setattr(frames, "RUN", "other")
    other = frames.store(spark.range(3), "mine")
    monkeypatch.setattr(frames, "RUN", "this")
    this = frames.store(spark.range(4), "mine")
    frames.drop_scratch(spark)
    assert other.count() == 3
    with pytest.raises(Exception, match="FILE_NOT_EXIST|PATH_NOT_FOUND|does not exist"):
        this.count()


def test_near_duplicates_of_a_repeated_doc_id(spark):
    base = [f"w{i}" for i in range(60)]
    other = [f"v{i}" for i in range(60)]
    near = lambda words: " ".join([*words[:-1], "end"])
    rows = [(1, " ".join(base)), (2, near(base)), (2, " ".join(other)), (2, "x y z"), (9, near(other)), (7, "x y z"), (8, "p q r"), (8, "s t u")]
    got = sorted(map(tuple, minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == [(1, 56, 1, True), (2, 56, 1, False), (7, 1, 1, False), (8, 1, 8, True), (9, 56, 1, False)]


def test_near_duplicates_of_one_crowded_group(spark):
    words = [f"w{i}" for i in range(200)]
    texts = {i: " ".join([*words[: i % 190], f"x{i}", *words[i % 190 + 1 :]]) for i in range(400)}
    texts |= {1000 + i: " ".join(words[:40] + [f"y{i}z{k}" for k in range(60)]) for i in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs.repartition(5)).collect()}
    assert got == _components(texts)


def test_near_duplicates_edges(spark, none):
    assert minhash.near_duplicates(none).collect() == []
    rows = spark.createDataFrame([(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (7, "A b c d e f")], "doc_id long, text string")
    got = sorted(map(tuple, minhash.near_duplicates(rows).collect()), key=str)
    assert got == sorted([(None, 2, None, True), (5, 2, 5, True), (7, 2, 5, False)], key=str)
    kept = minhash.drop_near_duplicates(rows)
    assert sorted([r.doc_id for r in kept.collect()], key=str) == [5, 5, None]


PRIVATE = ("Mail a.b+c@ex-1.example.com, x@y.org@z.net or @no.de; ip 10.0.255.1 and 10.0.256.1 1.2.3.4.5.6.7.8 "
           "card 4111 1111 1111 1111 bad 4111 1111 1111 1112; +1 (555) 123-4567 +12 345; é\U0001f600 q@r.st "
           "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765433; ssn 123-45-6789, id 123-45-6780")


def _brute_base(text):
    found = [(m.start(), m.end(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append((*m.span(), 1))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d[::-1])) % 10 == 0:
            found.append((*m.span(), 2))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((*m.span(), 3))
    kinds = ("email", "ip", "card", "phone")
    return ",".join(f"{kinds[k]}:{s}:{e}" for s, e, k in sorted(found, key=lambda x: (x[0], x[2])))


def test_pii_base_spans_equal_plain_regular_expressions(spark, none):
    rng = random.Random(3)
    parts = [PRIVATE, "1.2.3.4", "@", "a@b.c", "4242 4242-4242 4242", "+49 (0) 89 1234567", " ", "\n", "9" * 30, "..", "x.y@", "-", "+", "255.255.255.255", "٣"]
    texts = [PRIVATE, "", None, "9" * 3000, "a" * 3000, "@" * 300] + ["".join(rng.choices(parts, k=6)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.span_digest(df).collect()}
    for i, t in enumerate(texts):
        base = _brute_base(t or "")
        assert got[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest(), t
        assert [x for x in got[i].spans.split(",") if x.split(":")[0] in pii.BASE_KINDS] == [x for x in base.split(",") if x]
        assert [got[i][f"n_{k}"] for k in pii.BASE_KINDS] == [base.count(k + ":") for k in pii.BASE_KINDS]
    extra = Counter(x.split(":")[0] for x in got[0].spans.split(","))
    assert extra["iban"] == 1 and extra["ssn"] == 2
    assert pii.span_digest(none).collect() == []


def test_pii_redaction(spark):
    df = spark.createDataFrame([(1, "to a@b.cd now", 13), (2, None, 5), (3, "clean 12", 8)], "doc_id long, text string, n_chars int")
    out = {r.doc_id: (r.text, r.n_chars) for r in pii.redact_documents(df).collect()}
    assert out == {1: ("to [EMAIL] now", 14), 2: (None, 5), 3: ("clean 12", 8)}


def test_pii_secrets_of_any_length(spark):
    rng = random.Random(11)
    run = lambda n: "a1B2" + "".join(rng.choices("ABCDEFGHIJKLMNOPabcdefghijklmnop0123456789", k=n - 4))
    secrets = [run(80), run(200), run(2000), ".".join([run(36), run(300), run(43)]), f"SG.{run(22)}.{run(43)}"]
    rows = [(i, f"the token: {s}. Next", None) for i, s in enumerate(secrets)] + [(9, f"token: {secrets[0]}.10.0.0.1", None)]
    out = {r.doc_id: r.text for r in pii.redact_documents(spark.createDataFrame(rows, "doc_id long, text string, n_chars int")).collect()}
    assert out == {**{i: "the token: [SECRET]. Next" for i in range(len(secrets))}, 9: "token: [SECRET].[IP]"}
    assert pii.find_spans("token: " + "-" * 200000 + " " + "a." * 100000) == []


def _measures(text):
    text = text or ""
    w = WORD.findall(text)
    wins = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n = Counter(wins)
    covered = {i + k for i, x in enumerate(wins) if n[x] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed


def test_quality(docs, none):
    got = {r.doc_id: r for r in quality.quality(docs).collect()}
    for i, t in TEXTS.items():
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == _measures(t)
    assert got[42].kept and not got[41].kept and not got[40].kept
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r[0] for r in kept.collect()} == {i for i, r in got.items() if r.kept}
    assert quality.quality(none).collect() == [] and quality.keep_good(none).collect() == []


def test_quality_order_does_not_change_the_verdict(docs):
    from sluice.llm.frames import documents_view

    frame, rules = quality.measured(documents_view(docs)), quality.extra_rules()
    names = list(rules)
    a = frame.select("doc_id", quality.verdict(frame, rules, names).isNull().alias("ok"))
    b = frame.select("doc_id", quality.verdict(frame, rules, names[::-1]).isNull().alias("ok"))
    assert sorted(a.collect()) == sorted(b.collect())


def test_quality_measures_only_what_the_cascade_reaches(docs):
    def plan(frame):
        return frame._jdf.queryExecution().optimizedPlan().toString()

    kept = plan(quality.keep_good(docs))
    # one filter over the text: no measure is a column of its own, each is written where its rule is
    assert "Generate" not in kept and "n_word_kinds" not in kept and kept.count("Filter") == 1
    measured = plan(quality.measured(frames.documents_view(docs)))
    assert "n_repeat_words" in measured and "n_word_kinds" not in measured and "n_text_lines" not in measured


def _brute_lines(texts):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})

    holder, docs_of = {}, {}
    for i in sorted(texts):
        for k in {key(x) for x in (texts[i] or "").split("\n")}:
            if len(k) >= 10:
                holder.setdefault(k, i)
                docs_of.setdefault(k, set()).add(i)
    out = {}
    for i, t in texts.items():
        lines = (t or "").split("\n")
        stay = [x for x in lines if not (len(docs_of.get(key(x), ())) > 1 and holder[key(x)] != i)]
        out[i] = (len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest())
    return out


@pytest.mark.parametrize("bits", [1 << 12, 1 << 16])
def test_line_dedup(docs, bits):
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.line_digest(docs.repartition(5), bits).collect()}
    assert got == _brute_lines(TEXTS)


def test_line_dedup_filters_are_sized_and_sliced(docs, monkeypatch):
    from sluice.llm.frames import documents_view

    view = documents_view(docs).where("doc_id IS NOT NULL")
    bits, slices = line_dedup._sized(view)
    assert slices == 1 and line_dedup.LEAST_BITS <= bits <= line_dedup.BITS
    exact = line_dedup.suspects(view, 1 << 22).count()
    monkeypatch.setattr(line_dedup, "BITS", 1 << 10)
    monkeypatch.setattr(line_dedup, "LEAST_BITS", 1 << 10)
    assert line_dedup._sized(view)[1] >= 2  # several slices, each of its own keys
    # few keys that don't repeat are suspects, and none that repeats is missed
    assert exact <= line_dedup.suspects(view).count() <= 1.5 * exact + 50
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.line_digest(docs.repartition(3)).collect()}
    assert got == _brute_lines(TEXTS)


def test_line_dedup_edges(spark, none):
    assert line_dedup.line_digest(none, 1 << 12).collect() == []
    line = "a line that many documents hold"
    df = spark.createDataFrame([(None, line, 31, 1), (2, line, 31, 2), (2, line, 31, 2), (3, line + "\nx", 33, 3), (4, None, None, 4)],
                               "doc_id long, text string, n_chars long, lost int")
    out = line_dedup.drop_repeated_lines(df, 1 << 12)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(None, line, 31, 1), (2, line, 31, 2), (2, line, 31, 2), (3, "x", 1, 3), (4, None, None, 4)], key=str)


def _ids(name, text, end):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return [*t.encode(text or "", add_special_tokens=False).ids, end]


ODD = ["a  b", "a   b ", " a\n\n b\t c", "\n", " ", "<|endoftext|> x <|endoftext|>", "it's  12,5  z", "é ́x", "\x1c a\x1cb", "café 你好 \U0001f600"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t) for i, t in TEXTS.items()] + [(100 + i, t) for i, t in enumerate(ODD)] + [(-5, "first"), (None, "no id")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_packing(odd, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack_documents(odd, path, capacity=4096).collect()
    texts = {r.doc_id: r.text for r in odd.collect()}
    assert {r.doc_id for r in rows} == set(texts)
    for doc, text in texts.items():
        want = _ids("word_bpe_49k.json", text, 1)
        mine = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.piece)
        assert [(r.start, r.length) for r in mine] == [(s, min(4096, len(want) - s)) for s in range(0, len(want), 4096)]
        assert [r.ids_crc32 for r in mine] == [zlib.crc32(np.array(want[r.start : r.start + r.length], "<u4").tobytes()) for r in mine]
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(by) == -(-sum(r.length for r in rows) // 4096)
    assert packing.pack_documents(none, path).collect() == []


@pytest.mark.parametrize("name, kind", [("word_bpe_49k.json", "plain"), ("byte_bpe_50k.json", "spaced")])
def test_words_are_encoded_without_the_mark_after_them(name, kind):
    encoder = ChunkEncoder(Tokenizer.from_file(public_tokenizers.path(name)), kind)
    base = ["alpha", "Beta", "gammaé", "x", "it's", "e\u0301", "don't", "z9", "(in", "<|endoftext|>", "日本", "ſ", "K"]
    texts = [f"{w}{m}{after}{v}" for w in base for m in (",", ".", ";", "!", "?", ":", "...", ").", ",,", "\u0301,") for v in base[:4]
             for after in (" ", "\n", "  ", "", " \u0301")] + [w + m for w in base for m in ",.;:!?"]
    texts += [" ".join(texts[:200]), "\0a, b, c. d! e", "a, b\0, c"] + list(TEXTS.values()) + [t or "" for t in ODD]
    texts = [t or "" for t in texts]
    assert [i.tolist() for i in encoder.encode(texts)] == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    # a word is known with any mark after it
    assert " alpha" in encoder.kept.number or "alpha" in encoder.kept.number
    n = len(encoder.kept.number)
    list(encoder.encode(["zeta eta theta"] if kind == "plain" else ["eta zeta eta theta"]))
    known = len(encoder.kept.number)
    assert known > n
    list(encoder.encode([f"eta{m} zeta{m} theta{m} eta" for m in ",.;:!?"]))
    assert len(encoder.kept.number) <= known + 7


def test_packing_ranks_over_salted_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED", 10)
    pieces_ = spark.createDataFrame([(i, 1 + i % 7) for i in range(200)], "doc_id long, length long")
    rows = packing.pack(pieces_, 16).collect()
    used = Counter()
    for r in rows:
        used.update((r.sequence_id, r.offset + k) for k in range(r.length))
    assert max(used.values()) == 1 and max(o for _, o in used) < 16 and len(rows) == 200


def test_minimum_bin_slack_finds_full_bins():
    patterns = packing.minimum_bin_slack({7: 3, 5: 2, 3: 3, 2: 4}, 10)
    used = Counter()
    for times, use in patterns:
        assert times > 0 and sum(n * c for n, c in use) <= 10
        for n, c in use:
            used[n] += times * c
    assert used == {7: 3, 5: 2, 3: 3, 2: 4} and sum(t for t, _ in patterns) == 5
    with pytest.raises(ValueError):
        packing.minimum_bin_slack({11: 1}, 10)


def test_token_files(odd, none, spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = {r.doc_id: r for r in token_files.token_digest(odd, path, end=2).collect()}
    start = 0
    for doc, text in sorted(((r.doc_id, r.text) for r in odd.collect()), key=lambda x: (x[0] is not None, x[0] or 0)):
        want = _ids("byte_bpe_50k.json", text, 2)
        assert (got[doc].start, got[doc].n_tokens, got[doc].ids_crc32) == (start, len(want), zlib.crc32(np.array(want, "<u4").tobytes())), text
        start += len(want)
    assert token_files.token_digest(none, path, end=2).collect() == []


def test_token_files_store_no_copy_of_the_ids(spark, outdir, monkeypatch):
    def stored(df, name):
        raise AssertionError(f"{name} is stored")

    monkeypatch.setattr(token_files, "store", stored)
    ids = [None, None, -(2**63) + 1, 2**63 - 1] + list(range(-40, 400)) + [7] * 50
    docs = spark.createDataFrame([(i, f"text {n}") for n, i in enumerate(ids)], "doc_id long, text string").repartition(3)
    token_files.write_tokens(docs, outdir + "/tokens", public_tokenizers.path("byte_bpe_50k.json"), 2, shard_ids=90)
    rows = token_files.read_tokens(spark, outdir + "/tokens").collect()
    by_place = sorted(rows, key=lambda r: (r.part, r.shard, r["first"]))
    order = lambda i: (i is not None, i or 0)
    assert [r.doc_id for r in by_place] == sorted(ids, key=order)
    assert len({r.part for r in rows if r.doc_id == 7}) == 1 and len({r.part for r in rows}) > 4
    per_part = Counter(r.part for r in rows)
    assert max(per_part.values()) < len(ids) / 3  # ranges of about equal size


@pytest.mark.parametrize("bits", [1, 7, 13, 16, 17, 32])
def test_shard_random_access(bits):
    rng = np.random.default_rng(bits)
    ids = [rng.integers(0, 2**bits, n, dtype=np.uint64).astype(np.uint32) for n in (0, 1, 9000, 4096, 5)]
    shard = token_files.Shard(token_files.shard_bytes([None, 3, 4, 5, 6], ids, bits, 2, 9) + b"\n")
    flat = np.concatenate(ids)
    assert (shard.part, shard.shard, shard.docs[0]) == (2, 9, token_files.NO_ID)
    for s, n in zip(shard.first.tolist(), shard.sizes.tolist()):
        assert (shard.ids(s, n) == flat[s : s + n]).all()
    assert (shard.ids(4090, 20) == flat[4090:4110]).all() and len(shard.payload) < bits * len(flat) / 8 + 16


def test_pieces(odd, none):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    theirs = sentencepiece.SentencePieceProcessor(model_file=path)
    encoded = pieces.encode_documents(odd, path)
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    ids = {r.doc_id: r.ids for r in encoded.collect()}
    assert ids == {i: theirs.encode(t) for i, t in texts.items()}
    assert {r.doc_id: r.text for r in pieces.decode_documents(encoded, path).collect()} == texts
    digest = {r.doc_id: r for r in pieces.round_trip_digest(odd, path).collect()}
    for i, t in texts.items():
        assert digest[i].n_ids == len(ids[i]) and digest[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert pieces.encode_documents(none, path).collect() == []


class _Wrong:
    """A tokenizer that loses the last id of texts that hold a mark."""

    def __init__(self, right, mark):
        self.right, self.mark = right, mark

    def encode_batch_fast(self, some, add_special_tokens):
        class Cut:
            def __init__(self, ids):
                self.ids = ids

        found = self.right.encode_batch_fast(some, add_special_tokens=add_special_tokens)
        return [Cut(e.ids[:-1] if self.mark in t else e.ids) for t, e in zip(some, found)]

    def get_vocab_size(self):
        return self.right.get_vocab_size()


@pytest.mark.parametrize("mark", ["word150", "long", "odd", "  two"])
def test_pieces_verify_all_that_is_encoded(mark):
    texts = [f"text word{i}" for i in range(200)] + ["a long text " * 1000, "odd", "  two spaces", " ", ""]
    encoder = pieces.PieceEncoder(public_tokenizers.path("piece_bpe_32k.model"))
    theirs = encoder.library()
    assert [i.tolist() for i in encoder.verified(texts)] == [theirs.encode(t) for t in texts]
    encoder.chunks = pieces.ChunkEncoder(_Wrong(encoder.tokenizer, mark), check=encoder._check)
    with pytest.raises(ValueError, match="ids differ"):
        list(encoder.verified(texts))


def _message(*fields):
    """A protobuf message of ``(number, value)``: ints, floats, bytes or text."""
    import struct

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    out = b""
    for number, value in fields:
        if isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        elif isinstance(value, int):
            out += varint(number << 3) + varint(value)
        else:
            value = value.encode() if isinstance(value, str) else value
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


@pytest.mark.parametrize("inner", [False, True])
@pytest.mark.parametrize("squeeze,dummy", [(0, 1), (1, 1), (0, 0), (1, 0)])
def test_pieces_of_a_unigram_model(spark, tmp_path, inner, squeeze, dummy):
    """A model file laid out by hand: scores, byte fallback, and a piece over a word's end or none."""
    # no two ways to cut a word have the same score
    words = {"▁": -3.017, "a": -4.033, "b": -4.171, "c": -4.259, "ab": -5.063, "bc": -5.219, "abc": -9.007, "▁a": -4.541, "▁ab": -6.089, "ca": -5.131, "▁bca": -7.523, "x": -6.311}
    words |= {"c▁a": -5.507} if inner else {}
    vocabulary = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *[(f"<0x{i:02X}>", 0.0, 6) for i in range(256)], *[(w, s, 1) for w, s in words.items()]]
    model = b"".join(_message((1, _message((1, p), (2, s), (3, t)))) for p, s, t in vocabulary)
    model += _message((2, _message((3, 1), (35, 1))), (3, _message((1, "identity"), (3, dummy), (4, squeeze), (5, 1))))
    path = tmp_path / "unigram.model"
    path.write_bytes(model)
    rng = random.Random(4)
    texts = ["", " ", "abc", "a  b", " abcab ", "zé abc", "   ", None] + ["".join(rng.choices("aabbcc  x", k=rng.randint(1, 30))) for _ in range(200)]
    theirs = pieces.PieceEncoder(str(path)).library()
    got = pieces.encode_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), str(path)).collect()
    assert {r.doc_id: r.ids for r in got} == {i: theirs.encode(t or "") for i, t in enumerate(texts)}


def test_encoder_with_little_room(monkeypatch):
    from sluice.llm import chunks

    texts = [t or "" for t in TEXTS.values()] + ODD
    for name, kind in (("byte_bpe_50k.json", "spaced"), ("word_bpe_49k.json", "plain")):
        path = public_tokenizers.path(name)
        want = [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts]
        for keep, chars, group in ((400_000, 1 << 24, 1 << 22), (5, 1 << 24, 50), (400_000, 20, 700), (0, 0, 1)):
            monkeypatch.setattr(chunks, "KEEP", keep)
            monkeypatch.setattr(chunks, "KEEP_CHARS", chars)
            monkeypatch.setattr(chunks, "GROUP", group)
            encoder = chunks.ChunkEncoder(Tokenizer.from_file(path), kind)
            for _ in range(2):
                assert [i.tolist() for i in encoder.encode(texts)] == want
            assert len(encoder.kept.number) <= keep and encoder.kept.chars <= chars
