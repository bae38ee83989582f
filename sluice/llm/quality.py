"""Quality rules as a short-circuit cascade of native expressions (operator 8).

Rules are predicates over measures of the whole text, and measures are Spark SQL expressions that
are evaluated where a rule asks for them. :func:`keep_good` is one filter: a ``CASE`` over all
rules, base rules included, in which a measure is computed only for rows that every rule before let
pass. The order comes from a sample: rules are timed :data:`RUNS` times over rows picked by a hash
(at most :data:`SAMPLE`, from the first partitions that have them), the least time is the cost, the
share that a rule rejects its selectivity, and rules go by rejection per cost. The sample decides
the order, never the result.

:func:`quality` returns the base measures of every row, so these are computed for all rows; what
only the further rules need (kinds of words, lines of text, letters) is computed for rows that the
base rules and the rules before let pass.

Words are ``[^\\x20\\x09-\\x0D]+``. Defined cases: a NULL or empty text has no word and is rejected
as too short; repeated rows each get their own result; a NULL ``doc_id`` stays NULL.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.frames import numbered, position, documents_view

SAMPLE = 500
RUNS = 2
SPREAD = 4
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, and only where the result is asked for."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _long(value: Column) -> Column:
    return value.cast("long")


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: F.translate(line, SPACES, "") != "")


def _held(text: Column, letters: str) -> Column:
    """How many characters of ``text`` are among ``letters``."""
    return _long(F.char_length(text) - F.char_length(F.translate(text, letters, "")))


def _dup_lines(text: Column) -> Column:
    return _let(_lines(text), lambda lines: _long(F.size(lines) - F.size(F.array_distinct(lines))))


def _repeat_words(words: Column) -> Column:
    """Words covered by windows that occur twice or more.

    Repeated windows are found by sorting their hashes, so a text of ``n`` words costs ``n log n``;
    the sort runs only for texts in which a window does repeat.
    """
    window = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), window)

    def places(pairs: Column) -> Column:
        twice = lambda p, j: F.when((F.get(pairs, j - 1)["h"] == p["h"]) | (F.get(pairs, j + 1)["h"] == p["h"]), p["i"])
        return F.sort_array(F.filter(F.transform(pairs, twice), lambda x: x.isNotNull()))

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - p, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    def repeats(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), _let(pairs, lambda p: _let(places(p), covered))) \
            .otherwise(_long(F.lit(0)))

    return F.when(F.size(words) >= WINDOW, _let(windows, repeats)).otherwise(_long(F.lit(0)))


def _measures(text: Column, words: Column) -> dict[str, Column]:
    """The base measures as expressions of the text and its words."""
    return {
        "n_words": _long(F.size(words)),
        "word_chars": _long(F.char_length(F.translate(text, SPACES, ""))),
        "n_symbols": _held(text, SYMBOLS),
        "n_dup_lines": _dup_lines(text),
        "n_repeat_words": _repeat_words(words),
    }


def measured(view: DataFrame) -> DataFrame:
    """The view's columns plus the base measures of the whole text."""
    text = F.col("text")
    values = _let(_words(text), lambda words: F.struct(*[c.alias(n) for n, c in _measures(text, words).items()]))
    # Exploding one struct keeps the measures where they are: the optimiser would otherwise copy them
    # into every filter and rule that uses them.
    return view.select("*", F.explode(F.array(values)).alias("measure")) \
        .select(*view.columns, *[F.col(f"measure.{m}") for m in MEASURES])


def base_rules(m: dict[str, Column] | None = None) -> dict[str, Column]:
    """The two rules that always hold: too short, or too repetitive."""
    m = m or {name: F.col(name) for name in MEASURES}
    return {"few_words": m["n_words"] < 10, "repeats": 100 * m["n_repeat_words"] > 20 * m["n_words"]}


def extra_rules(m: dict[str, Column] | None = None, text: Column | None = None, words: Column | None = None) -> dict[str, Column]:
    """Rules for junk: markup debris, copied lines, odd word lengths, shouting, word salad.

    By default over a frame with ``text`` and the base measures.
    """
    m = m or {name: F.col(name) for name in MEASURES}
    text = F.col("text") if text is None else text
    words = _words(text) if words is None else words
    # the kinds of words grow about as the square root of a text's length, so long texts aren't poor
    kinds = _let(_long(F.size(F.array_distinct(words))), lambda kinds: kinds * kinds < 4 * m["n_words"])
    return {
        "symbols": 10 * m["n_symbols"] > m["n_words"],
        "dup_lines": _let(m["n_dup_lines"], lambda dup: (dup > 0) & (2 * dup > F.size(_lines(text)))),
        "word_length": _let(m["word_chars"], lambda chars: (chars < 2 * m["n_words"]) | (chars > 16 * m["n_words"])),
        "shouting": 5 * _held(text, "!") > m["n_words"],
        "no_letters": ~text.rlike(r"\p{L}"),
        "few_kinds": (m["n_words"] >= 50) & kinds,
    }


def _all_rules(text: Column, words: Column) -> dict[str, Column]:
    m = _measures(text, words)
    return {**base_rules(m), **extra_rules(m, text, words)}


def cascade_order(frame: DataFrame, rules: dict[str, Column], sample: int = SAMPLE) -> list[str]:
    """Rule names by rejection per cost on at most ``sample`` rows, one in :data:`SPREAD` by hash."""
    some = frame.where(F.pmod(F.xxhash64("text"), F.lit(SPREAD)) == 0)

    def run(column: Column) -> tuple[float, list]:
        seconds, picked = [], some.select(column).limit(sample)
        for _ in range(RUNS):
            t = time.perf_counter()
            rows = picked.collect()  # at most ``sample`` booleans
            seconds.append(time.perf_counter() - t)
        return min(seconds), rows

    idle, _ = run(F.lit(False).alias("hit"))
    score = {}
    for name, rule in rules.items():
        cost, rows = run(F.coalesce(rule, F.lit(False)).alias("hit"))
        rejected = (sum(r.hit for r in rows) + 0.5) / (len(rows) + 1)
        score[name] = rejected / max(cost - idle, 1e-3)
    return sorted(rules, key=lambda n: -score[n])


def verdict(frame: DataFrame, rules: dict[str, Column], order: list[str]) -> Column:
    """Name of the first rule, in cascade order, that rejects the row; NULL if none does."""
    case = F.lit(None).cast("string")
    for name in reversed(order):
        case = F.when(rules[name], F.lit(name)).otherwise(case)
    return case


def judged(view: DataFrame) -> DataFrame:
    """``measured`` plus ``base_failed`` and ``kept``: the base rules, then the others in measured order."""
    frame = measured(view)
    base, extra = base_rules(), extra_rules()
    order = cascade_order(frame, extra)
    failed = base["few_words"] | base["repeats"]
    rule = F.when(failed, F.lit("base")).otherwise(verdict(frame, extra, order))
    return frame.withColumn("base_failed", failed).withColumn("rule", rule).withColumn("kept", F.col("rule").isNull())


def quality(docs: DataFrame) -> DataFrame:
    """Measures and verdict of every row."""
    return judged(documents_view(docs)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass every rule, unchanged."""
    plain = numbered(docs)
    text = F.coalesce(F.col(f"c{position(docs, 'text')}").cast("string"), F.lit(""))
    view = plain.select(text.alias("text"))

    def alone(name: str) -> Column:
        return _let(_words(F.col("text")), lambda words: _all_rules(F.col("text"), words)[name])

    order = cascade_order(view, {name: alone(name) for name in _all_rules(F.col("text"), _words(F.col("text")))})
    rejected = _let(text, lambda text: _let(_words(text), lambda words: verdict(docs, _all_rules(text, words), order)))
    return plain.where(rejected.isNull()).toDF(*docs.columns)
