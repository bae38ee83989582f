"""Personal data and secrets: propose by pattern, confirm by checksum, weigh by context (operator 3).

Regular expressions propose spans. Validators confirm them: Luhn for payment cards, mod 97 for
IBANs, octet ranges, digit counts. Each kind starts with a score, a passed checksum raises it,
and words nearby that name the kind raise it as well; a span is kept from :data:`ACCEPT` on.

The four base kinds (email, ip, card, phone) are certain once valid and don't depend on context.
The others must not overlap a span of an earlier kind. Secrets have no greatest length and may have
inner dots (JWT and the like). Offsets are code points, ends exclusive.

Defined cases: a NULL or empty text has no span. Long runs cost linear time: patterns are anchored
at the start of a run and possessive, and an e-mail address grows from its ``@`` outwards.
Repeated rows each get their own result; a NULL ``doc_id`` stays NULL.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.frames import numbered, position, documents_view

BASE_KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.6
CONTEXT = 48

Span = tuple[int, int]

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    """Luhn's check: from the right, every second digit doubled, the digit sum a multiple of ten."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 7064 check of an IBAN without spaces: the rearranged number leaves 1 modulo 97."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def emails(text: str) -> list[Span]:
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
        # nothing before this @ can belong to a later address's local part
        floor = m.end() if m else at + 1
        at = text.find("@", floor)
    return out


def addresses(text: str) -> list[Span]:
    return [m.span() for m in _IP.finditer(text)
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split(".")))]


def cards(text: str) -> list[Span]:
    out = []
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(m.span())
    return out


def phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 10 <= sum(map(str.isdecimal, m[0])) <= 15]


@dataclass(frozen=True)
class Kind:
    """A kind beyond the base ones: pattern, validator, starting score, and words that raise it."""

    name: str
    pattern: str
    valid: Callable[[str], bool]
    score: float
    words: str
    raised: float = 0.4


def _iban(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and mod97(s)


def _ssn(s: str) -> bool:
    area, group, serial = s.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def _secret(s: str) -> bool:
    return len(s) >= 12 and any(c.isdigit() for c in s) and any(c.isalpha() for c in s) and len(set(s)) >= 8


EXTRA_KINDS = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])", _iban, 0.7,
         r"iban|konto|account|cuenta|compte|bank"),
    Kind("ssn", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])", _ssn, 0.4,
         r"ssn|social security|tax id|taxpayer"),
    Kind("national", r"(?<![0-9+.-])\(?0[0-9]{2,4}\)?[\x20/-][0-9]{3,4}(?:[\x20-]?[0-9]{2,4}){1,2}(?![0-9])",
         lambda s: 9 <= sum(map(str.isdecimal, s)) <= 12, 0.3, r"tel|phone|call|fax|mobile|handy|telefon|tél|móvil"),
    Kind("key", r"(?<![A-Z0-9])AKIA[A-Z0-9]{16}(?![A-Z0-9])", _secret, 0.9, r"key|aws"),
    Kind("secret", r"(?<![A-Za-z0-9])(?=[A-Za-z0-9_/+=.-]{12})[A-Za-z0-9_/+=-]++(?:\.[A-Za-z0-9_/+=-]++)*+", _secret, 0.3,
         r"(?:password|passwd|pwd|token|secret|api[_ -]?key)[\x22']?\s*[:=]\s*[\x22']?$", 0.5),
)
KINDS = (*BASE_KINDS, *(k.name for k in EXTRA_KINDS))
_COMPILED = [(k, re.compile(k.pattern), re.compile(k.words, re.I)) for k in EXTRA_KINDS]


def _groups(text: str, start: int, end: int):
    """The proposed end, then every earlier space in it: a number may run into a capital word."""
    yield end
    while (end := text.rfind(" ", start, end)) > 0:
        yield end


def find_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of every accepted span, by start and then in the order of KINDS."""
    if not text or not ("@" in text or _DIGIT.search(text)):
        return []
    found = [(*s, k) for k, spans in zip(BASE_KINDS, (emails(text), addresses(text), cards(text), phones(text))) for s in spans]
    taken = sorted((s, e) for s, e, _ in found)
    for kind, pattern, words in _COMPILED:
        fresh = []
        for m in pattern.finditer(text):
            start = m.start()
            for end in _groups(text, start, m.end()) if kind.name == "iban" else (m.end(),):
                if kind.valid(text[start:end]):
                    break
            else:
                continue
            near = text[max(0, start - CONTEXT) : start] if words.pattern.endswith("$") else text[max(0, start - CONTEXT) : end + CONTEXT]
            if kind.score + kind.raised * bool(words.search(near)) < ACCEPT:
                continue
            if kind.name == "secret" and (cut := min((s for s, e in taken if start < s < end), default=0)):
                # a dotted secret that runs into an earlier kind's span ends at the dot before it
                end = max(start, text.rfind(".", start, cut))
                if end - start < 12 or not kind.valid(text[start:end]):
                    continue
            if not any(s < end and start < e for s, e in taken):
                fresh.append((start, end))
        taken += fresh
        found += [(s, e, kind.name) for s, e in fresh]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType())]))


def _detect(batches):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        spans = [[{"kind": k, "start": s, "end": e} for s, e, k in find_spans(t)] for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])


def detect(docs: DataFrame) -> DataFrame:
    """``doc_id, spans array<struct<kind, start, end>>`` for every row; see the module."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("spans", SPANS)])
    return documents_view(docs).mapInArrow(_detect, schema)


def joined(spans: F.Column) -> F.Column:
    """``kind:start:end`` of every span, comma-joined in the order of the array."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.concat_ws(",", F.transform(spans, one))


def span_digest(docs: DataFrame) -> DataFrame:
    """Counts and digests of the base kinds and the text of all spans, per row."""
    found = detect(docs)
    of = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *[of(k) for k in BASE_KINDS],
                        F.sha2(F.encode(joined(base), "UTF-8"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redact_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with every span in ``text`` replaced; ``n_chars`` follows the text.

    A NULL text stays NULL, and a text without spans stays as it is.
    """
    plain, names = numbered(docs), docs.columns
    text, count = position(docs, "text"), (position(docs, "n_chars") if "n_chars" in names else None)

    def clean(batches):
        for batch in batches:
            texts = [t if t is None else redact(t, find_spans(t)) for t in batch.column(text).to_pylist()]
            columns = list(batch.columns)
            columns[text] = pa.array(texts, batch.schema.field(text).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    out = plain.mapInArrow(clean, plain.schema)
    if count is not None:
        kind = plain.schema[count].dataType
        new = F.when(F.col(f"c{text}").isNull(), F.col(f"c{count}")).otherwise(F.char_length(f"c{text}").cast(kind))
        out = out.withColumn(f"c{count}", new)
    return out.toDF(*names)


def digest(spans: list[tuple[int, int, str]]) -> str:
    """The base digest of one text, for tests."""
    base = ",".join(f"{k}:{s}:{e}" for s, e, k in spans if k in BASE_KINDS)
    return hashlib.sha256(base.encode()).hexdigest()
