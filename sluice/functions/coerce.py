"""Column coercions applied at the edges: numeric rounding, typed sink values, NULL tokens.

All of these are built-in Spark expressions (no UDF), so they stay inside whole-stage
codegen and work unchanged on streaming frames.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.charsets import plain_name

# ---- fixed values (must equal the reference's rules) --------------------------------
ROUNDING_MODES = ("ceiling", "down", "floor", "halfdown", "halfeven", "halfup", "unnecessary", "up")
DEFAULT_ROUNDING = "up"
DEFAULT_SCALE = 2
NULL_TOKEN = "\\N"
NULL_TOKEN_ESCAPED = "\\\\N"
CONTROL_CHARS = "\u0001\u0002"
DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
# -------------------------------------------------------------------------------------


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_decimal(c: Column | str, scale: int = DEFAULT_SCALE, mode: str = DEFAULT_ROUNDING) -> Column:
    """Round a decimal to ``scale`` digits with one of the eight BigDecimal modes.

    The input should be a decimal (cast first): rounding doubles is not exact.
    """
    x = _c(c)
    m = (mode or DEFAULT_ROUNDING).lower()
    if m not in ROUNDING_MODES:
        raise ValueError(f"unknown rounding mode {mode!r}; one of {ROUNDING_MODES}")
    neg = x < 0
    if m == "halfup":
        r = F.round(x, scale)
    elif m == "halfeven":
        r = F.bround(x, scale)
    elif m == "ceiling":
        r = F.ceil(x, scale)
    elif m == "floor":
        r = F.floor(x, scale)
    elif m == "up":  # away from zero
        r = F.when(neg, F.floor(x, scale)).otherwise(F.ceil(x, scale))
    elif m == "down":  # toward zero
        r = F.when(neg, F.ceil(x, scale)).otherwise(F.floor(x, scale))
    elif m == "halfdown":
        # ties go toward zero: ceil(|x| - half a unit) on the exact decimal, sign restored
        half = F.lit(Decimal(5).scaleb(-(scale + 1)))
        mag = F.ceil(F.abs(x) - half, scale)
        r = F.when(neg, -mag).otherwise(mag)
    else:  # unnecessary: rounding must not change the value
        r = F.when(F.round(x, scale) == x, F.round(x, scale)).otherwise(
            F.raise_error(F.concat(F.lit("rounding necessary for "), x.cast("string"))))
    return r


def normalize_numeric(df: DataFrame, cols: Sequence[str], scale: int = DEFAULT_SCALE,
                      mode: str = DEFAULT_ROUNDING, precision: int = 38) -> DataFrame:
    """S10a over columns: round each to ``scale`` and fix the type to decimal(precision, scale).

    A negative ``scale`` keeps the value and renders it as a plain string.
    """
    out = {}
    for c in cols:
        if scale < 0:
            out[c] = F.col(c).cast("string")
        else:
            kind = df.schema[c].dataType
            # a decimal keeps all its digits, or directed modes would round twice
            own = kind.scale if isinstance(kind, T.DecimalType) else 18
            out[c] = round_decimal(F.col(c).cast(f"decimal(38,{max(scale, own)})"), scale, mode) \
                .cast(f"decimal({precision},{scale})")
    return df.withColumns(out)


def render_date(c: Column | str) -> Column:
    """DATE / TIME / TIMESTAMP printed as ``yyyy-MM-dd``."""
    return F.date_format(_c(c), DATE_FORMAT)


def reencode(c: Column | str, from_charset: str, to_charset: str = "UTF-8") -> Column:
    """Reinterpret a string's bytes from one charset as another.

    What a charset cannot say becomes a question mark, malformed bytes U+FFFD. Charsets that Spark
    itself knows stay in the JVM; others go through Arrow batches, so no session setting is needed.
    """
    names = [plain_name(from_charset), plain_name(to_charset)]
    if names[0] in ("utf-8", "utf-16le", "utf-16be", "utf-32") and names[1] in ("iso-8859-1", "utf-8"):
        back = F.encode(_c(c), from_charset)
        return F.make_valid_utf8(back.cast("string")) if names[1] == "utf-8" else F.decode(back, to_charset)

    @F.pandas_udf("string")
    def through_bytes(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t.encode(from_charset, "replace").decode(to_charset, "replace"), na_action="ignore")

    return through_bytes(_c(c))


def scrub_controls(c: Column | str, chars: str = CONTROL_CHARS) -> Column:
    """Delete the framing control characters ``\\001`` and ``\\002`` inside a field."""
    return F.translate(_c(c), chars, "")


def encode_null(c: Column | str, token: str = NULL_TOKEN) -> Column:
    """E12 sink side: NULL or empty field -> ``\\N`` (token)."""
    x = _c(c).cast("string")
    return F.when(x.isNull() | (x == F.lit("")), F.lit(token)).otherwise(x)


def decode_null(c: Column | str, token: str = "NULL") -> Column:
    """E12 source side: a whole-field ``NULL`` token -> empty string."""
    x = _c(c)
    return F.when(x == F.lit(token), F.lit("")).otherwise(x)


def null_token_to_null(c: Column | str, token: str = NULL_TOKEN) -> Column:
    """``\\N`` -> real NULL (reading a table text file back)."""
    return F.nullif(_c(c), F.lit(token))


def decode_line_nulls(c: Column | str, field_delim: str = "\t", token: str = "NULL") -> Column:
    """E12 on a whole text line: a field that is exactly ``NULL`` becomes empty.

    The statement source's rule, for lines that are not split yet; the delimiter is
    literal (any delimiter, not only tab).
    """
    from sluice.functions.delimiters import literal_regex, unescape_delim

    d = literal_regex(unescape_delim(field_delim))
    return F.regexp_replace(_c(c), f"(?<=^|{d}){literal_regex(token)}(?={d}|$)", "")


def encode_line_nulls(c: Column | str, field_delim: str = "\t", token: str = NULL_TOKEN) -> Column:
    """E12 on a whole text line: every empty field becomes ``\\N`` (table / bulk-load sinks)."""
    from sluice.functions.delimiters import literal_regex, unescape_delim

    d = literal_regex(unescape_delim(field_delim))
    return F.regexp_replace(_c(c), f"(?<=^|{d})(?={d}|$)", token.replace("\\", "\\\\"))


def encode_nulls(df: DataFrame, cols: Sequence[str] | None = None, token: str = NULL_TOKEN) -> DataFrame:
    return df.withColumns({c: encode_null(c, token) for c in (cols or df.columns)})


def decode_nulls(df: DataFrame, cols: Sequence[str] | None = None, token: str = "NULL") -> DataFrame:
    return df.withColumns({c: decode_null(c, token) for c in (cols or df.columns)})


# ---- typed sink values (E9 lenient, E10 strict) --------------------------------------

def _strip_tokens(x: Column) -> Column:
    # the reference removes quotes and both spellings of the NULL token from text values
    return F.replace(F.replace(F.replace(x, F.lit("'"), F.lit("")), F.lit(NULL_TOKEN_ESCAPED), F.lit("")),
                     F.lit(NULL_TOKEN), F.lit(""))


def coerce_value(c: Column | str, typ: str) -> Column:
    """One text field -> the typed value a SQL sink receives.

    * ``string`` (and unknown types): quotes and ``\\N`` removed;
    * ``int``: blank (after removal) -> 0; quotes and ``\\N`` become ``0``; otherwise the
      integer value, NULL when it does not parse;
    * ``date`` ``yyyy-MM-dd`` / ``timestamp`` ``yyyy-MM-dd HH:mm:ss``, NULL when invalid.
    """
    x = _c(c).cast("string")
    t = typ.strip().lower()
    cleaned = _strip_tokens(x)
    if t == "int":
        as_int = F.replace(F.replace(F.replace(x, F.lit("'"), F.lit("0")), F.lit(NULL_TOKEN_ESCAPED), F.lit("0")),
                           F.lit(NULL_TOKEN), F.lit("0"))
        blank = F.replace(cleaned, F.lit(" "), F.lit("")) == F.lit("")
        return F.when(blank, F.lit(0).cast("bigint")).otherwise(as_int.try_cast("bigint"))
    if t == "date":
        return F.try_to_timestamp(cleaned, F.lit(DATE_FORMAT)).cast("date")
    if t == "timestamp":
        return F.try_to_timestamp(cleaned, F.lit(TIMESTAMP_FORMAT))
    return cleaned


def coerce_fields(df: DataFrame, types: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """E9 over a frame: types by position (list, first ``min(len)`` columns) or by name."""
    if isinstance(types, Mapping):
        pairs = list(types.items())
    else:
        pairs = list(zip(df.columns, types))
    return df.withColumns({name: coerce_value(name, t) for name, t in pairs})


_STRICT = {"int": "int", "long": "bigint", "bigint": "bigint", "double": "double", "decimal": "double",
           "string": "string"}


def cast_strict(df: DataFrame, types: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Typed document fields; a value that does not parse fails the job (ANSI cast)."""
    if isinstance(types, Mapping):
        pairs = list(types.items())
    else:
        pairs = list(zip(df.columns, types))
    out = {}
    for name, t in pairs:
        target = _STRICT.get(t.strip().lower())
        if target is None:
            raise ValueError(f"unsupported document type {t!r}")
        x = F.col(name)
        if target == "string":
            out[name] = x.cast("string")
        else:
            bad = x.isNotNull() & x.cast("string").try_cast(target).isNull()
            out[name] = F.when(bad, F.raise_error(F.concat(F.lit(f"cannot convert to {t}: "), x.cast("string")))) \
                .otherwise(x.cast("string").try_cast(target))
    return df.withColumns(out)
