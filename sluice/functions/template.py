"""Template expressions: ``${time:..}``, ``${range:..}``, ``${enum:..}`` and their product.

Grammar: literal text and ``${name:arg,arg}``. The first ``:`` splits the function name
from its comma-separated, trimmed arguments; a ``$`` right after a backslash is literal
text (the backslash stays); an unterminated ``${`` is an error.

Two evaluation modes:

* **per row** (:func:`template_column`, :func:`expand_template`): ``time`` takes its base
  from a timestamp column, so each row gets its own value; the product of all factors
  is one ``array<string>`` expression, exploded into rows. Pure column expressions:
  no shuffle, works on streaming frames.
* **once, on the driver** (:func:`resolve_template`, :func:`expand_values`): for job
  configuration such as input paths, evaluated against one base time. The output is as
  small as the template itself, never data.

``range`` and ``enum`` arguments are literals, so their value lists are computed once
from the arguments and enter the plan as literal arrays.
"""

from __future__ import annotations

import calendar
import re
from dataclasses import dataclass
from datetime import datetime, timedelta
from decimal import ROUND_HALF_EVEN, Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's rules) --------------------------------
# diff steps: optional sign ('+', '|' or '-'), a count, and one unit letter
DIFF_PATTERN = r"([+|-]?)(\d+)(y|M|d|H|m|s|w)"
# the only pattern letters replaced in a time pattern; everything else is literal text
TIME_TOKENS = r"(yyyy|MM|dd|HH|mm|ss)"
# base time given on the command line / runtime context
BASE_TIME_FORMAT = "yyyyMMddHHmmss"
# numbers print with at most 3 fraction digits, half-even, no grouping
MAX_FRACTION_DIGITS = 3
# enum items: 'a~b' is a half-open range, '^step' its step
ENUM_RANGE_SYMBOL = "~"
ENUM_STEP_SYMBOL = "^"
# -------------------------------------------------------------------------------------

_UNIT_TIMEDELTA = {"d": "days", "H": "hours", "m": "minutes", "s": "seconds", "w": "weeks"}
_UNIT_SQL = {"y": "YEAR", "M": "MONTH", "d": "DAY", "H": "HOUR", "m": "MINUTE", "s": "SECOND", "w": "WEEK"}


class TemplateError(ValueError):
    pass


@dataclass(frozen=True)
class Literal:
    text: str


@dataclass(frozen=True)
class Func:
    name: str
    args: tuple[str, ...]


def parse_template(text: str) -> list[Literal | Func]:
    """Split a template into literal runs and function calls."""
    parts: list[Literal | Func] = []
    buf: list[str] = []
    i, n = 0, len(text)
    last = ""
    while i < n:
        c = text[i]
        if c == "$" and last != "\\":
            if i + 1 >= n or text[i + 1] != "{":
                raise TemplateError(f"expression in {text!r} is not valid, missing {{")
            end = text.find("}", i + 2)
            if end < 0:
                raise TemplateError(f"expression in {text!r} is not valid, missing }}")
            if buf:
                parts.append(Literal("".join(buf)))
                buf = []
            body = text[i + 2:end]
            colon = body.find(":")
            if colon < 0:
                name, args = body.strip(), ()
            else:
                name = body[:colon].strip()
                args = tuple(a.strip() for a in body[colon + 1:].split(","))
            if name not in ("time", "range", "enum"):
                raise TemplateError(f"unknown template function {name!r}")
            parts.append(Func(name, args))
            i = end + 1
            last = "}"
            continue
        buf.append(c)
        last = c
        i += 1
    if buf:
        parts.append(Literal("".join(buf)))
    return parts


# ---- numbers --------------------------------------------------------------------------

def format_number(x: float, min_int_digits: int = 0) -> str:
    """Decimal rendering: integer part zero-padded, up to 3 fraction digits, half-even."""
    d = Decimal(x).quantize(Decimal(1).scaleb(-MAX_FRACTION_DIGITS), rounding=ROUND_HALF_EVEN)
    neg = d.is_signed()
    d = abs(d)
    whole, _, frac = f"{d:f}".partition(".")
    frac = frac.rstrip("0")
    whole = whole.lstrip("0") or ("0" if min_int_digits == 0 else "")
    whole = whole.rjust(min_int_digits, "0")
    return ("-" if neg else "") + whole + ("." + frac if frac else "")


def range_values(args: tuple[str, ...]) -> list[str]:
    """``${range:start[,end[,step[,width]]]}``: inclusive end; end defaults to start."""
    a = list(args) + [""] * (4 - len(args))
    if not a[0]:
        raise TemplateError("range needs a start")
    start = float(a[0])
    end = float(a[1]) if a[1] else start
    step = float(a[2]) if a[2] else 1.0
    width = int(a[3]) if a[3] else 0
    if step <= 0:
        raise TemplateError("range step must be positive")
    out = []
    while start <= end:  # accumulate like the reference so float edges agree
        out.append(format_number(start, width))
        start += step
    return out


def enum_values(args: tuple[str, ...]) -> list[str]:
    """``${enum:item,...,width}``: the last argument is always the width.

    An item is a literal (numbers are zero-padded) or ``a~b[^step]``, half-open [a, b).
    """
    if len(args) < 2:
        raise TemplateError("enum needs at least one item and a width")
    width = int(args[-1]) if args[-1] else 0
    out: list[str] = []
    for item in args[:-1]:
        rp = item.find(ENUM_RANGE_SYMBOL)
        if rp < 0:
            try:
                out.append(format_number(float(item), width))
            except ValueError:
                out.append(item)
            continue
        sp = item.find(ENUM_STEP_SYMBOL)
        start = float(item[:rp])
        end = float(item[rp + 1:sp] if sp >= 0 else item[rp + 1:])
        step = float(item[sp + 1:]) if sp >= 0 else 1.0
        if step <= 0:
            raise TemplateError("enum step must be positive")
        while start < end:
            out.append(format_number(start, width))
            start += step
    return out


# ---- time -----------------------------------------------------------------------------

def parse_diff(diff: str | None) -> list[tuple[str, int]]:
    """``-1M+1d`` -> ``[('M', -1), ('d', 1)]``; steps apply left to right."""
    if not diff or not diff.strip():
        return []
    return [(u, -int(n) if s == "-" else int(n)) for s, n, u in re.findall(DIFF_PATTERN, diff)]


def spark_time_pattern(pattern: str) -> str:
    """Turn a template time pattern into a Spark datetime pattern.

    Only the tokens yyyy MM dd HH mm ss are pattern letters; every other run of text is
    quoted so Spark prints it verbatim.
    """
    out = []
    for piece in re.split(TIME_TOKENS, pattern):
        if not piece:
            continue
        if re.fullmatch(TIME_TOKENS, piece):
            out.append(piece)
        else:
            out.append("'" + piece.replace("'", "''") + "'")
    return "".join(out)


def shift_time(c: Column, diff: str | None) -> Column:
    """Calendar add of every diff step, in order (month ends clamp, days keep wall time)."""
    for unit, n in parse_diff(diff):
        c = F.timestamp_add(_UNIT_SQL[unit], F.lit(n), c)
    return c


def time_column(base: Column | str, pattern: str | None, diff: str | None = None) -> Column:
    """E1 per row: ``${time:pattern,diff}`` with the base taken from a timestamp column."""
    if not pattern or not pattern.strip():
        return F.lit("")
    b = F.col(base) if isinstance(base, str) else base
    return F.date_format(shift_time(b.cast("timestamp"), diff), spark_time_pattern(pattern))


def _add_months(t: datetime, months: int) -> datetime:
    y, m = divmod(t.month - 1 + months, 12)
    year, month = t.year + y, m + 1
    day = min(t.day, calendar.monthrange(year, month)[1])
    return t.replace(year=year, month=month, day=day)


def shift_datetime(t: datetime, diff: str | None) -> datetime:
    for unit, n in parse_diff(diff):
        if unit == "y":
            t = _add_months(t, 12 * n)
        elif unit == "M":
            t = _add_months(t, n)
        else:
            t = t + timedelta(**{_UNIT_TIMEDELTA[unit]: n})
    return t


def parse_base_time(base: str | datetime | None) -> datetime:
    if base is None:
        return datetime.now().replace(microsecond=0)
    if isinstance(base, datetime):
        return base
    return datetime.strptime(base, "%Y%m%d%H%M%S")


def resolve_time(pattern: str | None, diff: str | None, base: str | datetime | None) -> str:
    """E1 once: format the shifted base time (``yyyyMMddHHmmss`` string, datetime or now)."""
    if not pattern or not pattern.strip():
        return ""
    t = shift_datetime(parse_base_time(base), diff)
    fmt = {"yyyy": "%04d" % t.year, "MM": "%02d" % t.month, "dd": "%02d" % t.day,
           "HH": "%02d" % t.hour, "mm": "%02d" % t.minute, "ss": "%02d" % t.second}
    return re.sub(TIME_TOKENS, lambda m: fmt[m.group(0)], pattern)


# ---- composite ------------------------------------------------------------------------

def _func_args(f: Func, k: int) -> tuple[str, ...]:
    return f.args + ("",) * max(0, k - len(f.args))


def _factor_values(part: Literal | Func, base) -> list[str]:
    """Driver-side values of one factor (config resolution)."""
    if isinstance(part, Literal):
        return [part.text]
    if part.name == "time":
        a = _func_args(part, 2)
        return [resolve_time(a[0], a[1], base)]
    if part.name == "range":
        return range_values(part.args)
    return enum_values(part.args)


def expand_values(template: str, base: str | datetime | None = None) -> list[str]:
    """E4 once: every combination of the factors, first factor varying slowest.

    A factor with no values is skipped, as in the reference. Used for job configuration
    (paths, partition specs); the result is as small as the template.
    """
    acc = [""]
    for part in parse_template(template):
        vals = _factor_values(part, base)
        if vals:
            acc = [a + v for a in acc for v in vals]
    return acc


def resolve_template(template: str, base: str | datetime | None = None) -> str:
    """E5 once: the first value of every factor, concatenated (target templates)."""
    out = []
    for part in parse_template(template):
        vals = _factor_values(part, base)
        out.append(vals[0] if vals else "")
    return "".join(out)


def _factor_column(part: Literal | Func, base: Column | None) -> Column | list[str]:
    if isinstance(part, Literal):
        return F.lit(part.text)
    if part.name == "time":
        a = _func_args(part, 2)
        if base is None:
            return F.lit(resolve_time(a[0], a[1], None))
        return time_column(base, a[0], a[1])
    return range_values(part.args) if part.name == "range" else enum_values(part.args)


def template_values_column(template: str, base: Column | str | None = None) -> Column:
    """E4 per row: ``array<string>`` of every combination, first factor slowest."""
    b = F.col(base) if isinstance(base, str) else base
    acc = F.array(F.lit(""))
    for part in parse_template(template):
        fc = _factor_column(part, b)
        if isinstance(fc, Column):
            acc = F.transform(acc, _append(fc))
        elif fc:
            acc = F.flatten(F.transform(acc, _append_each(F.array(*[F.lit(v) for v in fc]))))
    return acc


# Lambdas for higher-order functions must take exactly the element (PySpark reads a
# two-argument lambda as (element, index)), so the captured column comes from a closure.
def _append(suffix: Column):
    return lambda x: F.concat(x, suffix)


def _append_each(values: Column):
    return lambda x: F.transform(values, lambda y: F.concat(x, y))


def template_column(template: str, base: Column | str | None = None) -> Column:
    """E5 per row: first value of every factor, concatenated (``add_field`` values)."""
    b = F.col(base) if isinstance(base, str) else base
    cols = []
    for part in parse_template(template):
        fc = _factor_column(part, b)
        if isinstance(fc, Column):
            cols.append(fc)
        elif fc:
            cols.append(F.lit(fc[0]))
    return F.concat(*cols) if cols else F.lit("")


def expand_template(template: str, base: Column | str | None = None, out: str = "value",
                    keep: list[str] | None = None, with_position: bool = False):
    """E4 per row as a transform: one output row per combination.

    ``keep`` lists input columns carried to the output (default: all). With
    ``with_position`` a 0-based ``pos`` column gives the combination's order.
    """

    def op(df: DataFrame) -> DataFrame:
        carry = [F.col(c) for c in (df.columns if keep is None else keep)]
        arr = template_values_column(template, base)
        if with_position:
            return df.select(*carry, F.posexplode(arr).alias("pos", out))
        return df.select(*carry, F.explode(arr).alias(out))

    return op


def expand_template_frame(spark: SparkSession, template: str, base: str | datetime | None = None) -> DataFrame:
    """E4 once as a DataFrame ``(pos, value)`` -- e.g. to join a path list against an inventory."""
    t = parse_base_time(base)
    lit_base = F.lit(t.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    return spark.range(1).select(F.posexplode(template_values_column(template, lit_base)).alias("pos", "value"))


def seq_value(runtime: dict, name: str = "N", offset: str | int | None = None) -> int:
    """E7 ``${seq:N[,+k]}``: the integer runtime parameter ``N`` shifted by ``k``."""
    v = int(runtime[name])
    if offset not in (None, ""):
        v += int(str(offset).replace("+", ""))
    return v
