"""Row rendering: typed columns -> one text line (RDBMS rules) or one JSON object."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.delimiters import unescape_delim

# ---- fixed values (must equal the reference's rules) --------------------------------
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
ESCAPED_TAB = "\\t"
ESCAPED_LF = "\\n"
# -------------------------------------------------------------------------------------


def field_text(df: DataFrame, name: str) -> Column:
    """One field as text: timestamps as ``yyyy-MM-dd HH:mm:ss``, everything else ``cast``."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, DATETIME_FORMAT)
    return c.cast("string")


def render_line(field_delim: str = "\\t", cols: Sequence[str] | None = None, escape: bool = True,
                out: str = "value", keep: Sequence[str] = ()):
    """Render a row as a delimited line.

    NULL joins as ``''``; with ``escape`` a tab inside a field becomes the two characters
    ``\\t`` and a line feed anywhere in the row becomes ``\\n``, so each row stays one line.
    ``keep`` names columns carried next to the line.
    """
    d = unescape_delim(field_delim)

    def op(df: DataFrame) -> DataFrame:
        parts = []
        for name in cols or df.columns:
            t = field_text(df, name)
            if escape:
                t = F.replace(t, F.lit("\t"), F.lit(ESCAPED_TAB))
            parts.append(F.coalesce(t, F.lit("")))
        line = F.concat_ws(d, *parts)
        if escape:
            line = F.replace(line, F.lit("\n"), F.lit(ESCAPED_LF))
        return df.select(*[F.col(k) for k in keep], line.alias(out))

    return op


def render_json(cols: Sequence[str] | None = None, keep_nulls: bool = True, out: str = "value"):
    """S10c ``COLUMNS`` shape: one JSON object per row keyed by column label."""

    def op(df: DataFrame) -> DataFrame:
        names = list(cols or df.columns)
        opts = {"ignoreNullFields": "false"} if keep_nulls else {}
        return df.select(F.to_json(F.struct(*[F.col(c) for c in names]), opts).alias(out))

    return op


def row_shape(shape: str = "LINE", field_delim: str = "\\t", cols: Sequence[str] | None = None):
    """``LINE`` (delimited, NULL as empty, no escaping) or ``COLUMNS`` (JSON)."""
    if shape.upper() == "COLUMNS":
        return render_json(cols)
    return render_line(field_delim, cols, escape=False)
