"""Wide-column reshaping: rows <-> (rowkey, family, qualifier, value) cells, day-range filter.

* K8 :func:`rows_to_cells` is a generator (``inline`` of an array of structs): no shuffle.
* S14 :func:`cells_to_rows` is an explicit-value pivot, ``groupBy(rowkey).agg(max(when..))``.
  It is a hash aggregate with a map-side partial step, so a row key with very many cells
  is combined per task before the shuffle; the output has one row per key.
* S15 :func:`filter_day_range` compares against constant bounds, so on a timestamp column
  the predicate reaches the Parquet scan as a pushed filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.delimiters import unescape_delim

# ---- fixed values (must equal the reference's rules) --------------------------------
CELL_JOIN = "\u0001"
CELL_STRIP = "\r\n\u0001"
# -------------------------------------------------------------------------------------


def rows_to_cells(key_pos: Sequence[int], value_pos: Sequence[int], qualifiers: Sequence[str],
                  family: str, key_delim: str = "-", keep: Sequence[str] = ()):
    """K8: row key = fields at 1-based ``key_pos`` joined by ``key_delim``; one cell per
    ``value_pos`` field, named by ``qualifiers``, all in ``family``.

    Output columns ``rowkey, family, qualifier, value`` (NULL values stay NULL cells).
    """
    if len(value_pos) != len(qualifiers):
        raise ValueError("value positions and qualifiers differ in length")
    d = unescape_delim(key_delim)

    def op(df: DataFrame) -> DataFrame:
        cols = df.columns

        def at(p: int) -> Column:
            if not 1 <= p <= len(cols):
                raise IndexError(f"position {p} out of 1..{len(cols)}")
            return F.col(cols[p - 1]).cast("string")

        rowkey = F.concat_ws(d, *[F.coalesce(at(p), F.lit("")) for p in key_pos])
        cells = F.array(*[F.struct(F.lit(family).alias("family"), F.lit(q).alias("qualifier"), at(p).alias("value"))
                          for p, q in zip(value_pos, qualifiers)])
        return df.select(*[F.col(k) for k in keep], rowkey.alias("rowkey"), F.inline(cells))

    return op


def parse_layout(families: str, columns: str) -> list[tuple[str, str]]:
    """``"f1|f2"`` + ``"a,b|c"`` -> ``[(f1,a), (f1,b), (f2,c)]``, the scan's column order."""
    fams = [f.strip() for f in families.split("|")]
    groups = [g for g in columns.split("|")]
    if len(fams) != len(groups):
        raise ValueError("one column group per family is required")
    return [(f, q.strip()) for f, g in zip(fams, groups) for q in g.split(",") if q.strip()]


def cells_to_rows(families: str, columns: str, as_line: bool = False, naming: str = "{family}_{qualifier}",
                  ts_col: str | None = None):
    """Cells -> one row per row key with the listed family/qualifier columns in order.

    Values have CR, LF and ``\\001`` removed. With ``as_line`` a ``value`` column adds the
    text line: rowkey and values joined by ``\\001`` (missing cell = empty).
    """
    layout = parse_layout(families, columns)

    def op(cells: DataFrame) -> DataFrame:
        aggs = []
        for fam, q in layout:
            hit = (F.col("family") == F.lit(fam)) & (F.col("qualifier") == F.lit(q))
            text = F.translate(F.col("value").cast("string"), CELL_STRIP, "")
            if ts_col:
                v = F.max_by(text, F.when(hit, F.struct(ts_col, text)))
            else:
                v = F.max(F.when(hit, text))
            aggs.append(v.alias(naming.format(family=fam, qualifier=q)))
        wide = cells.groupBy("rowkey").agg(*aggs)
        if not as_line:
            return wide
        parts = [F.col("rowkey")] + [F.coalesce(F.col(c), F.lit("")) for c in wide.columns[1:]]
        return wide.withColumn("value", F.concat_ws(CELL_JOIN, *parts))

    return op


def filter_day_range(col: str, begin: str | None = None, end: str | None = None):
    """Keep rows with ``begin 00:00:00 <= col < end 00:00:00`` (dates ``yyyy-MM-dd``).

    A missing bound is open. Timestamp/date columns compare as timestamps, whole numbers as
    epoch seconds (both pushed down to the scan); other columns are read as epoch seconds.
    """

    def op(df: DataFrame) -> DataFrame:
        dtype = df.schema[col].dataType
        c = F.col(col)
        cond = F.lit(True)
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            lo = F.to_timestamp(F.lit(begin), "yyyy-MM-dd") if begin else None
            hi = F.to_timestamp(F.lit(end), "yyyy-MM-dd") if end else None
        else:
            if not isinstance(dtype, T.IntegralType):
                c = c.cast("string").try_cast("bigint")
            lo = F.unix_timestamp(F.lit(begin), "yyyy-MM-dd") if begin else None
            hi = F.unix_timestamp(F.lit(end), "yyyy-MM-dd") if end else None
        if lo is not None:
            cond = cond & (c >= lo)
        if hi is not None:
            cond = cond & (c < hi)
        return df.filter(cond)

    return op
