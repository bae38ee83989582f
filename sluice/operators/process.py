"""Row processors (split, add / keep / drop / replace a field, filter rows, re-delimit, JSON).

Each factory returns a ``DataFrame -> DataFrame`` function, so a processor chain is
``df.transform(p1).transform(p2)`` (see :func:`chain`). All of them are stateless
projections or filters: no shuffle, whole-stage codegen, and they accept streaming
frames unchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.delimiters import split_pattern, unescape_delim

Transform = Callable[[DataFrame], DataFrame]

NULL_TOKEN = "\\N"


def _as_column(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.expr(value)


def _require(df: DataFrame, name: str, what: str) -> None:
    if name not in df.columns:
        raise ValueError(f"{what}: no field named {name!r} in {df.columns}")


def split_line(fields: Sequence[str], delim: str = "\\t", col: str = "value", regex: bool = False,
               keep: Sequence[str] = ()) -> Transform:
    """Split one text column into named string fields.

    Trailing empty fields are kept (limit -1). A field past the end of a short line is
    NULL. The delimiter is literal unless ``regex=True``. ``keep`` names input columns
    to carry through next to the fields.
    """
    pattern = split_pattern(delim, regex)

    def op(df: DataFrame) -> DataFrame:
        arr = F.split(F.col(col), pattern, -1)
        cols = [F.col(k) for k in keep]
        cols += [F.try_element_at(arr, F.lit(i + 1)).alias(name) for i, name in enumerate(fields)]
        return df.select(*cols)

    return op


def split_to_array(delim: str = "\\t", col: str = "value", out: str = "fields", regex: bool = False) -> Transform:
    """P1 without a schema: the whole field list as ``array<string>`` (trailing empties kept)."""
    pattern = split_pattern(delim, regex)
    return lambda df: df.withColumn(out, F.split(F.col(col), pattern, -1))


def add_field(name: str, value: Column | str, before: str | None = None, after: str | None = None) -> Transform:
    """Insert a field. ``before`` wins over ``after``; neither appends.

    An unknown ``after`` inserts at position 0 (the reference resolves it to index -1,
    then inserts at -1 + 1); an unknown ``before`` is an error. ``value`` is a Column or
    a Spark SQL expression string.
    """

    def op(df: DataFrame) -> DataFrame:
        names = [c for c in df.columns if c != name]
        if before is not None:
            _require(df, before, "add-field before")
            pos = names.index(before)
        elif after is not None:
            pos = names.index(after) + 1 if after in names else 0
        else:
            pos = len(names)
        new = _as_column(value).alias(name)
        cols = [F.col(c) for c in names]
        return df.select(*cols[:pos], new, *cols[pos:])

    return op


def filter_field(names: Sequence[str]) -> Transform:
    """Keep the listed fields, in the listed order."""
    return lambda df: df.select(*[F.col(n) for n in names])


def remove_field(name: str) -> Transform:
    """Drop one field; an unknown name is an error (Spark's ``drop`` would ignore it)."""

    def op(df: DataFrame) -> DataFrame:
        _require(df, name, "remove-field")
        return df.drop(name)

    return op


def replace_field(name: str, pattern: str, value: str) -> Transform:
    """P5: ``regexp_replace`` on one field; ``$1`` group references work (Java regex)."""

    def op(df: DataFrame) -> DataFrame:
        _require(df, name, "replace-field")
        return df.withColumn(name, F.regexp_replace(F.col(name), pattern, value))

    return op


def filter_row(predicate: Column | str) -> Transform:
    """Keep a row iff the predicate is TRUE (NULL drops the row)."""
    return lambda df: df.filter(_as_column(predicate))


def join_fields(cols: Sequence[Column | str], delim: str) -> Column:
    """Join fields with a literal delimiter; NULL joins as the empty string.

    Bare ``concat_ws`` skips NULLs, which would shift every later field.
    """
    d = unescape_delim(delim)
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cols]
    return F.concat_ws(d, *parts)


def replace_delimit(delim: str, cols: Sequence[str] | None = None, out: str = "value") -> Transform:
    """Render the fields as one line joined by a new (unescaped, literal) delimiter."""

    def op(df: DataFrame) -> DataFrame:
        return df.select(join_fields(list(cols or df.columns), delim).alias(out))

    return op


def _is_blank(c: Column) -> Column:
    # Java's Character.isWhitespace is exactly the regex class \p{javaWhitespace}.
    return c.isNull() | c.rlike("^\\p{javaWhitespace}*$")


def line_to_json(names: Sequence[str], index: Sequence[str | int], out: str = "value") -> Transform:
    """Render chosen fields (by position) as one JSON object of strings.

    * plain entry ``name`` / ``i``: key omitted when the field is ``\\N`` (or NULL);
    * pair entry ``"a,b"`` / ``"i,j"``: key ``a`` holds field ``i`` unless it is blank,
      then field ``j`` -- kept even when it is ``\\N``.

    Key order is the list order; a repeated key keeps its first position and the last
    value. List lengths must agree and there may not be more indices than fields.
    """
    names = [str(n) for n in names]
    index = [str(i) for i in index]
    if len(names) != len(index):
        raise ValueError(f"field-names has {len(names)} entries but field-index has {len(index)}")

    def op(df: DataFrame) -> DataFrame:
        fields = df.columns
        if len(index) > len(fields):
            raise ValueError(f"{len(index)} field indices but only {len(fields)} fields")

        def field(i: str) -> Column:
            k = int(i.strip())
            if not 0 <= k < len(fields):
                raise IndexError(f"field index {k} out of range for {len(fields)} fields")
            return F.col(fields[k]).cast("string")

        entries: dict[str, Column] = {}
        for name, idx in zip(names, index):
            if "," in name and name.rfind(",") != len(name) - 1:
                key = name.split(",")[0]
                i0, i1 = idx.split(",")[:2]
                first = field(i0)
                entries[key] = F.when(_is_blank(first), field(i1)).otherwise(first)
            else:
                v = field(idx)
                entries[name] = F.when(v != F.lit(NULL_TOKEN), v)
        return df.select(F.to_json(F.struct(*[c.alias(k) for k, c in entries.items()])).alias(out))

    return op


def map_batches(fn: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table], schema: str | T.StructType, columns: Sequence[str] | None = None) -> Transform:
    """A user's processor over Arrow batches, with a declared result schema.

    ``fn`` gets each batch of ``columns`` (default: all) and returns the batch that takes its place,
    of any length; other columns never leave the JVM, so they are pruned from the scan. What it
    returns is matched to ``schema`` by name and cast safely: a missing column, or a value that
    does not fit, fails the task. A batch is all that a task holds. Works on streams, too.
    """

    def op(df: DataFrame) -> DataFrame:
        from pyspark.sql.pandas.types import to_arrow_schema

        declared = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        wanted = to_arrow_schema(declared)

        def run(batches):
            for batch in batches:
                out = fn(batch)
                for part in [out] if isinstance(out, pa.RecordBatch) else out.combine_chunks().to_batches():
                    missing = [n for n in wanted.names if n not in part.schema.names]
                    if missing:
                        raise ValueError(f"the processor returned {part.schema.names}, without {missing}")
                    yield pa.RecordBatch.from_arrays([part.column(n).cast(wanted.field(n).type) for n in wanted.names], names=wanted.names)

        return (df.select(*columns) if columns else df).mapInArrow(run, declared)

    return op


def console(n: int = 20, truncate: bool = False) -> Transform:
    """P10: print the schema and the first ``n`` rows, pass the frame through."""

    def op(df: DataFrame) -> DataFrame:
        df.printSchema()
        df.show(n, truncate=truncate)
        return df

    return op


def chain(*ops: Transform) -> Transform:
    """Apply processors in order."""
    return lambda df: reduce(lambda d, f: d.transform(f), ops, df)


def limit_rows(n: int) -> Transform:
    """L1: cap the row count; ``0`` (or less) means no cap."""
    return lambda df: df.limit(n) if n and n > 0 else df


def union_sources(*dfs: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Bag union of all sources of one channel, matched by column name."""
    if not dfs:
        raise ValueError("no sources")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)
