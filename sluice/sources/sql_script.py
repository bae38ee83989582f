"""SQL script source -- statements split on ``;`` (``\\;`` is a literal), run in order in
one session; the rows of every query statement are concatenated.

Each statement goes to ``spark.sql``, so the whole of Spark SQL (joins, windows, grouping
sets, UDFs registered on the session) is available and planned by Catalyst. DDL such as
``CREATE TEMP VIEW`` or ``CREATE TEMPORARY FUNCTION`` runs eagerly; queries stay lazy until the
caller acts. Python functions, scalar ones and table functions, can be given to a script by name.

A statement may be a template (S16): ``${time:..}``, ``${range:..}`` and ``${enum:..}`` in its text
multiply it, and templates given for its parameter markers (``:name``) bind every combination of
their values. All the statements that come of it are one plan.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from datetime import datetime
from functools import reduce
from itertools import product

from pyspark.sql import DataFrame, SparkSession

from sluice.functions.template import expand_values

# what a statement is made of: text without special marks, or one of the things that hide a semicolon
_PART = re.compile(r"""
    (?P<escape> \\ ; )
  | (?P<quoted> (?<![A-Za-z0-9_])[rR]'[^']*' | (?<![A-Za-z0-9_])[rR]"[^"]*"
              | '(?:[^'\\]|\\.)*' | "(?:[^"\\]|\\.)*" | `(?:[^`]|``)*` )
  | (?P<comment> --[^\n]* | /\* )
  | (?P<end> ; )
  | (?P<text> [^\\;'"`/rR-]+ | . )
""", re.X | re.S)


def _bracketed_end(script: str, at: int) -> int:
    """Where the bracketed comment that begins at ``at`` ends; they nest, and an open one takes the rest."""
    depth = 0
    for m in re.compile(r"/\*|\*/").finditer(script, at):
        depth += 1 if m[0] == "/*" else -1
        if depth == 0:
            return m.end()
    return len(script)


def split_statements(script: str) -> list[str]:
    """Split on each ``;`` outside of quotes and comments that is not escaped as ``\\;``.

    ``\\;`` becomes a semicolon, also within quotes. Comments stay in their statement (hints are
    comments); blank and comment-only statements are dropped. A quote that is never closed is a
    plain character, so the parser reports it.
    """
    out, whole, bare, at = [], [], [], 0

    def close():
        if "".join(bare).strip():
            out.append("".join(whole).strip())
        whole.clear()
        bare.clear()

    while at < len(script):
        m = _PART.match(script, at)
        at, kind, text = m.end(), m.lastgroup, m[0]
        if kind == "end":
            close()
            continue
        if kind == "comment":
            if text == "/*":
                at = _bracketed_end(script, m.start())
                text = script[m.start() : at]
        else:
            text = text.replace("\\;", ";") if kind in ("escape", "quoted") else text
            bare.append(text)
        whole.append(text)
    close()
    return out


def register_functions(spark: SparkSession, functions: Mapping[str, Callable]) -> None:
    """Python functions under the names that a script calls them by.

    Scalar ones (``udf``, ``pandas_udf``, ``arrow_udf``) and table functions (``udtf``) alike.
    """
    for name, fn in functions.items():
        table_function = hasattr(fn, "evalType") and type(fn).__name__ == "UserDefinedTableFunction"
        (spark.udtf if table_function else spark.udf).register(name, fn)


def run_statements(spark: SparkSession, script: str) -> list[DataFrame]:
    """Run every statement; return the frames of those that produce rows (queries)."""
    results = []
    for stmt in split_statements(script):
        df = spark.sql(stmt)
        if df.columns and not df.isStreaming and _is_query(df):
            results.append(df)
    return results


def _is_query(df: DataFrame) -> bool:
    """Whether Spark planned a query, or a command whose purpose is its rows (SHOW, DESCRIBE, EXPLAIN)."""
    plan = df._jdf.queryExecution().commandExecuted()
    if plan.getClass().getSimpleName() != "CommandResult":
        return True
    return plan.commandLogicalPlan().getClass().getSimpleName().startswith(("Show", "Describe", "Explain"))


def scan_sql(spark: SparkSession, script: str, functions: Mapping[str, Callable] | None = None) -> DataFrame:
    """All query results of the script, concatenated positionally (bag union)."""
    register_functions(spark, functions or {})
    return _concatenated(run_statements(spark, script))


def _concatenated(results: list[DataFrame]) -> DataFrame:
    if not results:
        raise ValueError("the script has no query statement")
    widths = {len(r.columns) for r in results}
    if len(widths) > 1:
        raise ValueError(f"query results differ in width {sorted(widths)}; render them as lines first")
    return reduce(lambda a, b: a.union(b), results)


def expand_statements(template: str, base: str | datetime | None = None) -> list[str]:
    """S16 on a statement: its text for every combination of its templates, first factor slowest."""
    return expand_values(template, base)


def scan_sql_template(spark: SparkSession, statement: str, parameters: Mapping[str, str] | None = None,
                      base: str | datetime | None = None) -> DataFrame:
    """S16 into S9: one query for every combination of template values, united in one plan.

    ``parameters``: templates by the name of a marker in the statement, e.g.
    ``scan_sql_template(spark, "SELECT .. WHERE month = :m", {"m": "${enum:1~4,2}"})``. Their values
    are bound, not pasted, so they are always data (strings; cast them in the statement).
    Templates in the statement's own text are pasted: use them for names, such as tables.
    Combinations come in the order of ``parameters``, the first one slowest.
    """
    names = list(parameters or {})
    values = [expand_values(parameters[n], base) for n in names]
    results = []
    for text in expand_statements(statement, base):
        (query,) = split_statements(text) or [""]
        if not query:
            raise ValueError("the template is no statement")
        for combination in product(*values):
            df = spark.sql(query, args=dict(zip(names, combination))) if names else spark.sql(query)
            if not _is_query(df):
                raise ValueError("only queries can be templates: a command would run once for each value")
            results.append(df)
    return _concatenated(results)
