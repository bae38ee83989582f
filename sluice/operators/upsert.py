"""K6: upsert of incoming rows into an existing table, as a DataFrame operation.

``replace``: the incoming row wins on a key match (MySQL ``REPLACE``);
``ignore`` : the existing row wins (``INSERT IGNORE``).

Duplicates *within* the incoming frame are resolved by an explicit order column (there is
no file order in Spark): last wins for ``replace``, first wins for ``ignore``.

Plan shape, designed for two large inputs:

* de-duplication is an aggregate ``max/min(struct(order, *cols))`` grouped by key, not a window.
  Spark runs it sort-based (a struct is no mutable buffer), partial before the shuffle, so a hot
  key that holds a third of the rows is collapsed per task instead of landing whole in one task;
* a NULL key equals no other key: rows with a NULL in any key column are all kept;
* the key match is one ``left_anti`` join. After de-duplication each side has unique keys,
  so the join cannot explode or skew; AQE turns it into a broadcast join at run time when
  one side is measured small (no unchecked ``broadcast()``);
* ``set`` computed columns are plain projections on the incoming rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedupe_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] | str, keep: str = "last") -> DataFrame:
    """One row per key: the row with the greatest (``last``) or least (``first``) order value.

    A unique key does not equate NULLs: every row with a NULL key column stays.
    """
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in rest])
    pick = F.max(packed) if keep == "last" else F.min(packed)
    nameless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    apart = df.withColumn("__apart", F.when(nameless, F.monotonically_increasing_id()))
    out = apart.groupBy(*keys, "__apart").agg(pick.alias("__row"))
    return out.select(*[F.col(k) for k in keys], *[F.col(f"__row.{c}").alias(c) for c in rest]) \
        .select(*df.columns)


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], mode: str = "replace",
           order: Sequence[str] | str | None = None, set_cols: Mapping[str, Column | str] | None = None) -> DataFrame:
    """Merge ``incoming`` into ``existing`` on ``keys``; returns the full resulting table.

    ``order`` (column names of ``incoming``) resolves duplicate incoming keys; without it
    the incoming keys must already be unique. ``set_cols`` adds or overrides computed
    columns of the incoming rows (the loader's ``SET col = expr``).
    """
    mode = mode.lower()
    if mode not in ("replace", "ignore"):
        raise ValueError("mode must be 'replace' or 'ignore'")
    keys = list(keys)
    if set_cols:
        incoming = incoming.withColumns({k: (v if isinstance(v, Column) else F.expr(v)) for k, v in set_cols.items()})
    if order is not None:
        incoming = dedupe_by_key(incoming, keys, order, keep="last" if mode == "replace" else "first")
        order_cols = [order] if isinstance(order, str) else list(order)
        incoming = incoming.drop(*[c for c in order_cols if c not in existing.columns])
    incoming = incoming.select(*existing.columns)
    if mode == "replace":
        kept = existing.join(incoming.select(*keys), keys, "left_anti")
        return kept.unionByName(incoming)
    new = incoming.join(existing.select(*keys), keys, "left_anti")
    return existing.unionByName(new)
