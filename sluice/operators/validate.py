"""Declared field validation (regex / range) that routes bad rows aside.

Rules are a conjunction per field, evaluated as column expressions over one plan; the
good and rejected frames are two filters of the same lineage (persist the checked frame
when both are written).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERRORS = "_errors"


def _rule_fails(c: Column, rtype: str, expr: str) -> Column:
    rtype = rtype.lower()
    if rtype == "regex":
        return c.isNull() | ~c.cast("string").rlike(r"\A(?:" + expr + r")\z")
    if rtype == "range":
        lo, _, hi = expr.partition(",")
        v = c.cast("string").try_cast("double")
        bad = v.isNull()
        if lo.strip():
            bad = bad | (v < F.lit(float(lo)))
        if hi.strip():
            bad = bad | (v > F.lit(float(hi)))
        return bad
    raise ValueError(f"unknown validation type {rtype!r} (regex | range)")


def check_fields(rules: Mapping[str, Sequence[tuple[str, str]]], out: str = ERRORS):
    """Add ``out``: array of ``"field:type"`` for every failed rule (empty when valid).

    ``regex`` must match the whole value; ``range`` is ``"lo,hi"`` inclusive (either side
    may be blank). A NULL value fails its rules.
    """

    def op(df: DataFrame) -> DataFrame:
        checks = []
        for name, field_rules in rules.items():
            for rtype, expr in field_rules:
                checks.append(F.when(_rule_fails(F.col(name), rtype, expr), F.lit(f"{name}:{rtype.lower()}")))
        errs = F.filter(F.array(*checks), lambda x: x.isNotNull()) if checks else F.array().cast("array<string>")
        return df.withColumn(out, errs)

    return op


def validate_fields(df: DataFrame, rules: Mapping[str, Sequence[tuple[str, str]]]) -> tuple[DataFrame, DataFrame]:
    """Split into ``(good, rejected)``; ``rejected`` keeps the ``_errors`` reasons."""
    checked = df.transform(check_fields(rules))
    good = checked.filter(F.size(ERRORS) == 0).drop(ERRORS)
    rejected = checked.filter(F.size(ERRORS) > 0)
    return good, rejected
