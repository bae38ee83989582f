"""A1: transfer report -- rows and characters per target, totals, elapsed, throughput.

Two forms:

* :func:`observe_transfer` attaches a named ``Observation`` (``count``, ``sum(length)``)
  to the frame being written, so the numbers come from the write itself with no extra
  pass over the data;
* :func:`transfer_report` is the same metrics as a grouped aggregate (one row per
  target/key), a partial + final hash aggregate.
"""

from __future__ import annotations

import threading
import time
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# how long after a sink has returned its metrics may take to arrive
OBSERVED_WITHIN = 60.0


def _line_length(df: DataFrame, col: str | None) -> Column:
    if col is not None:
        return F.length(F.col(col))
    from sluice.operators.process import join_fields
    return F.length(join_fields(df.columns, "\t"))


def observe_transfer(df: DataFrame, name: str, line_col: str | None = None) -> tuple[DataFrame, Observation]:
    """Attach row / character / byte counters to ``df``; read them after the action."""
    obs = Observation(name)
    length = _line_length(df, line_col)
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"),
                          F.coalesce(F.sum(length), F.lit(0)).cast("bigint").alias("chars"))
    return observed, obs


class StepCounter:
    """Counts rows at the steps of one plan: a named observation each, no extra pass."""

    def __init__(self, target: str):
        self.target, self.seen = target, []

    def source(self, df: DataFrame, name: str) -> DataFrame:
        return self._count(df, f"source {name}", [])

    def after(self, df: DataFrame, name: str, before: list[int]) -> DataFrame:
        """``before``: the numbers of the steps whose rows this one gets."""
        return self._count(df, name, before)

    def _count(self, df: DataFrame, step: str, before: list[int]) -> DataFrame:
        obs = Observation(f"{self.target}: {len(self.seen)} {step} {uuid.uuid4().hex[:8]}")
        self.seen.append((step, obs, before))
        return df.observe(obs, F.count(F.lit(1)).alias("rows"))

    @property
    def last(self) -> int:
        return len(self.seen) - 1

    def counts(self) -> list[StepCount]:
        """Once the target is written. A branch that the optimizer proves empty is not run: all 0."""
        rows = [int(observed_metrics(obs, self.target).get("rows", 0)) for _, obs, _ in self.seen]
        return [StepCount(self.target, step, sum(rows[b] for b in before) if before else n, n)
                for (step, _, before), n in zip(self.seen, rows)]


def observed_metrics(obs: Observation, name: str, seconds: float = OBSERVED_WITHIN) -> dict:
    """The observation's metrics; fails if no DataFrame action on the frame delivers them in time.

    A sink that leaves DataFrame execution (``.rdd``) or writes nothing never completes an
    observation, and ``Observation.get`` would wait for it forever.
    """
    found: list[dict] = []

    def fetch():
        try:
            found.append(obs.get)
        except Py4JJavaError:
            found.append({})  # the optimizer proved that no row comes here, and left the count out

    waiter = threading.Thread(target=fetch, daemon=True)
    waiter.start()
    waiter.join(seconds)
    if not found:
        raise RuntimeError(f"target {name!r}: its sink ran no DataFrame action on the frame it was given, so nothing was counted")
    return found[0]


def transfer_report(by: str | None = None, line_col: str | None = None):
    """Rows and characters per ``by`` value (or in total) as a DataFrame."""

    def op(df: DataFrame) -> DataFrame:
        length = _line_length(df, line_col)
        aggs = [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(length), F.lit(0)).cast("bigint").alias("chars")]
        return df.groupBy(by).agg(*aggs) if by else df.agg(*aggs)

    return op


@dataclass
class TargetStats:
    target: str
    rows: int = 0
    chars: int = 0
    seconds: float = 0.0

    @property
    def rows_per_sec(self) -> float:
        return self.rows / self.seconds if self.seconds > 0 else 0.0

    @property
    def chars_per_sec(self) -> float:
        return self.chars / self.seconds if self.seconds > 0 else 0.0


@dataclass
class StepCount:
    """Rows before and after one step of the way to a target; a source has as many as it gives."""

    target: str
    step: str
    rows_in: int
    rows_out: int

    @property
    def dropped(self) -> int:
        """Rows that the step left out; below zero if it made more of them."""
        return self.rows_in - self.rows_out


@dataclass
class Report:
    targets: list[TargetStats] = field(default_factory=list)
    steps: list[StepCount] = field(default_factory=list)
    started: float = field(default_factory=time.time)

    @property
    def total_rows(self) -> int:
        return sum(t.rows for t in self.targets)

    @property
    def total_chars(self) -> int:
        return sum(t.chars for t in self.targets)

    def rows_in(self, target: str) -> int:
        """Rows that the target's sources gave (counted steps only)."""
        return sum(s.rows_out for s in self.steps if s.target == target and s.step.startswith("source "))

    def dropped(self, target: str) -> int:
        return sum(s.dropped for s in self.steps if s.target == target)

    def reconciled(self) -> bool:
        """Whether for every target the rows read are those dropped on the way and those written."""
        return all(self.rows_in(t.target) == self.dropped(t.target) + t.rows for t in self.targets)

    def as_rows(self) -> list[dict]:
        return [{"target": t.target, "rows": t.rows, "chars": t.chars, "seconds": round(t.seconds, 3),
                 "rows_per_sec": round(t.rows_per_sec, 1), "chars_per_sec": round(t.chars_per_sec, 1)}
                for t in self.targets]

    def __str__(self) -> str:
        lines = [f"{r['target']}: {r['rows']} rows, {r['chars']} chars, {r['seconds']} s, "
                 f"{r['rows_per_sec']} rows/s, {r['chars_per_sec']} chars/s" for r in self.as_rows()]
        lines.append(f"total: {self.total_rows} rows, {self.total_chars} chars, "
                     f"{time.time() - self.started:.3f} s elapsed")
        return "\n".join(lines)
