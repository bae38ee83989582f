"""TransferJob -- sources -> union per id -> shared transforms -> per-target transforms
-> sinks -> transfer report.

A job is a plain value object over DataFrames; Spark does the scheduling. Semantics kept
from the reference:

* S17: every source with the same id feeds that id's channel (bag union); id ``ALL``
  feeds every channel;
* P11: input processors run once for all rows of a channel, then each target's own list;
  a target may name several ids (``"1,2"``);
* U2: a channel that several targets share is read again by each of them, which a pruned
  scan and narrow steps make cheap. With ``fanout="persist"`` it is computed once and kept
  (memory + disk) for the duration of the writes: for channels that are dear to compute;
* A1: each write carries an ``Observation`` with its rows and characters (no extra pass). With
  ``count_steps`` every source, and every processor on the way, carries one as well, so that the
  report says what came in, what each step dropped and what went out. A counted scan reads all
  of its rows, as filters are not pushed through a count.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from sluice.operators.process import chain, union_sources
from sluice.operators.report import Report, StepCounter, TargetStats, observe_transfer, observed_metrics

ALL = "ALL"
Transform = Callable[[DataFrame], DataFrame]
Sink = Callable[[DataFrame], None]


@dataclass
class Source:
    id: str
    load: Callable[[SparkSession], DataFrame]


@dataclass
class Target:
    name: str
    ids: str                      # "1" or "1,2"
    sink: Sink
    transforms: Sequence[Transform] = ()
    line_col: str | None = None   # column whose length is reported (default: rendered row)


@dataclass
class TransferJob:
    sources: list[Source]
    targets: list[Target]
    input_transforms: Sequence[Transform] = ()
    allow_missing_columns: bool = False
    fanout: str = "recompute"     # or "persist"
    count_steps: bool = False     # counts at sources and processors; needs fanout="recompute"
    storage_level: StorageLevel = field(default_factory=lambda: StorageLevel.MEMORY_AND_DISK)

    def channel_ids(self) -> list[str]:
        ids: list[str] = []
        for t in self.targets:
            for i in t.ids.split(","):
                i = i.strip()
                if i and i not in ids:
                    ids.append(i)
        return ids

    def channel(self, spark: SparkSession, cid: str) -> DataFrame:
        frames = [s.load(spark) for s in self.sources if s.id == cid or s.id == ALL]
        if not frames:
            raise ValueError(f"no source feeds id {cid!r}")
        df = union_sources(*frames, allow_missing=self.allow_missing_columns)
        return df.transform(chain(*self.input_transforms))

    def _counted(self, spark: SparkSession, t: Target, counter: StepCounter) -> DataFrame:
        """The target's frame with a count at every source and after every processor."""
        channels, last = [], []
        for cid in [i.strip() for i in t.ids.split(",") if i.strip()]:
            sources = [s for s in self.sources if s.id == cid or s.id == ALL]
            if not sources:
                raise ValueError(f"no source feeds id {cid!r}")
            frames, before = [], []
            for k, s in enumerate(sources):
                frames.append(counter.source(s.load(spark), f"{cid}.{k}"))
                before.append(counter.last)
            df = union_sources(*frames, allow_missing=self.allow_missing_columns)
            for k, f in enumerate(self.input_transforms):
                df = counter.after(df.transform(f), f"input {cid}.{k}", before)
                before = [counter.last]
            channels.append(df)
            last += before
        df = union_sources(*channels, allow_missing=self.allow_missing_columns)
        for k, f in enumerate(t.transforms):
            df = counter.after(df.transform(f), f"output {k}", last)
            last = [counter.last]
        return df

    def plan(self, spark: SparkSession) -> dict[str, DataFrame]:
        """Per target, the final lazy DataFrame (for inspection / ``explain``)."""
        channels = {cid: self.channel(spark, cid) for cid in self.channel_ids()}
        out = {}
        for t in self.targets:
            ids = [i.strip() for i in t.ids.split(",") if i.strip()]
            df = union_sources(*[channels[i] for i in ids], allow_missing=self.allow_missing_columns)
            out[t.name] = df.transform(chain(*t.transforms))
        return out

    def run(self, spark: SparkSession) -> Report:
        report = Report()
        if self.count_steps and self.fanout == "persist":
            raise ValueError("steps are counted in the plan that writes a target; a kept channel is not part of it")
        channels = {cid: self.channel(spark, cid) for cid in self.channel_ids()}
        uses = {cid: sum(cid in [i.strip() for i in t.ids.split(",")] for t in self.targets) for cid in channels}
        cached = []
        for cid, df in channels.items():
            if uses[cid] > 1 and self.fanout == "persist":
                channels[cid] = df.persist(self.storage_level)
                cached.append(channels[cid])
        try:
            for t in self.targets:
                ids = [i.strip() for i in t.ids.split(",") if i.strip()]
                df = union_sources(*[channels[i] for i in ids], allow_missing=self.allow_missing_columns)
                df = df.transform(chain(*t.transforms))
                counter = StepCounter(t.name)
                if self.count_steps:
                    df = self._counted(spark, t, counter)
                observed, obs = observe_transfer(df, t.name, t.line_col)
                t0 = time.time()
                t.sink(observed)
                secs = time.time() - t0
                m = observed_metrics(obs, t.name)
                report.targets.append(TargetStats(t.name, int(m.get("rows", 0)), int(m.get("chars", 0)), secs))
                report.steps += counter.counts()
        finally:
            for df in cached:
                df.unpersist()
        return report
