"""Fan-out of a stream: every target gets each micro-batch once, also when one is replayed."""

import pytest
from pyspark.sql import functions as F

from sluice.sinks import publish as P
from sluice.streaming import stream as S


def source(spark, outdir, n=3):
    for i in range(n):
        spark.range(10 * i, 10 * i + 10).select(F.col("id").alias("k"), (F.col("id") % 2).alias("p")).coalesce(1).write.mode("append").parquet(f"{outdir}/in")
    return S.read_table_stream(spark, f"{outdir}/in", "k long, p long", max_files_per_trigger=1)


def once(spark, path, upto):
    return sorted(r.k for r in spark.read.parquet(path).collect()) == list(range(upto))


class Stop(Exception):
    pass


@pytest.mark.parametrize("partitioned", [(), ("p",)])
def test_a_stop_between_two_targets_repeats_neither(spark, outdir, partitioned):
    df, seen, broken = source(spark, outdir), [], [True]

    def second(batch):
        if broken and batch.where("k >= 10 AND k < 20").count():
            broken.clear()
            raise Stop
        seen.extend(r.k for r in batch.collect())

    targets = [S.file_target("files", f"{outdir}/a", partition_cols=partitioned), S.sink_target("second", second), S.file_target("third", f"{outdir}/c")]
    run = lambda: S.start(df, targets, "stop", checkpoint=f"{outdir}/ckpt").awaitTermination(120)
    with pytest.raises(Exception, match="Stop"):
        run()
    assert once(spark, f"{outdir}/a", 20) and sorted(seen) == list(range(10)) and once(spark, f"{outdir}/c", 10)
    run()
    assert once(spark, f"{outdir}/a", 30) and sorted(seen) == list(range(30)) and once(spark, f"{outdir}/c", 30)
    run()  # nothing new
    assert once(spark, f"{outdir}/a", 30)


@pytest.mark.parametrize("at", range(5))
def test_a_replay_finishes_what_a_killed_target_has_begun(spark, outdir, monkeypatch, at):
    """One epoch moves: the manifest, one file, the ledger's entry; the next epoch again."""
    df = source(spark, outdir, 2)
    real, made = P.Folder.move, []

    def move(self, old, new):
        if len(made) == at:
            raise Stop
        made.append(new)
        real(self, old, new)

    run = lambda: S.start(df, [S.file_target("files", f"{outdir}/a")], "kill", checkpoint=f"{outdir}/ckpt").awaitTermination(120)
    monkeypatch.setattr(P.Folder, "move", move)
    with pytest.raises(Exception, match="Stop"):
        run()
    monkeypatch.setattr(P.Folder, "move", real)
    run()
    assert once(spark, f"{outdir}/a", 20)
    assert not P.Folder(spark, f"{outdir}/a").entries(P.HIDDEN)


def test_a_batch_that_is_forced_again_is_skipped(spark, outdir):
    ledger = S.Ledger(spark, f"{outdir}/ledger")
    seen = []
    write = S.fan_out([S.file_target("a", f"{outdir}/a"), S.sink_target("b", lambda d: seen.append(d.count()))], ledger)
    batch = spark.range(5).select(F.col("id").alias("k"))
    for epoch in (0, 0, 1, 1, 0):
        write(batch, epoch)
    assert spark.read.parquet(f"{outdir}/a").count() == 10 and seen == [5, 5]
    assert ledger.last("a", "query") == 1 and ledger.last("c", "query") == -1
    with pytest.raises(ValueError):
        S.fan_out([S.sink_target("x", print), S.sink_target("x", print)])
