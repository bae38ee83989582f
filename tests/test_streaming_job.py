import os

from pyspark.sql import functions as F

from sluice.functions.template import time_column
from sluice.operators import process as P
from sluice.plans.job import Source, Target, TransferJob
from sluice.streaming.stream import read_text_stream, start

def chain_under_test():
    return P.chain(P.split_line(["id", "kind", "ts"], "|"), P.filter_row("kind = 'b'"),
                   P.add_field("dt", time_column(F.to_timestamp("ts"), "yyyyMMdd", "-1d"), after="kind"),
                   P.line_to_json(["id", "dt"], [0, 2]))


def test_stateless_chain_stream_equals_batch(spark, outdir):
    src = outdir.replace("file:", "") + "/in"
    os.makedirs(src, exist_ok=True)
    with open(os.path.join(src, "f1.txt"), "w") as f:
        f.write("1|a|2024-01-02 00:00:00\n2|b|2024-01-03 10:00:00\n3|b|2024-03-01 00:00:00\n")
    chain = chain_under_test()
    batch = sorted(r.value for r in spark.read.text(src).transform(chain).collect())
    got = []
    q = start(read_text_stream(spark, src).transform(chain),
              [lambda d: got.extend(r.value for r in d.collect())], name="parity",
              checkpoint=outdir + "/ckpt")
    q.awaitTermination(120)
    assert sorted(got) == batch == ['{"id":"2","dt":"20240102"}', '{"id":"3","dt":"20240229"}']


def test_transfer_job_fanout_and_report(spark, outdir):
    df = spark.range(100).select(F.col("id").cast("string").alias("v"))
    written = {}
    job = TransferJob(
        sources=[Source("1", lambda s: df.filter("v < '5'")), Source("ALL", lambda s: df.limit(0)),
                 Source("2", lambda s: df)],
        input_transforms=[P.add_field("w", "concat(v, 'x')")],
        targets=[Target("a", "1", lambda d: written.setdefault("a", d.count())),
                 Target("b", "1,2", lambda d: written.setdefault("b", d.count()))])
    rep = job.run(spark)
    assert written["a"] == df.filter("v < '5'").count()
    assert written["b"] == written["a"] + 100
    assert [t.rows for t in rep.targets] == [written["a"], written["b"]]
    assert "total:" in str(rep)
