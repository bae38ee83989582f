"""Connected components against union-find, and the number of jobs that they take."""

import random

import pytest

from sluice.llm import graph


def _brute_force(links):
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    return {x: top(x) for x in root}


def _links():
    rng = random.Random(3)
    path = [(i, i + 1) for i in range(300)]
    shuffled = rng.sample(range(1000, 1300), 300)
    some = [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(150)]
    links = [*path, *zip(shuffled, shuffled[1:]), *some, *[(5000, 5001 + i) for i in range(50)], (7, 7), (9000, 9000), (-4, 1 << 40), (2, 1)]
    rng.shuffle(links)
    return [*links, (None, 3), (4, None)]


@pytest.mark.parametrize("chunk", [1 << 20, 16])
def test_connected_components(spark, chunk, monkeypatch):
    monkeypatch.setattr(graph, "CHUNK", chunk)
    links = _links()
    found = graph.connected_components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()
    want = _brute_force([x for x in links if None not in x])
    assert len(found) == len(want) and {r.node: r.comp for r in found} == want


def test_connected_components_without_links(spark):
    empty = graph.connected_components(spark.createDataFrame([(3, 3)], "a long, b long"))
    assert empty.collect() == [] and empty.columns == ["node", "comp"]


def test_connected_components_take_few_jobs(spark):
    """Each job leaves garbage and threads in the driver: a long path took one hook and many jumps, each with a job that counts."""
    context = spark.sparkContext
    path = spark.createDataFrame([(i, i + 1) for i in range(3000)], "a long, b long").repartition(4).localCheckpoint()
    context.setJobGroup("components", "")
    try:
        found = graph.connected_components(path)
        jobs = len(context.statusTracker().getJobIdsForGroup("components"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert found.where("comp = 0").count() == 3001
    assert 0 < jobs <= 20
