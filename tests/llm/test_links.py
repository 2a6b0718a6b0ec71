"""Components against a plain union-find, and how many steps they and the operator above them start."""

import random

import pytest
from test_odd_sketch import family

from laneflow.llm import odd_sketch as o
from laneflow.llm.links import components


def plain(links):
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    return {x: top(x) for x in root}


def graphs():
    rng = random.Random(5)
    yield "none", []
    yield "loops", [(1, 1), (None, 2), (3, None)]
    yield "star, repeated", [(0, i % 40 + 1) for i in range(80)]
    yield "chain", [(i, i + 1) for i in range(200)]
    yield "largest is the hub", [(999, i) for i in range(60)] + [(998, i) for i in range(50, 90)]
    yield "mixed", [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(7, 7), (None, 7)]


@pytest.mark.parametrize("name,links", graphs())
def test_components(spark, name, links):
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(found) == len({r.id for r in found})
    assert {r.id: r.component_id for r in found} == plain(links)


def stages(spark, name, run):
    """Stages that ran meanwhile."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    infos = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(name) for s in tracker.getJobInfo(j).stageIds]
    return sum(i is not None and i.numCompletedTasks > 0 for i in infos)


def test_stars_need_no_round(spark):
    links = spark.createDataFrame([(0, i) for i in range(1, 50)], "a long, b long")
    assert stages(spark, "stars", lambda: components(links).collect()) <= 8


def test_crowds_start_few_steps(spark):
    docs = spark.createDataFrame(family(2), "doc_id long, text string")
    assert stages(spark, "crowds", lambda: o.near_duplicates(docs, o.NearSettings(small=2, block=8)).collect()) <= 115
