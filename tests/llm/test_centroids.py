"""Clustering in exact integers: against plain Python, SQL, huge and odd vectors."""

import compare
import numpy as np
import pytest
import slow_versions as brute

from laneflow.llm import centroids as c
from laneflow.llm import queries
from laneflow.llm.store import read

SF = "/root/testdata/sf0.001"
COLUMNS = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def rows(df):
    assert df.columns == list(COLUMNS)
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, data, kind="double"):
    return spark.createDataFrame(data, f"vec_id long, embedding array<{kind}>")


def test_query(spark):
    given = [(r.vec_id, r.embedding) for r in read(spark, SF, "embeddings").collect()]
    assert rows(queries.op11_tournament(spark, SF)) == sorted(brute.cluster(given), key=str)


def test_sql(spark):
    assert compare.differences(queries.op11_tournament(spark, SF), compare.connect(SF), c.SQL) == []


def test_tournament_is_the_nearest_centroid():
    rng = np.random.default_rng(3)
    centers, x = rng.integers(-3, 4, (9, 3)), rng.integers(-4, 5, (3000, 3))  # many ties
    best, apart = c.Bisectors(centers.tolist()).nearest(x)
    all_ = ((x[:, None] - centers[None]) ** 2).sum(axis=2)
    assert (best == all_.argmin(axis=1)).all() and (apart == all_.min(axis=1)).all()


@pytest.mark.parametrize("size", [1.0, 1e5, 1e7, 1e18, 1e307])
def test_numbers_of_any_size(spark, size):
    rng = np.random.default_rng(5)
    settings = c.ClusterSettings(size=4, k=3)
    data = [(i, (rng.standard_normal(4) * (1 if i % 3 else size)).tolist()) for i in range(60)]
    assert rows(c.clustered(frame(spark, data).repartition(7), settings)) == sorted(brute.cluster(data, k=3, size=4), key=str)


def test_odd_rows(spark):
    settings = c.ClusterSettings(size=2, k=4)
    good = [(1, [0.5, -0.3]), (1, [0.5, -0.3]), (1, [2.0, 2.0]), (2, [0.0, 0.0]), (3, [5.0, -5.0]), (None, [1.0, 1.0]), (4, [-1.0, -0.001]), (5, [-1.0, -0.001])]
    bad = [(7, None), (8, []), (9, [1.0]), (10, [1.0, 2.0, 3.0]), (11, [None, 1.0]), (12, [float("nan"), 1.0]), (13, [float("-inf"), 1.0])]
    df = spark.createDataFrame([(*r, "x", 7, 1.0) for r in good + bad], "vec_id long, embedding array<double>, label string, cluster int, distance double")
    assert rows(c.clustered(df, settings)) == sorted(brute.cluster(good, k=4, size=2), key=str)
    assert rows(c.clustered(df, c.ClusterSettings(size=2, k=50))) == sorted(brute.cluster(good, k=50, size=2), key=str)
    assert rows(c.clustered(df.limit(0))) == [] and rows(c.clustered(frame(spark, bad))) == []


def test_copies_of_one_vector(spark):
    """A crowd of equal vectors: empty clusters keep their centroids, ties go to the smaller number."""
    data = [(i, [0.25] * 64) for i in range(300)] + [(1000 + i, [i / 64.0] * 64) for i in range(5)]
    assert rows(c.clustered(frame(spark, data, "float"))) == sorted(brute.cluster(data), key=str)
