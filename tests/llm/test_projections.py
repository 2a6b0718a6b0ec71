"""Vectors against all pairs."""

import numpy as np
import pytest

from laneflow.llm import projections as p
from laneflow.llm import queries
from laneflow.llm.store import read

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def brute(rows, cosine=0.93):
    ok = [(i, np.array(v, np.float64), l) for i, v, l in rows if i is not None and l is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links, top = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for k, (i, v, l) in enumerate(ok):
        for j, w, m in ok[:k]:
            if l == m and len(v) == len(w) and i != j and v @ w / np.sqrt((v @ v) * (w @ w)) >= cosine:
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                top[b] = a
    return {i: (links[i], find(i) if i is not None else None) for i in links}


def got(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


def test_whole_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding, r.label) for r in read(spark, sf, "embeddings").where("label < 3").collect()]
    assert {k: v for k, v in got(queries.op5_projections(spark, sf)).items() if k in {r[0] for r in rows}} == brute(rows)


def clusters(seed, cosine=0.93):
    """Groups around centres, with many pairs close to the least similarity on both sides."""
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(12):
        centre = rng.standard_normal(48)
        for k in range(25):
            noise = rng.standard_normal(48) * [0.05, 0.2, 0.25, 0.3][g % 4]
            rows.append((len(rows), ((centre + noise) * rng.uniform(0.1, 9)).astype(np.float32).tolist(), g % 3))
    return rows


@pytest.mark.parametrize("block", [512, 6])
def test_recall(spark, block):
    rows = clusters(block)
    found = got(p.near_vectors(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA), p.CollisionSettings(block=block)))
    expected = brute(rows)
    assert all(found[i][0] <= expected[i][0] for i in found)
    total, lost = sum(x for x, _ in expected.values()), sum(expected[i][0] - found[i][0] for i in found)
    assert total > 1000 and lost <= 0.01 * total
    assert np.mean([found[i][1] == expected[i][1] for i in found]) > 0.97


EDGES = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [1.0, float("nan")], 1), (6, [1.0, 2.0], None), (7, [1.0, 2.0], None),
         (8, [1.0, 2.0], 1), (9, [2.0, 4.0], 1), (10, [1.0, 2.0, 0.0], 1), (11, [-1.0, -2.0], 1), (12, [float("inf"), 1.0], 1), (13, [1.0, 2.0], 2), (None, [1.0, 2.0], 1)]


def test_edges(spark):
    df = p.near_vectors(spark.createDataFrame([(*r, "x") for r in EDGES], SCHEMA))
    assert got(df) == brute(EDGES)
    assert {r.vec_id for r in df.collect() if not r.kept} == {9}


def test_empty_table(spark):
    assert p.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_rows(spark):
    """Equal rows are one vector; rows of one vec_id with different vectors have links of their own and one component."""
    rows = [(5, [1.0, 2.0], 1), (5, [1.0, 2.0], 1), (7, [1.0, 2.0], 1), (9, [1.0, 2.1], 1), (9, [-2.0, 1.0], 1), (3, [-2.0, 1.0], 1), (3, None, 1)]
    found = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in p.near_vectors(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).collect())
    assert found == [(3, 0, 3, True), (3, 1, 3, True), (5, 2, 3, False), (5, 2, 3, False), (7, 2, 3, False), (9, 1, 3, False), (9, 2, 3, False)]


def test_many_copies(spark):
    """Copies of one vector are one class: their number costs no comparisons."""
    n = 100_000
    df = spark.range(n).selectExpr("id as vec_id", "array(float(1), float(2), float(if(id = 7, 2.1, 3))) as embedding", "1 as label", "'x' as n_links")
    got = p.near_vectors(df).groupBy("n_links", "component_id").count().collect()
    assert [tuple(r) for r in got] == [(n - 1, 0, n)]


def test_windows_are_all_pairs_in_reach():
    at = np.array([0.0, 0.5, 0.5, 1.0, -3.0, 0.75])
    a, b = p._windows(at, 0.5)
    assert sorted(map(tuple, np.sort(np.stack([a, b], 1), axis=1).tolist())) == [
        (i, j) for i in range(6) for j in range(i + 1, 6) if abs(at[i] - at[j]) <= 0.5]
