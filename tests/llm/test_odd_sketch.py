"""Near-dedup against all pairs."""

import random

import slow_versions as brute
import pytest

from laneflow.llm import odd_sketch as o
from laneflow.llm import queries
from laneflow.llm.store import read

SF = "/root/testdata/sf0.001"


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    assert got(queries.op1_odd_sketch(spark, SF)) == brute.near(rows)


def family(seed, groups=6, size=30, words=80):
    """Copies, chains of small changes, and groups whose members are just too far apart."""
    rng = random.Random(seed)
    rows, at = [], 0
    for g in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(words)]
        for k in range(size):
            text = list(base)
            for _ in range([0, 1, 2, 4, 5, 6][g % 6]):
                text[rng.randrange(words)] = f"v{rng.randrange(5000)}"
            if g % 2:
                base = text if k % 3 == 0 else base
            rows.append((at, " ".join(text)))
            at += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("small,words,percent", [(24, 3, 85), (2, 5, 80)])
def test_groups(spark, small, words, percent):
    """Also where nearly every bucket is a large one, compared in blocks."""
    rows = family(small)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    settings = o.NearSettings(small=small, block=8, words=words, percent=percent)
    assert got(o.near_duplicates(docs, settings)) == brute.near(rows, words, percent)


EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "ONE"), (6, "one two"), (7, "two one"), (8, "one  two"), (9, "a b c"), (10, "A B\nC"),
         (11, "w " * 4000), (12, "w w w"), (13, " ".join(str(i) for i in range(30000))), (14, " ".join(str(i) for i in range(29000)))]


def test_edges(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in [*EDGES, (9, "a b c"), (None, "a b c")]], "doc_id long, text string, component_id string, n int")
    found = got(o.near_duplicates(docs))
    assert found.pop(None) == (1, None, True)
    assert found == brute.near(EDGES)
    kept = o.keep_first(docs)
    assert kept.columns == docs.columns
    assert {1, 2, 3, 4, 6, 7, 9, 11, 12, 13, None} == {r.doc_id for r in kept.collect()}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert o.near_duplicates(docs).count() == 0


def test_estimate_is_close():
    """The population count of two sketches speaks for the share of equal samples."""
    s = o.NearSettings()
    for share in (0.95, 0.9, 0.85):
        unequal = s.bands * s.rows * (1 - share)
        apart = s.bits / 2 * (1 - 2.718281828 ** (-4 * unequal / s.bits))
        assert abs(o.estimate(apart, s) - share) < 0.01
    assert o.estimate(s.most_bits, s) < s.percent / 100 - 0.1
