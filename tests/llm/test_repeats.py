"""Repeated bytes against all strings."""

import random
from collections import Counter

import slow_versions as brute
import numpy as np
import pytest

from laneflow.llm import queries
from laneflow.llm import repeats as r
from laneflow.llm.bwt_merge import Shard, least_owners, merge
from laneflow.llm.store import read

SF = "/root/testdata/sf0.001"


def got(df):
    return {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in df.collect()}


@pytest.mark.parametrize("seed", range(10))
def test_merge_finds_repeated_intervals(seed):
    """Every string of the depth that stands twice, in merged order, whatever the shards."""
    rng = np.random.default_rng(seed)
    depth, shards, texts = 6, [], []
    for _ in range(1 + seed % 4):
        sizes = rng.integers(1, 15, rng.integers(1, 12))
        body = rng.integers(97, 99, sizes.sum()).astype(np.uint8)
        shards.append(Shard(body, sizes, depth))
        ends = np.cumsum(sizes)
        texts += [body[e - n:e].tobytes() for e, n in zip(ends, sizes)]
    place, block = merge(shards, depth)
    found, base = [], np.cumsum([0, *[len(s.order) for s in shards]])
    for g in place:
        shard = int(np.searchsorted(base, g, side="right")) - 1
        at = shards[shard].order[g - base[shard]]
        found.append(bytes(shards[shard].symbols[at:at + depth] - 2))
    grams = Counter(t[i:i + depth] for t in texts for i in range(len(t) - depth + 1))
    assert found == sorted(g for g, n in grams.items() if n > 1 for _ in range(n))
    assert [a == b for a, b in zip(block, block[1:])] == [a == b for a, b in zip(found, found[1:])]


@pytest.mark.parametrize("seed", range(10))
def test_least_owners(seed):
    rng = np.random.default_rng(seed)
    strings = list({bytes(rng.integers(97, 99, rng.integers(8, 15)).astype(np.uint8)) for _ in range(40)})
    owners, length = rng.permutation(len(strings)), 8
    table = least_owners(np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings]), owners, length, 60)
    for k, s in enumerate(strings):
        for i in range(len(s) - length + 1):
            assert table[k, i] == min(o for t, o in zip(strings, owners) if s[i:i + length] in t)


def test_whole_table(spark):
    rows = [(x.doc_id, x.text) for x in read(spark, SF, "documents").collect()]
    expected = brute.repeats(rows)
    assert got(queries.op8_bwt_merge(spark, SF)) == expected
    assert sum(x[1] for x in expected.values()) > 1000


@pytest.mark.parametrize("seed", range(4))
def test_shared_passages(spark, seed):
    """Copies with changes, passages inside passages, few symbols, and long runs of one symbol."""
    rng = random.Random(seed)
    letters = ["ab", "abcdefgh ", "aé日", "a"][seed]
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [text(rng.randrange(20, 200)) for _ in range(8)]
    docs = []
    for i in rng.sample(range(1000), 60):
        parts = [rng.choice(shared) if rng.random() < 0.5 else text(rng.randrange(60)) for _ in range(rng.randrange(5))]
        body = list("".join(parts))
        if body and rng.random() < 0.5:
            body[rng.randrange(len(body))] = "x"
        docs.append((i, "".join(body)))
    settings = r.RepeatSettings(length=24, gram=8, block_bytes=800, part_bytes=500, shard_bytes=300)
    found = r.digest(r.repeated_bytes(spark.createDataFrame([(*d, 7) for d in docs], "doc_id int, text string, spans int"), settings))
    assert got(found) == brute.repeats(docs, 24)


def test_edges(spark):
    long = "".join(map(str, range(100_000)))
    docs = [(1, None), (2, ""), (3, "x" * 49), (4, "y" * 50), (5, "y" * 50), (6, "y" * 51), (7, long), (8, long[1000:-1000]), (9, "\x00" * 60), (10, "\x00" * 200), (-1, "é" * 25), (0, "é" * 30)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(r.digest(r.repeated_bytes(df))) == brute.repeats(docs)
    both = df.unionByName(df.where("doc_id = 5")).unionByName(spark.createDataFrame([(None, "y" * 80)], "doc_id long, text string"))
    out = r.digest(r.repeated_bytes(both)).collect()
    assert sorted(x.n_removed for x in out if x.doc_id == 5) == [50, 50]
    assert [x.n_removed for x in out if x.doc_id is None] == [0] and [x.n_removed for x in out if x.doc_id == 6] == [51]
    assert r.repeated_bytes(df.limit(0)).count() == 0


def test_blocks_are_exchanged_once(spark):
    """The step that reads the strings and the last one share the exchange of blocks and places."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.createDataFrame([(i, "the same long text in every one of the documents, word for word " * 2) for i in range(20)], "doc_id long, text string")
        out = r.repeated_bytes(docs)
        assert sum(len(row.spans) for row in out.collect()) == 19
        assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
