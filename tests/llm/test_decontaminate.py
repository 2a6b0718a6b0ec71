"""Decontamination against a plain search."""

import slow_versions as brute
import pytest

from laneflow.llm import decontaminate as d
from laneflow.llm import queries
from laneflow.llm.store import read

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, items string"


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, "mine") for i, t in docs], DOCS), spark.createDataFrame(items, "item_id long, text string"))


def got(df):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()}


EDGES = [(1, None), (2, ""), (3, " .,"), (4, "One two THREE four"), (5, "a b c d e f g h i j k"), (6, "x " * 5000 + "a b c d e f g h i j"),
         (7, "é é é one two three four five"), (8, "a b c d e f g h i j k l m a b c d e f g h i j"), (9, "two,three;two three"), (10, "a b c d e\nf g h i\nj k")]
ITEMS = [(1, "a b c d e f g h i j k l"), (2, "two three"), (3, None), (4, ""), (5, "É É é one"), (11, "A B C D E F G H I J"), (11, "two three four")]


@pytest.mark.parametrize("block", [1, 1 << 20])
def test_edges(spark, block):
    docs, items = frames(spark, EDGES, ITEMS)
    settings = d.PhraseSettings(block_bytes=block, shard_bytes=64)
    assert got(d.contamination(docs, items, settings)) == brute.contamination(EDGES, [x for x in ITEMS if x[1] is not None])


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    items = [(r.item_id, r.text) for r in read(spark, SF, "benchmark").collect()]
    expected = brute.contamination(rows, items)
    assert got(queries.op4_fm_index(spark, SF)) == expected
    assert any(x[4] for x in expected.values())


def test_empty_tables(spark):
    docs, items = frames(spark, EDGES, ITEMS)
    assert d.contamination(docs.limit(0), items).count() == 0
    assert {x[1] for x in got(d.contamination(docs, items.limit(0))).values()} == {0}


def test_cut(spark):
    docs, items = frames(spark, EDGES, ITEMS)
    found = {r.doc_id: r.text for r in d.cut(d.search(docs, items)).collect()}
    assert found[9] == "\n" and found[1] is None and found[2] == ""
    assert found[10] == "\n" and found[6].startswith("x x") and "a b" not in found[6]
    again = got(d.contamination(spark.createDataFrame(list(found.items()), "doc_id long, text string"), items))
    assert not any(x[4] for x in again.values())
