"""Each stage on the rows that the one before has left, against a plain version, and the whole run."""

import slow_versions as brute
import corpus_pipeline as pipeline
import pytest
from test_sequences import check_pieces

from laneflow.llm.store import read, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = read(spark, SF, "documents"), {}
    for name, stage in pipeline.STAGES:
        before, docs = docs, table(stage(spark, docs, SF), name)
        out[name] = before, docs
    return out


def rows(df):
    return {r.doc_id: r.asDict() for r in df.collect()}


def test_names_and_columns(stages):
    assert [n for n, _ in pipeline.STAGES] == list(stages)
    for name in list(stages)[:-1]:
        before, after = stages[name]
        assert after.dtypes == before.dtypes
        lost = set(rows(before)) - set(rows(after))
        assert len(lost) < (0.05 if name in ("language", "decontamination") else 0.3) * before.count()


def test_language_keeps_rows_as_they_are(stages):
    before, after = map(rows, stages["language"])
    assert all(before[k] == v for k, v in after.items())


def test_lines(stages):
    before, after = map(rows, stages["line_dedup"])
    for doc, own in after.items():
        old = before[doc]["text"].split("\n")
        new = own["text"].split("\n")
        assert len(own["text"]) == own["n_chars"]
        it = iter(old)
        assert all(line in it for line in new), "lines come in the old order"


def test_near(stages):
    before, after = map(rows, stages["near_dedup"])
    expected = {d for d, (_, _, kept) in brute.near([(k, v["text"]) for k, v in before.items()], 5, 80).items() if kept}
    assert set(after) == expected and all(before[k] == v for k, v in after.items())


def test_benchmark(spark, stages):
    before, after = map(rows, stages["decontamination"])
    items = [(r.item_id, r.text) for r in read(spark, SF, "benchmark").collect()]
    old = brute.contamination([(k, v["text"]) for k, v in before.items()], items)
    new = brute.contamination([(k, v["text"]) for k, v in after.items()], items)
    assert set(after) == set(before) and not any(x[4] for x in new.values())
    for doc, own in after.items():
        assert own["text"] == before[doc]["text"] if not old[doc][4] else new[doc][0] == old[doc][0] - old[doc][1]


def test_packing(stages):
    before, after = stages["packing"]
    check_pieces(after.collect(), [(r.doc_id, r.text) for r in before.collect()], 2048)


def test_run(spark, stages):
    whole = pipeline.run(spark, SF)
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(whole.select(*key).collect()) == sorted(stages["packing"][1].select(*key).collect())


def test_odd_rows(spark):
    """Nulls in every column, extra columns, and an empty table go through all stages."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, `row` int, n_lines int"
    docs = [(1, None, None, None, None, None, None, None), (2, "", "en", "s", 0, "x", 1, 2), (3, "some words that are here", None, "s", 24, "x", 1, 2), (None, "more words", "en", None, 10, None, 4, 5)]
    for start in (docs, []):
        df = spark.createDataFrame(start, schema)
        for name, stage in pipeline.STAGES:
            df = table(stage(spark, df, SF), name)
        assert df.count() >= 0
