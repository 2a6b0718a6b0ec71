"""Line dedup against its SQL, and its edges."""

import random

import compare
import pytest

from laneflow.llm import line_chunks, queries

SF = "/root/testdata/sf0.001"


def test_sql(spark):
    df = queries.op10_line_chunks(spark, SF)
    assert compare.differences(df, compare.connect(SF), line_chunks.SQL) == []


ROWS = [(1, None), (2, ""), (3, "\n\n\n"), (4, "a\nb\nc\nd"), (5, "a\nb\nc\nd"), (6, "x\na\nb\nc\nd\ny"), (7, "a"), (8, "a"), (9, "\n".join("lines of a long text".split() * 3000)),
        (10, "a\nb\nc\nd"), (10, "a\nb\nc\nd")]


def test_edges(spark, tmp_path):
    docs = spark.createDataFrame([(i, t, "m") for i, t in ROWS], "doc_id long, text string, n_chunks string")
    out = line_chunks.line_dedup(docs).collect()
    text = {r.doc_id: r.text for r in out}
    assert len(out) == len(ROWS)
    assert text[1] is None and text[2] == "" and text[3] == "\n\n\n" and text[7] == text[8] == "a"
    assert text[4] == "a\nb\nc\nd"
    assert len(text[5]) < len(text[4]) and text[5] == text[10]
    assert len(text[9]) < len(ROWS[8][1])


def test_no_python(spark):
    plan = queries.op10_line_chunks(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert line_chunks.line_dedup(docs).count() == 0


@pytest.mark.parametrize("cut", [0, 3, 5])
def test_boundaries_do_not_shift(spark, cut):
    """Chunks inside a block are the same, whatever stands before it."""
    block = [f"line {i} of the block" for i in range(40)]
    docs = spark.createDataFrame([(1, "\n".join(block)), (2, "\n".join([f"other {i}" for i in range(cut)] + block))], "doc_id long, text string")
    out = {r.doc_id: r for r in line_chunks.line_dedup(docs).collect()}
    assert out[2].n_removed_lines >= 30 and out[1].n_removed_lines == 0


def plain_repeats(texts):
    """Texts by doc_id without repeated pairs of solid lines, one after the other."""
    seen, out = set(), {}
    for doc in sorted(texts):
        lines, gone = texts[doc].split("\n"), set()
        solid = [i for i, line in enumerate(lines) if line.strip(" ")]
        for at, last in zip(solid, solid[1:]):
            body = "\n".join(lines[at : last + 1])
            gone |= set(range(at, last + 1)) if body in seen else set()
            seen.add(body)
        out[doc] = "\n".join(line for i, line in enumerate(lines) if i not in gone)
    return {doc: text for doc, text in out.items() if text.strip(" \n\t\r") or not texts[doc].strip(" \n\t\r")}


def test_planted_passages_go_whole(spark):
    """Every passage over 50 words and of two lines or more goes, with its edges, wherever it stands."""
    passages = [[f"line {n} {i} of passage {p} " + f"word{p} " * (60 // n) for i in range(n)] for n in range(2, 12) for p in range(20)]
    texts = {}
    for k, passage in enumerate(passages):
        gap = ["", " "][: k % 3]
        body = [x for line in passage for x in (line, *gap)][: len(passage) * (1 + len(gap)) - len(gap)]
        texts[k] = "\n".join([f"first {k} {i}" for i in range(k % 4)] + body + [f"end {k}"])
        texts[1000 + k] = "\n".join([f"other {k} {i}" for i in range(k % 7)] + body + [f"after {k} {i}" for i in range(k % 5)] + [f"last {k}"])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = {r.doc_id: r.text for r in line_chunks.drop_repeats(docs).collect()}
    assert not [k for k, passage in enumerate(passages) if any(line in out[1000 + k].split("\n") for line in passage)]
    assert all(out[k] == texts[k] for k in range(len(passages)))


def test_repeats_are_the_plain_ones(spark):
    rng = random.Random(5)
    texts = {k: "\n".join(rng.choice(["a", "b", "c", "d", "e", "", " "]) for _ in range(rng.randrange(12))) for k in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = {r.doc_id: r.text for r in line_chunks.drop_repeats(docs).collect()}
    assert out == plain_repeats(texts)
    lines = lambda found: {line for text in found.values() for line in text.split("\n") if line.strip(" ")}
    assert lines(out) == lines(texts)


def test_repeats_of_nulls(spark):
    docs = spark.createDataFrame([(None, "a\nb"), (1, "a\nb\nx"), (2, None), (3, ""), (4, "\n\n"), (5, "a\nb")], "doc_id long, text string")
    out = {r.doc_id: r.text for r in line_chunks.drop_repeats(docs).collect()}
    assert out == {None: "a\nb", 1: "a\nb\nx", 2: None, 3: "", 4: "\n\n"}


def test_rows_without_id_are_no_first_place(spark):
    """As in SQL, which sorts them last: the first document with an id keeps the chunk, later ones lose it."""
    docs = spark.createDataFrame([(None, "x1\nx2"), (1, "x1\nx2"), (3, "x1\nx2")], "doc_id long, text string")
    assert {r.doc_id: r.n_removed_chunks for r in line_chunks.line_dedup(docs).collect()} == {None: 0, 1: 0, 3: 1}
    assert {r.doc_id for r in line_chunks.drop_repeats(docs).collect()} == {None, 1}


def test_chunks_are_the_seeds(spark):
    """The line stage finds a passage by its content-defined chunks; runs of lines are left to the edges."""
    block = [f"line {i} of the block" for i in range(40)]
    docs = spark.createDataFrame([(1, "\n".join(block)), (2, "\n".join(["x", "y", "z", *block, "end"]))], "doc_id long, text string")
    seeds = line_chunks._seeds(docs, line_chunks.ChunkSettings()).collect()
    found = sorted((r.run >> 31, r.run & (1 << 31) - 1) for r in seeds)
    assert {r.doc_id for r in seeds} == {2} and len(found) >= 15
    assert all(3 <= at and last == at + 1 < 43 for at, last in found)
    out = {r.doc_id: r.text for r in line_chunks.drop_repeats(docs).collect()}
    assert out == {1: "\n".join(block), 2: "x\ny\nz\nend"}


@pytest.mark.parametrize("lines", [4, 30])
def test_bytes_decide_not_hashes(spark, monkeypatch, lines):
    """With one hash for all, chunks and runs are still told apart."""
    monkeypatch.setattr(line_chunks.F, "xxhash64", lambda *columns: line_chunks.F.lit(7).cast("long"))
    monkeypatch.setattr(line_chunks.F, "sha2", lambda *columns: line_chunks.F.lit("00"))
    rng = random.Random(lines)
    texts = {k: "\n".join(rng.choice("abcdefgh") for _ in range(lines)) for k in range(20)}
    texts[20] = "x\n" + texts[3]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_chunks.drop_repeats(docs).collect()} == plain_repeats(texts)
