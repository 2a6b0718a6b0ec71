"""The grammar, clause by clause, and held-out accuracy."""

import pytest

from laneflow.llm import queries
from laneflow.llm import toxicity as t
from laneflow.llm.store import read

SCORER = t.Scorer({"idiot": 1.0, "lowe*": 2.0})


@pytest.mark.parametrize("text,weights", [
    ("", []), ("a quiet text", []), ("What an idiot.", [1.0]), ("You idiot!", [1.3]), ("not an idiot", [0.5]), ("not in any of the ways idiot", [1.0]),
    ("He said idiot", [0.8]), ("she said: idiot", [1.0]), ("idiot. idiot; you idiot", [1.0, 1.0, 1.3]), ("an idiotic thing", []), ("loweich", [2.0]), ("yellowe", []),
    ("I will kill you", [2.3]), ("I kill time", []), ("they said you are not an idiot", [0.25 + 0.3]), ("idiot\nidiot", [1.0, 1.0]), ("IDIOT " * 3, [3.0])])
def test_clauses(text, weights):
    assert SCORER.clauses(text) == pytest.approx(weights)


def test_composition_is_the_cascade():
    """The composed machine gives what its parts give one after the other."""
    a = t.Transducer({(0, 1): (1, 2, 0.5), (1, 2): (0, 1, 1.0)}, {1: 0.25})
    b = t.Transducer({(0, 2): (1, 0, 2.0), (1, 1): (0, 2, 4.0)}, {1: 8.0})
    both = t.compose(a, b, range(3))
    for word in ([], [1], [1, 1], [1, 2, 1], [2, 1, 1, 2, 0], [0, 1, 2, 2, 1, 1]):
        s = p = q = 0
        total = expected = 0.0
        out, want = [], []
        for x in word:
            s, y, w = both.step(s, x)
            total += w
            out.append(y)
            p, m, u = a.step(p, x)
            q, z, v = b.step(q, m)
            expected += u + v
            want.append(z)
        assert out == want and total + both.ends[s] == expected + a.ends.get(p, 0) + b.ends.get(q, 0)


def test_held_out(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op2_grammar(spark, sf).join(read(spark, sf, "labels"), "doc_id").where("held_out").collect()
    good = sum(r.predicted == r.toxic for r in rows)
    # some rows of this table are labelled toxic without a toxic word
    assert good >= 0.97 * len(rows)
    assert sum(r.predicted for r in rows if not r.toxic) <= 0.01 * len(rows)
    assert sum(r.predicted for r in rows if r.toxic) >= 0.8 * sum(r.toxic for r in rows)


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (2, "", 1.0), (3, "idiot " * 20000, 1.0), (3, "idiot", 1.0), (None, "fine", 1.0)], "doc_id long, text string, weight double")
    for labels in ([], [(1, None), (3, 1), (3, 1), (None, 1), (7, 0)]):
        out = t.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
        assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
        by = {r.doc_id: r.score for r in out}
        assert by[3] > by[1] == by[2]
    assert t.toxicity(docs.limit(0), spark.createDataFrame([], "doc_id long, toxic int")).count() == 0


def test_rare_pure_words_are_learned(spark):
    """A word in 1 % of the toxic rows is learned, however many toxic rows there are; one that clean rows have too is not."""
    rows = [("a slurword here" if i >= 10 else "un zlurbo qui", 1) for i in range(1000)] + [("blinkum" if i < 2 else f"a fine {i} here", 0) for i in range(8000)]
    rows += [("some blinkum", 1) for _ in range(5)]
    lexicon = t.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert "zlurbo" in lexicon and "slurword" in lexicon
    assert not {"blinkum", "here", "fine"} & set(lexicon)
