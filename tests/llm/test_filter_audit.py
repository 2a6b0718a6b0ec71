"""The audit of filters against a document-by-document version, and its SQL."""

import compare
import numpy as np
import slow_versions as brute

from laneflow.llm import filter_audit as f
from laneflow.llm import queries
from laneflow.llm.store import read

SF = "/root/testdata/sf0.001"


def rows(df):
    assert df.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    found = df.collect()
    out = {(r[0], r[1], r[2]): tuple(r[3:]) for r in found}
    assert len(out) == len(found)
    return out


def test_query(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in read(spark, SF, "documents").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in read(spark, SF, "labels").collect()]
    assert rows(queries.op13_filter_audit(spark, SF)) == brute.audit(docs, labels)


def test_sql(spark):
    assert compare.differences(queries.op13_filter_audit(spark, "/root/testdata/sf0.01"), compare.connect("/root/testdata/sf0.01"), f.SQL) == []


FAIR = " ".join(f"w{i}" for i in range(250))
ODD = [(1, FAIR, "en"), (2, FAIR, "en"), (3, FAIR, "de"), (3, FAIR, "en"), (None, FAIR, "en"), (None, FAIR, None), (9, None, None), (8, "", ""), (7, "", "en"), (5, None, "fr"),
       (4, "A" * 7, "en"), (6, "# " * 300, "en"), (10, " ".join("ab") + "\u0085 c", "en"), (11, "A é" * 100, "fr"), (12, "w\x0bw\x1cw " * 100000, "en"), (13, FAIR + " $", None),
       (13, FAIR, None), (14, FAIR.upper(), "de"), (15, "日本 " * 210, "de")]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (3, None, None), (None, 1, 1), (5, 1, 1), (77, 1, 1), (12, 1, 1)]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(*d, 1, "x", True) for d in ODD], "doc_id long, text string, lang string, mask int, part string, good boolean").repartition(5)
    labels = spark.createDataFrame([(*x, "y") for x in LABELS], "doc_id long, quality int, toxic int, lang string")
    assert rows(f.audit(docs, labels)) == brute.audit(ODD, LABELS)
    assert rows(f.audit(docs, labels.limit(0))) == brute.audit(ODD, [])
    assert rows(f.audit(docs.limit(0), labels)) == {}
    con = compare.connect(SF)
    con.execute("drop view documents; drop view labels; create table documents (doc_id bigint, text text, lang text); "
                "create table labels (doc_id bigint, quality int, toxic int)")
    con.executemany("insert into documents values (?, ?, ?)", ODD)
    con.executemany("insert into labels values (?, ?, ?)", LABELS)
    assert compare.differences(f.audit(docs, labels), con, f.SQL) == []


def test_contractions_are_sums_over_documents():
    counts = np.random.default_rng(1).integers(0, 50, (3, 2, 2, 2, 2, 2))
    own = f.contractions(counts)
    docs = [(at, int(counts[(0, *at)])) for at in np.ndindex(2, 2, 2, 2, 2)]
    assert own["kept"][0, 1] == sum(n for at, n in docs if not at[0] and not at[1])
    assert own["removed"][0, 2] == sum(n for at, n in docs if not at[0] and not at[1] and at[2])
    assert (own["shapley"].max(axis=1) >= 0).all() and own["removed"].shape == (120, 5)
    # what all five remove in one order is what fails any filter
    assert (own["removed"].sum(axis=1) == sum(n for at, n in docs if any(at))).all()
    assert own["shapley"][0].sum() == 120 * own["removed"][0].sum()
