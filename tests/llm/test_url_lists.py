"""URL filters against their SQL, and their edges."""

import datetime as dt

import compare

from laneflow.llm import queries, url_lists

SF = "/root/testdata/sf0.01"
DAY = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_sql(spark):
    df = queries.op7_url_lists(spark, SF)
    assert compare.differences(df, compare.connect(SF), url_lists.SQL) == []
    assert df.where("blocked").count() and df.where("not blocked and n_active > 0").count()


ENTRIES = [("spam", "host", "a.b.com", False, "add", DAY(10)), ("spam", "host", "a.b.com", False, "remove", DAY(20)), ("spam", "host", "a.b.com", False, "add", DAY(300)),
           ("bad", "domain", "b.com", False, "add", DAY(15)), ("good", "prefix", "a.b.com/x", True, "add", DAY(16)), ("good", "prefix", "a.b.com/x", True, "remove", DAY(16)),
           ("good", "prefix", "a.b.com/x", True, "add", DAY(17)), ("bad", "host", "c.org", False, "remove", DAY(1)), ("bad", None, None, False, "add", DAY(1)), ("bad", "host", "d.org", False, "add", None)]


def verdicts(spark, captures, entries=ENTRIES):
    valid = url_lists.intervals(spark.createDataFrame(entries, "list string, kind string, key string, allows boolean, action string, dated date"))
    df = spark.createDataFrame([(i, *c, "x") for i, c in enumerate(captures)], "id int, url string, fetched_on date, blocked string")
    return [(r.blocked, r.n_active, r.decided_by) for r in url_lists.judge(df, valid).orderBy("id").collect()]


def test_as_of(spark):
    url = "http://u@A.b.com:80/x/y?q#f"
    assert verdicts(spark, [(url, DAY(n)) for n in (9, 10, 14, 15, 16, 17, 19, 20, 299, 300, 5000)]) == [
        (False, 0, None), (True, 1, "spam"), (True, 1, "spam"), (True, 2, "spam"), (True, 2, "spam"), (False, 3, "good"), (False, 3, "good"), (False, 2, "good"),
        (False, 2, "good"), (False, 3, "good"), (False, 3, "good")]


def test_edges(spark):
    rows = [(None, DAY(20)), ("", DAY(20)), ("no url", DAY(20)), ("http://a.b.com/", None), ("https://b.com", DAY(20)), ("https://ab.com", DAY(20)),
            ("https://b.com", DAY(20)), ("http://c.org/", DAY(20)), ("http://a.b.com/" + "x/" * 50000, DAY(20))]
    no = (False, 0, None)
    assert verdicts(spark, rows) == [no, no, no, no, (True, 1, "bad"), no, (True, 1, "bad"), no, (False, 2, "good")]
    assert verdicts(spark, rows, []) == [no] * len(rows)
    assert verdicts(spark, []) == []


def test_any_depth(spark):
    """Entries of any number of path parts or labels are found."""
    entries = [("deep", "prefix", "a.com/1/2/3/4", False, "add", DAY(0)), ("zone", "domain", "zip", False, "add", DAY(0)),
               ("long", "domain", "e.d.c.b.a.org", False, "add", DAY(0))]
    urls = ["http://a.com/1/2/3/4/x", "http://a.com/1/2/3/4", "http://a.com/1/2/3", "http://evil.zip/", "http://zip/", "http://x.e.d.c.b.a.org", "http://d.c.b.a.org"]
    assert [v[2] for v in verdicts(spark, [(u, DAY(5)) for u in urls], entries)] == ["deep", "deep", None, "zone", "zone", "long", None]
