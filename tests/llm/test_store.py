"""Tables between steps, and the map of bits before joins."""

import os
import subprocess
import sys

from laneflow.llm.store import may_hold


def test_a_plain_local_session_needs_no_setting(tmp_path):
    code = """
from laneflow.session import local_session
from laneflow.llm.store import table
spark = local_session(2, 2)
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert table(spark.range(7), "y").count() == 7
print("fine")
"""
    (tmp_path / "conf").mkdir()
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path / "conf"), "PYTHONPATH": here}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=200, cwd=tmp_path)
    assert done.returncode == 0 and "fine" in done.stdout, done.stderr[-2000:]


def test_rows_that_may_hold(spark):
    """All rows with a known id are among the first; both together are all rows, nulls and clashing names too."""
    rows = spark.createDataFrame([(i, "x", 1) for i in [*range(1000), None, 5]], "id long, _word string, _bits int")
    ids = spark.createDataFrame([(3,), (5,), (None,), (10**9,)], "k long")
    may, clear = may_hold(rows, "id", ids, "k")
    assert may.columns == clear.columns == rows.columns
    assert {3, 5} <= {r.id for r in may.collect()} and may.count() < 20
    assert may.count() + clear.count() == 1002 and not {3, 5} & {r.id for r in clear.collect()}
    none, all_ = may_hold(rows, "id", ids.limit(0), "k")
    assert none.count() == 0 and all_.count() == 1002
