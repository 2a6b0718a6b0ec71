"""Every named query against its SQL on DuckDB, over whole tables."""

import pytest

import __spark_entry__ as contract
import compare
from laneflow.config import WINDOW_S
from laneflow.operators import questions
from laneflow.plans import queries

SF = "/root/testdata/sf0.001"
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    if name in SQL:
        assert compare.differences(df, duck, SQL[name]) == []
    else:
        assert df.count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["log_entry", "carriageway", "window_index", "avg_speed_kmh"]
    assert df.count() > 0


def test_stored_sketches_are_close(spark):
    rows = queries.measured(spark, SF)
    exact = {r.carriageway: r.vehicle_count for r in questions.q2_vehicles_per_lane(rows).collect()}
    got = {r.carriageway: r.vehicle_count for r in queries.q2_from_sketches(spark, SF).collect()}
    assert got.keys() == exact.keys() and all(abs(got[k] - exact[k]) <= 0.05 * exact[k] for k in exact)
    hours = questions.q5_vehicles_per_window(rows, window_s=12 * WINDOW_S)
    exact = {(r.carriageway, r.window_index): r.vehicle_count for r in hours.collect()}
    got = {(r.carriageway, r.span): r.vehicle_count for r in queries.q5_hours_from_sketches(spark, SF).collect()}
    assert got.keys() == exact.keys() and all(abs(got[k] - exact[k]) <= max(1, 0.05 * exact[k]) for k in exact)


def test_sketches_are_close(spark):
    rows = queries.measured(spark, SF)
    for ask, keys in ((questions.q2_vehicles_per_lane, ["carriageway"]), (questions.q5_vehicles_per_window, ["carriageway", "window_index"])):
        exact = {tuple(r[k] for k in keys): r.vehicle_count for r in ask(rows).collect()}
        for r in ask(rows, exact=False).collect():
            truth = exact[tuple(r[k] for k in keys)]
            assert abs(r.vehicle_count - truth) / truth <= queries.SKETCH_ERROR
