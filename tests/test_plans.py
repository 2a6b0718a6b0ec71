"""What the physical plans must and must not hold, and the whole way from boxes to events."""

import os
import re

import pytest
from pyspark.sql import functions as F

from laneflow import app, schemas
from laneflow.config import HISTORY_MIN_ROWS
from laneflow.operators import blocks, detections, tracker, trajectories, tripwires
from laneflow.plans import queries, views
from laneflow.sources.cameras import cameras_dim, positions_calibrated
from laneflow.streaming import sinks

SF = "/root/testdata/sf0.001"


def initial_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]


def hash_exchanges(plan):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


def test_questions_read_only_what_they_need(spark):
    plan = initial_plan(queries.q3_speed_violations(spark, SF))
    assert re.search(r"ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>", plan)
    stored = queries.measured(spark, SF)
    assert "BatchEvalPython" not in initial_plan(queries.q6_log(spark, SF))
    assert len(hash_exchanges(initial_plan(queries.q6_log(spark, SF)))) == 1
    assert stored.schema["event_time"].dataType.simpleString() == "timestamp"


def test_filters_reach_the_stored_table(spark, folder):
    queries.resolved_events(spark, SF).write.partitionBy("camera_name").parquet(folder + "/events")
    stored = spark.read.parquet(folder + "/events").filter("speed_kmh > 130 and camera_name = 'IC_Papagou'")
    plan = initial_plan(stored.select("vehicle_id"))
    assert "GreaterThan(speed_kmh,130.0)" in plan
    assert re.search(r"PartitionFilters: \[isnotnull\(camera_name#\d+\), \(camera_name#\d+ = IC_Papagou\)\]", plan)
    assert "ReadSchema: struct<vehicle_id:string,speed_kmh:double>" in plan


def test_only_the_cameras_are_broadcast(spark):
    plan = final_plan(queries.positions_calibrated(spark, SF))
    assert plan.count("BroadcastExchange") == 1 and "BuildRight" in plan and "LocalTableScan" in plan
    assert "Exchange hashpartitioning" not in plan


def test_large_camera_tables_are_not_broadcast(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
        plan = initial_plan(positions_calibrated(views.track_positions(spark, SF), cameras_dim(spark)))
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.parametrize("name", ["resolved_events", "resolved_prefer_tripwire", "tripwire_crossings", "tripwire_speeds", "tripwire_speeds_y",
                                  "displacement_speeds", "movement", "bev_speeds", "position_labels", "vehicle_report", "run_summary",
                                  "measured_vehicle_ids"])
def test_tracks_are_read_twice(spark, name):
    """Once for the rows and once for the summaries of blocks, in the plan as it is before anything has run."""
    plan = initial_plan(queries.QUERIES[name](spark, SF))
    assert plan.count("FileScan parquet") == 2, plan
    rows = [keys for keys in hash_exchanges(plan) if "_block" in keys]
    assert len(rows) <= 2 and "SortMergeJoin" not in plan
    assert "SinglePartition" not in plan or name == "run_summary"


def test_long_tracks_spread_over_blocks(spark):
    """The rows of a track are exchanged by block, never by track alone; by track go the summaries."""
    plan = initial_plan(queries.resolved_events(spark, SF))
    for keys in hash_exchanges(plan):
        assert "_block" in keys or "track_id" in keys
    by_track = [line for line in plan.splitlines() if "Window" in line and "_block" in line]
    assert by_track


@pytest.mark.parametrize("name,scans", [("activity_snapshot", 3), ("snapshot_speed_list", 3), ("alert_numbering", 3), ("session_totals", 3), ("vehicle_class", 4)])
def test_scans(spark, name, scans):
    """What is added up or read again is stored before: these plans read narrow tables, not the events."""
    plan = initial_plan(queries.QUERIES[name](spark, SF))
    assert plan.count("FileScan parquet") <= scans, plan
    if name in ("activity_snapshot", "snapshot_speed_list", "alert_numbering"):
        assert "events.parquet" not in plan


def test_no_window_without_a_key_over_rows(spark):
    """Numbering runs inside ranges of the order; what goes before them is a small table of their sizes."""
    plan = initial_plan(queries.alert_numbering(spark, SF))
    assert "SinglePartition" not in plan
    windows = re.findall(r"Window \[.*", plan)
    assert windows and all("windowspecdefinition(_range#" in w for w in windows)


def test_numbers_with_one_far_off_are_dealt_evenly(spark):
    """2000 numbers and one at 1e15: the ranges are as many as partitions, and none holds most of the rows."""
    for far in (10**15, -(10**15)):
        df = spark.range(2000).unionByName(spark.createDataFrame([(far,)], "id long")).repartition(3)
        got = blocks.numbered(df, "id", "n")
        assert [r.n for r in got.orderBy("id").collect()] == list(range(1, 2002))
        before = spark.conf.get("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            sizes = df.repartitionByRange("id").groupBy(F.spark_partition_id()).count().collect()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", before)
        assert len(sizes) == 4 and max(r["count"] for r in sizes) < 1000
    odd = spark.createDataFrame([(5,), (None,), (3,)], "id long")
    assert {r.id: r.n for r in blocks.numbered(odd, "id", "n").collect()} == {None: 1, 3: 2, 5: 3}
    assert blocks.numbered(odd.limit(0), "id", "n").collect() == []


def test_python_only_where_needed(spark):
    """Of the queries on tables only the walk of the tracker runs Python, in one step; what is read after it is stored."""
    for name, query in queries.QUERIES.items():
        if name.startswith("stream_") or name == "live_events":
            continue
        plan = initial_plan(query(spark, SF))
        assert not re.search("Pandas|EvalPython|InArrow", plan), name
    walk = initial_plan(tracker.walk_blocks(queries.centred(spark, SF), tracker._Walk(1024, 180, 12), 256))
    assert re.findall(r"\w*(?:Pandas|EvalPython|InArrow)", walk) == ["FlatMapGroupsInArrow"]


def test_boxes_to_events(spark, folder):
    """One car from left to right: tracked, classed, timed and stored."""
    boxes = [("IC_Papagou", f, 0, 700 + 8 * f, 100, 120, 80, 8000.0, None) for f in range(1, 60)]
    boxes += [("IC_Papagou", f, 1, 300, 400, 10, 10, 100.0, None) for f in range(1, 60)]      # too small
    spark.createDataFrame(boxes, schemas.DETECTIONS).write.parquet(folder + "/boxes")
    app.main(spark, ["events", "--boxes", folder + "/boxes", "--work", folder + "/work", "--out", folder + "/events"])
    event, = sinks.read_table(spark, folder + "/events", schemas.VEHICLE_EVENTS_TABLE).collect()
    assert (event.camera_name, event.vehicle_id, event.vehicle_type, event.direction, event.movement,
            event.speed_source, event.speed_kmh) == (
        "IC_Papagou", "R0", "truck", "to_Mesogeia_Vrilissia", "right", "displacement", 45.0)
    cameras = cameras_dim(spark)
    clean = detections.detections_clean(spark.read.parquet(folder + "/boxes"), cameras)
    tracks = tracker.assign_tracks(clean, last_frame=59)
    calibrated = positions_calibrated(detections.vehicle_class(tracks, clean), cameras)
    lines = trajectories.resolved_events(calibrated, policy="prefer_tripwire")
    assert [r.speed_source for r in lines.collect()] == ["displacement"]                     # starts beyond line 1
    step, = tripwires.tripwire_crossings(calibrated).collect()
    assert (step.previous, step.current, step.crossed_1, step.crossed_2) == (1192, 1200, False, True)


def moving_car(spark, frames):
    rows = [("IC_Papagou", f, 0, 700 + 8 * f, 100, 120, 80, 8000.0, None) for f in range(1, frames + 1)]
    return spark.createDataFrame(rows, schemas.DETECTIONS)


def test_a_second_attempt_replaces_the_first(spark, folder):
    """The same files again leave each event, alert and message once; further files are a run of their own."""
    moving_car(spark, 59).write.parquet(folder + "/boxes")
    command = ["events", "--boxes", folder + "/boxes", "--work", folder + "/work", "--out", folder + "/events",
               "--alerts", folder + "/alerts", "--topics", folder + "/topics"]
    app.main(spark, command)
    messages = spark.read.text(folder + "/topics").count()
    app.main(spark, command)
    table = sinks.read_table(spark, folder + "/events", schemas.VEHICLE_EVENTS_TABLE)
    assert (table.count(), spark.read.text(folder + "/topics").count()) == (1, messages)
    moving_car(spark, 59).write.mode("append").parquet(folder + "/boxes")
    assert app.run_number(spark.read.parquet(folder + "/boxes")) != table.first().batch_id >= app.FIRST_RUN


def test_live_command_ends_a_feed(spark, folder):
    """The event of the last frame comes when the feed's end arrives."""
    moving_car(spark, HISTORY_MIN_ROWS).write.parquet(folder + "/boxes")
    ends = "camera_name string, side string"
    spark.createDataFrame([], ends).write.parquet(folder + "/ends")
    command = ["live", "--boxes", folder + "/boxes", "--work", folder + "/work", "--out", folder + "/events", "--ends", folder + "/ends"]
    counts = []
    for row in (None, ("IC_Papagou", "R")):
        if row:
            spark.createDataFrame([row], ends).write.mode("append").parquet(folder + "/ends")
        app.main(spark, command)
        counts.append(sinks.read_table(spark, folder + "/events", schemas.VEHICLE_EVENTS_TABLE).count())
    assert counts == [0, 1]


def test_latest_answers_take_two_slots(spark, folder):
    write = sinks.latest_sink(folder)
    for batch in (0, 1, 2, 3, 4, 4):
        write(spark.createDataFrame([(batch, "x")] * (batch + 1), "n int, slot_name string"), batch)
        answer = sinks.read_latest(spark, folder, spark.createDataFrame([], "n int, slot_name string").schema)
        assert answer.columns == ["n", "slot_name"] and [r.n for r in answer.collect()] == [batch] * (batch + 1)
    assert sorted(f for f in os.listdir(folder) if f.startswith("slot")) == ["slot=0", "slot=1"]


def test_report_command(spark, folder):
    views.tracked_boxes(spark, SF).write.parquet(folder + "/boxes")
    app.main(spark, ["report", "--boxes", folder + "/boxes", "--out", folder + "/report"])
    written = spark.read.option("header", True).csv(folder + "/report")
    assert written.count() == queries.vehicle_report(spark, SF).count() > 0
