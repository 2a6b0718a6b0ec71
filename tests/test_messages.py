"""Decoding, encoding, routing, the per-lane questions and the alerts, on hand-made rows."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from laneflow import schemas
from laneflow.functions.numbers import fixed_point, to_places
from laneflow.functions.text import ordinal
from laneflow.functions.timing import event_time
from laneflow.operators import alerts, questions
from laneflow.sources import feeds, messages
from laneflow.config import StreamSettings

GOOD = {"vehicle_id": "L3", "vehicle_type": "car", "speed_kmh": 97.25, "carriageway": "to_Elefsina",
        "segment": "cam", "timestamp_s": 312.48, "speed_source": "tripwire"}


def raw(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def events(spark, *rows):
    """(id, type, speed, lane, seconds)"""
    full = [(i, k, s, lane, "cam", t, "tripwire") for i, k, s, lane, t in rows]
    return messages.with_event_time(spark.createDataFrame(full, schemas.VEHICLE_EVENT))


def test_decode(spark):
    bad = ["not json", "null", "[1]", '{"speed_kmh":"135"}', '{"speed_kmh":"abc"}', '{"speed_kmh":null}', "{}", "", None]
    df = messages.decode_events(raw(spark, json.dumps(GOOD), '{"vehicle_id":12,"speed_kmh":50,"timestamp_s":-1.5}',
                                    *bad))
    rows = {r.vehicle_id: r for r in df.collect()}
    assert set(rows) == {"L3", "12"}
    assert rows["L3"].speed_kmh == 97.25 and rows["L3"].event_time == datetime(1970, 1, 1, 0, 5, 12)
    assert rows["12"].event_time == datetime(1969, 12, 31, 23, 59, 59)
    assert df.schema["speed_kmh"].dataType.simpleString() == "double"


def test_odd_times_do_not_end_the_job(spark):
    df = spark.createDataFrame([(float("nan"),), (1e60,), (None,), (300.9,), (1.5e11,), (-9.3e12,)], "t double")
    got = [r.e for r in df.select(F.unix_seconds(event_time(F.col("t"))).alias("e")).collect()]
    assert got == [None, None, None, 300, 150_000_000_000, None]


def test_event_time_ignores_the_session_zone(spark):
    df = events(spark, ("a", "car", 50.0, "x", 0.0), ("b", "car", 50.0, "x", 301.0), ("c", "car", 50.0, "x", 650.0))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "Europe/Athens"):
            spark.conf.set("spark.sql.session.timeZone", name)
            assert sorted(r.window_index for r in questions.q6_avg_speed(df).collect()) == [1, 2, 3]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_encode_keeps_all_fields_and_two_digits(spark):
    df = spark.createDataFrame([("L1", None, 130.001, "x", "cam", 2.675, "tripwire")], schemas.VEHICLE_EVENT)
    value = json.loads(messages.encode_events(df).first().value)
    assert list(value) == list(GOOD)
    assert (value["vehicle_type"], value["speed_kmh"], value["timestamp_s"]) == (None, 130.0, 2.67)


def test_route_and_consume_at_the_threshold(spark):
    df = spark.createDataFrame(
        [("a", "car", 130.0, "x", "cam", 0.0, "s"), ("b", "car", 130.001, "x", "cam", 0.0, "s"),
         ("c", "car", 129.99, "x", "cam", 0.0, "s"), ("d", "car", None, "x", "cam", 0.0, "s")], schemas.VEHICLE_EVENT)
    routed = messages.route_events(df)
    ids = {t: sorted(json.loads(r.value)["vehicle_id"] for r in routed.filter(F.col("topic") == t).collect())
           for t in ("traffic-stats", "traffic-alerts")}
    assert ids == {"traffic-stats": ["a", "b", "c", "d"], "traffic-alerts": ["b"]}
    # as messages, 130.001 has become 130.0; the consumer keeps both
    assert sorted(r.vehicle_id for r in alerts.q4_speed_alerts(messages.encode_events(df)).collect()) == ["a", "b"]


def test_alert_defaults_and_malformed(spark):
    feed = raw(spark, '{"speed_kmh":"135"}', '{"speed_kmh":1e60,"vehicle_id":"x"}', '{"speed_kmh":129.99}', "{}",
               '{"vehicle_type":null,"speed_kmh":140}', '{"vehicle_id":7,"speed_kmh":141}',
               "not json", "null", "[1, 2]", '[{"speed_kmh":200}]', '"text"', "", None, '{"speed_kmh":"abc"}',
               '{"speed_kmh":NaN}', '{"speed_kmh":Infinity}', '{"speed_kmh":140} tail', '{"speed_kmh":140')
    got = sorted((r.speed_kmh, r.vehicle_id, r.vehicle_type, r.direction, r.camera_name)
                 for r in alerts.q4_speed_alerts(feed).collect())
    assert got == [(135.0, "UNKNOWN", "vehicle", "?", "?"), (140.0, "UNKNOWN", "vehicle", "?", "?"),
                   (141.0, "7", "vehicle", "?", "?"), (1e60, "x", "vehicle", "?", "?")]
    bad = {r.value: r.reason for r in alerts.malformed_alerts(feed).collect()}
    assert len(bad) == 12
    assert {v for v, why in bad.items() if why == "speed is not a number"} == {
        '{"speed_kmh":"abc"}', '{"speed_kmh":NaN}', '{"speed_kmh":Infinity}'}


def test_violations(spark):
    df = events(spark, ("a", "truck", 80.0, "x", 0.0), ("b", "truck", 80.01, "x", 0.0), ("c", "car", 90.0, "x", 0.0),
                ("d", "bus", 90.01, "x", 0.0), ("e", None, 200.0, "x", 0.0), ("f", "unknown", 95.0, "y", 0.0))
    got = {(r.carriageway, r.vehicle_type): r.violation_count for r in questions.q3_speed_violations(df).collect()}
    assert got == {("x", "truck"): 1, ("x", "bus"): 1, ("y", "unknown"): 1}
    assert questions.q3_total(df).first().violation_count == 3


def test_windows(spark):
    times = [0.0, 299.99, 300.0, 300.9, 650.0, -1.5, None]
    df = events(spark, *[(None if t == 300.9 else f"v{i}", "car", 60.0 + i, "x", t) for i, t in enumerate(times)])
    counts = {r.window_index: r.vehicle_count for r in questions.q5_vehicles_per_window(df).collect()}
    assert counts == {0: 1, 1: 2, 2: 1, 3: 1}
    means = {r.window_index: r.avg_speed_kmh for r in questions.q6_avg_speed(df).collect()}
    assert means == {0: 65, 1: 61, 2: 63, 3: 64}          # 60.5 -> 61 and 62.5 -> 63


FAR = [7e11, 6.4e11, 9.22e12, -9.22e12, 1e300, float("nan"), float("inf"), float("-inf")]


def test_far_off_times_end_no_job(spark):
    """Times that no window can hold are left out and can be told; all others are counted."""
    df = events(spark, *[(f"v{i}", "car", 60.0, "x", t) for i, t in enumerate([0.0, 299.0, *FAR, None])])
    counts = {r.window_index: r.vehicle_count for r in questions.q5_vehicles_per_window(df).drop("window_start").collect()}
    assert counts == {1: 2, int(6.4e11 // 300) + 1: 1}
    assert {r.window_index: r.avg_speed_kmh for r in questions.q6_avg_speed(df).collect()} == {w: 60 for w in counts}
    assert len(questions.q6_log(df).collect()) == 2
    out = {r.vehicle_id for r in questions.without_window(df).select("vehicle_id").collect()}
    assert out == {"v2", "v4", "v5", "v6", "v7", "v8", "v9", "v10"}
    narrow = {r.window_index for r in questions.q5_vehicles_per_window(df, window_s=1).collect()}
    assert narrow == {1, 300}


def test_log_line_without_a_lane(spark):
    df = events(spark, ("a", "car", 72.4, "inbound", 700.0), ("b", "car", 60.0, None, 0.0))
    assert sorted(r.log_entry for r in questions.q6_log(df).collect()) == ["(1st 5min, 60kmh)", "(inbound, 3rd 5min, 72kmh)"]


def test_ordinals(spark):
    numbers = [0, 1, 2, 3, 4, 11, 12, 13, 21, 111, 112]
    df = spark.createDataFrame([(n,) for n in numbers], "n int").select(ordinal(F.col("n")).alias("t"))
    assert [r.t for r in df.collect()] == "0th 1st 2nd 3rd 4th 11th 12th 13th 21st 111th 112th".split()


def test_numbers_round_like_the_stored_double(spark):
    values = [0.25, 0.35, 2.5, 3.5, 2.675, 1301375.255, 1234567.25, -0.05, 99.95] + [i / 100 + 0.005 for i in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(
        "v", fixed_point(F.col("v"), 1).alias("one"), fixed_point(F.col("v"), 0).alias("none"),
        to_places(F.col("v")).alias("two"))
    for r in df.collect():
        assert r.one == f"{r.v:.1f}" and r.none == f"{r.v:.0f}" and r.two == round(r.v, 2)
    odd = spark.createDataFrame([(float("inf"),), (None,)], "v double").select(to_places(F.col("v")).alias("v"))
    assert [r.v for r in odd.collect()] == [float("inf"), None]


def test_numbering_needs_no_single_task(spark):
    rows = [(n * 7, f"v{n}", 140.0) for n in range(500)]
    df = spark.createDataFrame(rows, "arrival long, vehicle_id string, speed_kmh double").repartition(5)
    got = {r.arrival: r.alert_no for r in alerts.alert_numbering(df, "arrival").collect()}
    assert got == {n * 7: n + 1 for n in range(500)}


def test_alert_lines(spark):
    df = spark.createDataFrame([(1, "cam", "L1", "car", 140.25, "west")],
                               "alert_no long, camera_name string, vehicle_id string, vehicle_type string, "
                               "speed_kmh double, direction string")
    row = alerts.alert_log(df).first()
    assert row.log_line == "⚠  SPEED ALERT #1  |  cam=cam              CAR L1  |  140.2 km/h  |  lane: west"
    assert row.tracker_line == "⚠  SPEED ALERT  |  cam=cam                   CAR L1  |  140.2 km/h  |  west"


def test_kafka_options():
    settings = StreamSettings(checkpoint_base="/x", bootstrap="b:1", max_offsets_per_trigger=5)
    assert feeds.kafka_options(settings, "t") == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "t", "startingOffsets": "earliest",
        "failOnDataLoss": "false", "maxOffsetsPerTrigger": "5"}


@pytest.mark.parametrize("keep", [(), ("value",)])
def test_decode_reads_each_message_once(spark, keep):
    plan = messages.decode_events(raw(spark, json.dumps(GOOD)), keep=keep)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
