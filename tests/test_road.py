"""Perspective, road speeds, report, zone, segments, snapshots."""

import glob
import math
import random

import pytest
from pyspark.sql import functions as F

import brute
from laneflow.operators import activity, road, segments, tripwires
from laneflow.sources.cameras import cameras_dim
from laneflow.streaming.sinks import write_report_csv

BOX = "camera_name string, track_id long, frame_id long, x int, y int, w int, h int, class_id int"


def boxes(spark, rows):
    """(track, frame, foot y[, class])"""
    full = [("cam", t, f, 600, y - 40, 80, 40, *(c or [2])) for t, f, y, *c in rows]
    return road.class_filter(spark.createDataFrame(full, BOX))


def test_line_distances(spark):
    r = road.tripwire_distances(cameras_dim(spark)).first()
    assert r.corrected_m == pytest.approx(30.1297, abs=1e-3)
    assert r.naive_m == pytest.approx(4.7619, abs=1e-3)


def test_homography_keeps_its_corners(spark):
    pixels = {(490, 295): (0, 0), (790, 295): (28, 0), (1260, 700): (28, 102), (20, 700): (0, 102)}
    full = [("cam", i, 1, x - 5, y - 10, 10, 10, 2) for i, (x, y) in enumerate(pixels)]
    rows = road.bev_positions(spark.createDataFrame(full, BOX)).orderBy("track_id").collect()
    for r, metres in zip(rows, pixels.values()):
        assert (r.bev_x, r.bev_y) == pytest.approx(metres, abs=1e-6)


def test_classes(spark):
    rows = boxes(spark, [(1, 1, 300, 2), (2, 1, 300, 3), (3, 1, 300, 5), (4, 1, 300, 7), (5, 1, 300, 0), (6, 1, 300, 8)])
    assert {r.track_id: r.vehicle_type for r in rows.collect()} == {1: "car", 2: "motorcycle", 3: "bus", 4: "truck"}


def bev_y(y):
    g, h, i = 0.0, -0.006033376123234916, 1.0
    return (0.0 * 640 + -0.8118100128369705 * y + 239.48395378690634) / (g * 640 + h * y + i)


def model(tracks, fps=25.0):
    """{track: [(frame, y)]} to {(track, frame): (corrected, sample)}"""
    out = {}
    for t, steps in tracks.items():
        rows = [{"frame_id": f, "y": y} for f, y in sorted(steps)]
        first, second = brute.laps(rows, "y", 400, 560, brute.crossed_y)
        for i, row in enumerate(rows):
            kept = rows[max(0, i - 24):i + 1]
            if second is not None and row["frame_id"] >= second:
                out[t, row["frame_id"]] = (30.129743 / ((second - first) / fps) * 3.6, None)
            elif len(kept) > fps / 2:
                out[t, row["frame_id"]] = (None, abs(bev_y(kept[-1]["y"]) - bev_y(kept[0]["y"])) / (len(kept) / fps) * 3.6)
            else:
                out[t, row["frame_id"]] = (None, None)
    return out


@pytest.mark.parametrize("block", [65_536, 9, 1])
def test_traces_and_report(spark, folder, block):
    rng = random.Random(4)
    tracks = {1: [(f, 380 + 5 * f) for f in range(1, 61)], 2: [(3 * f, 300 + f) for f in range(1, 41)],
              3: [(f, 300 + f) for f in range(1, 13)], 4: [(f, 300 + f) for f in range(1, 14)],
              5: [(f, rng.randrange(350, 620)) for f in range(1, 200, 2)]}
    df = boxes(spark, [(t, f, y) for t, steps in tracks.items() for f, y in steps])
    traces = road.road_traces(df, block=block)
    expected = model(tracks)
    got = {(r.track_id, r.frame_id): (r.corrected_kmh, r.bev_kmh) for r in traces.collect()}
    assert set(got) == set(expected)
    for key, (exact, sample) in expected.items():
        assert got[key][0] == (None if exact is None else pytest.approx(exact, rel=1e-5))
        assert got[key][1] == (None if sample is None else pytest.approx(sample))

    report = {r.vehicle_id: r for r in road.vehicle_report(traces).collect()}
    assert set(report) == {1, 2, 4, 5}          # 12 positions are too few, 13 are enough
    assert report[2].tripwire_speed_corrected_kmh is None
    samples = [s for (t, _), (_, s) in expected.items() if t == 2 and s is not None]
    assert report[2].bev_avg_speed_kmh == pytest.approx(sum(samples) / len(samples))
    assert (report[2].bev_min_speed_kmh, report[2].bev_max_speed_kmh) == (
        pytest.approx(min(samples)), pytest.approx(max(samples)))
    if block == 9:
        write_report_csv(road.vehicle_report(traces), folder + "/report")
        lines = [line for name in sorted(glob.glob(folder + "/report/*.csv")) for line in open(name).read().splitlines()]
        assert lines[0].split(",")[:3] == ["camera_name", "vehicle_id", "vehicle_type"]
        body = [line.split(",") for line in lines if not line.startswith("camera_name")]
        assert [int(line[1]) for line in body] == [1, 2, 4, 5]
        assert body[1][3:5] in (["", ""], ['""', '""'])


def test_bev_speed_of_thirteen_positions(spark):
    df = spark.createDataFrame([("cam", 1, f, 0.5 * f) for f in range(1, 14)],
                               "camera_name string, track_id long, frame_id long, m double")
    # an even 0.5 m a frame: bring it in as the road plane's own coordinate
    plane = road.RoadPlane(matrix=(1.0, 0.0, 0.0, 0.0, 0.5, 0.0, 0.0, 0.0, 1.0))
    flat = df.selectExpr("camera_name", "track_id", "frame_id", "0 as x", "cast(frame_id as int) as y", "0 as w",
                         "0 as h", "'car' as vehicle_type")
    got = [r.bev_kmh for r in road.bev_speeds(road.road_traces(flat, plane)).collect()]
    assert got == [pytest.approx(41.538, abs=1e-3)]


def test_labels(spark):
    df = spark.createDataFrame([("cam", 7, 1, "car", 93.9, None), ("cam", 7, 2, "bus", None, 93.9),
                                ("cam", 7, 3, "truck", None, None)],
                               "camera_name string, track_id long, frame_id long, vehicle_type string, "
                               "corrected_kmh double, bev_kmh double")
    labels = [r.label for r in road.position_labels(df).orderBy("frame_id").collect()]
    assert labels == ["CAR #7  93 km/h", "BUS #7  ~93 km/h", "TRUCK #7"]


def test_zone(spark):
    df = boxes(spark, [(i, 1, y) for i, y in enumerate([369, 370, 399, 400, 560, 561, 590, 591])] + [(9, 2, 100)])
    assert {r.frame_id: (r.shown, r.in_zone) for r in road.zone_occupancy(df).collect()} == {1: (6, 2), 2: (0, 0)}


def test_zone_has_frames_without_boxes(spark):
    far = 9_000_000_000_000_000_000
    rows = [(1, 3, 450), (2, 8, 10), (3, 19, 450), (4, 31, 450), (5, far, 450), (6, -far, 450)]
    got = {r.frame_id: r.in_zone for r in road.zone_occupancy(boxes(spark, rows), gap=11).collect()}
    assert got == {**dict.fromkeys(range(3, 20), 0), 3: 1, 19: 1, 31: 1, far: 1, -far: 1}
    assert road.zone_occupancy(boxes(spark, rows).filter("false")).count() == 0


def test_run_summary(spark):
    df = spark.createDataFrame([(10.0, 5.0, 1.0), (20.0, 10.0, None), (None, None, 3.0)],
                               "tripwire_speed_corrected_kmh double, tripwire_speed_naive_kmh double, "
                               "bev_avg_speed_kmh double")
    r = road.run_summary(df).first()
    assert (r.tripwire_vehicles, r.bev_vehicles, r.mean_corrected_kmh, r.mean_naive_kmh, r.effect_pct) == (2, 2, 15, 7.5, 100)


def test_segment_plan(spark):
    videos = spark.createDataFrame([("a/b.c/my.clip.mp4", 25.0), ("v.mp4", 30.0), ("w", 0.5), ("z.mp4", 0.0)],
                                   "video_name string, duration_s double")
    rows = segments.segment_plan(videos, 10, max_segments=None).collect()
    plan = {}
    for r in sorted(rows, key=lambda r: r.segment_no):
        plan.setdefault(r.video_name, []).append((r.start_s, r.end_s))
    assert plan == {"a/b.c/my.clip.mp4": [(0, 10), (10, 20), (20, 25)], "v.mp4": [(0, 10), (10, 20), (20, 30)], "w": [(0, 0.5)]}
    assert {r.segment_name for r in rows if r.segment_no == 1} == {"my.clip_part_1.mp4", "v_part_1.mp4", "w_part_1.mp4"}
    assert segments.segment_plan(videos, 5, max_segments=3).filter("video_name = 'v.mp4'").count() == 3
    times = spark.createDataFrame([(t,) for t in (0.0, 9.99, 10.0, 24.0)], "timestamp_s double")
    got = [(r.segment_no, r.segment_start_s, r.segment_end_s)
           for r in segments.segment_assign(times, 10, total_s=F.lit(25.0)).collect()]
    assert got == [(1, 0, 10), (1, 0, 10), (2, 10, 20), (3, 20, 25)]


def test_snapshots(spark):
    seen = [("cam", "L", 1, f, "west") for f in range(1, 27)] + [("cam", "R", 1, f, "east") for f in range(9, 21)]
    positions = spark.createDataFrame(seen, "camera_name string, side string, track_id long, frame_id long, direction string")
    resolved = spark.createDataFrame([("cam", 8), ("cam", 10), ("cam", 11), ("cam", 26)], "camera_name string, frame_id long")
    rows = activity.activity_snapshot(positions, resolved, every=10).orderBy("frame_id").collect()
    assert [(r.frame_id, r.active_left, r.active_right, r.events_saved) for r in rows] == [(10, 1, 1, 2), (20, 1, 1, 3)]
    speeds = spark.createDataFrame([("cam", "L", 8, 3, 97.4), ("cam", "L", 7, 9, 87.5), ("cam", "L", 2, 11, 50.0),
                                    ("cam", "L", 9, 26, 60.0)],
                                   "camera_name string, side string, track_id long, second_frame long, speed_kmh double")
    rows = activity.snapshot_speed_list(positions, speeds, every=10).collect()
    assert {(r.side, r.frame_id): (r.new_speeds, r.speeds_so_far) for r in rows} == {
        ("L", 10): ("L8=97  L7=88", 2), ("L", 20): ("L2=50", 3), ("R", 10): ("—", 0), ("R", 20): ("—", 0)}
    first = {(r.side, r.track_id): r.frame_id for r in activity.first_seen(positions).collect()}
    assert first == {("L", 1): 1, ("R", 1): 9}
    total = activity.session_totals(positions, resolved).first()
    assert (total.frames_processed, total.events_saved) == (26, 4)


def test_many_snapshots(spark, monkeypatch):
    monkeypatch.setattr(activity, "_BATCH", 7)
    frames = spark.createDataFrame([("a", 1000), ("a", 3), ("b", 9), ("c", 70)], "camera_name string, frame_id long")
    got = sorted((r.camera_name, r.frame_id) for r in activity._snapshots(frames, 10).collect())
    assert got == [("a", 10 * i) for i in range(1, 101)] + [("c", 10 * i) for i in range(1, 8)]


def test_whole_lists_at_any_snapshot(spark):
    rng = random.Random(4)
    rows, lines = [], {}
    for camera, shots in (("a", 45), ("b", 8)):
        for side in "LR":
            parts = []
            for n in range(1, shots + 1):
                new = "—" if rng.random() < 0.5 or n < 4 else f"{side}{n}=1  {side}{n}=2"
                parts += [new] if new != "—" else []
                rows.append((camera, side, 10 * n, new, 0))
                lines[camera, side, 10 * n] = "  ".join(parts) or "—"
    rng.shuffle(rows)
    lists = spark.createDataFrame(rows, "camera_name string, side string, frame_id long, new_speeds string, speeds_so_far long")
    every = [(c, f) for c, _, f in lines]
    for asked in (every, [("a", 450), ("b", 20), ("b", 999), ("c", 10), ("b", 20)], []):
        got = activity.snapshot_speeds_at(lists, spark.createDataFrame(asked, "camera_name string, frame_id long"), every=10).collect()
        assert len(got) == len({k for k in lines if (k[0], k[2]) in asked})
        assert all(r.speeds == lines[r.camera_name, r.side, r.frame_id] for r in got)


def test_measured_ids(spark):
    one = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2)], "camera_name string, track_id long")
    two = spark.createDataFrame([("a", 2), ("b", 2)], "camera_name string, track_id long")
    assert sorted(map(tuple, road.measured_vehicle_ids(one, two).collect())) == [("a", 1), ("a", 2), ("b", 2)]


def test_y_lines_have_two_distances(spark):
    df = boxes(spark, [(1, 1, 390), (1, 2, 401), (1, 12, 561)])
    feet = road.with_road_lines(road.bev_positions(df))
    r, = tripwires.tripwire_speeds(feet, position="foot_y", variant="y", keys=("camera_name", "track_id"), distances={
        "corrected": road.corrected_distance(road.ROAD_PLANE), "naive": road.naive_distance(road.ROAD_PLANE)}).collect()
    assert math.isclose(r.corrected, 30.129743 / 0.4 * 3.6, rel_tol=1e-5)
    assert math.isclose(r.naive, 160 * 25 / 840 / 0.4 * 3.6)
