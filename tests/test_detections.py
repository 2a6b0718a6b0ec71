"""Boxes, classes, candidate pairs and track assignment against models."""

import math
import random

import pytest

import brute
from laneflow.config import Camera
from pyspark.sql import functions as F

from laneflow.operators import detections, tracker
from laneflow.sources.cameras import cameras_dim

DETECTION = ("camera_name string, frame_id long, box_id int, x int, y int, w int, h int, area double, class_id int")
CENTRED = "camera_name string, frame_id long, side string, box_id int, cx int, cy int, w int, h int"
PLACED = "camera_name string, side string, track_id long, frame_id long, cx int, cy int"


def test_clean(spark):
    cam = cameras_dim(spark, [Camera("cam", split=640)])
    rows = [("cam", 1, 0, 600, 10, 79, 41, 1500.0, 2), ("cam", 1, 1, 600, 10, 80, 40, 1499.9, 2),
            ("cam", 1, 2, 600, 10, 80, 40, 1600.0, 2)]
    got = detections.detections_clean(spark.createDataFrame(rows, DETECTION), cam).collect()
    assert sorted((r.box_id, r.cx, r.cy, r.side) for r in got) == [(0, 639, 30, "L"), (2, 640, 30, "R")]


def centred(spark, frames, side="L", size=(50, 50)):
    rows = [("cam", f, side, i, *b[:2], *(b[2:] or size)) for f, boxes in frames.items() for i, b in enumerate(boxes)]
    return spark.createDataFrame(rows, CENTRED)


@pytest.mark.parametrize("most,block", [(9, 65_536), (9, 4), (300, 4), (9, 1)])
def test_vehicle_class(spark, most, block):
    """Nearest box by frame, few or hundreds of them, and the class kept since."""
    rng = random.Random(most)
    frames, places = {}, []
    for f in range(40):
        count = rng.choice([0, 0, 1, 3, most])
        frames[f] = [(rng.randrange(30), rng.randrange(30), rng.choice([50, 100]), 95) for _ in range(count)]
        for t in range(3):
            if t == 0 or rng.random() < 0.6:
                on = frames[f] and rng.random() < 0.5
                spot = rng.choice(frames[f])[:2] if on else (rng.randrange(30), rng.randrange(30))
                places.append(("cam", "L", t, f, *spot))
    expected = {}
    last = {}
    for _, _, t, f, x, y in sorted(places, key=lambda p: (p[2], p[3])):
        if frames[f]:
            box = min(frames[f], key=lambda b: abs(x - b[0]) + abs(y - b[1]))
            last[t] = "truck" if box[2] * box[3] >= 9000 else "car"
        expected[t, f] = last.get(t)
    got = detections.vehicle_class(spark.createDataFrame(places, PLACED), centred(spark, frames), block=block)
    assert {(r.track_id, r.frame_id): r.vehicle_type for r in got.collect()} == expected


def test_match_candidates(spark):
    rng = random.Random(3)
    frames = {f: [(rng.randrange(-200, 900), rng.randrange(700)) for _ in range(12)] for f in range(6)}
    frames[6] = [(x + 180, y) for x, y in frames[5]]
    expected = {(f, i, j) for f in frames for i, a in enumerate(frames[f]) for j, b in enumerate(frames.get(f + 1, []))
                if math.dist(a, b) <= 180}
    got = {(r.frame_id, r.box_before, r.box_after) for r in detections.match_candidates(centred(spark, frames)).collect()}
    assert got == expected and len(got) > 50


def assigned(spark, frames, **kw):
    rows = tracker.assign_tracks(centred(spark, {f: b for f, b in frames.items() if b}), **kw).collect()
    return sorted((r.track_id, r.frame_id, r.cx, r.cy, r.coasting) for r in rows)


def test_assignment_against_the_walk(spark):
    rng = random.Random(8)
    frames, cars = {}, [[rng.randrange(1200), rng.randrange(600)] for _ in range(8)]
    for f in range(120):
        for car in cars:
            car[0] += rng.randint(-60, 60)
            car[1] += rng.randint(-60, 60)
        shown = 0 if 40 <= f < 60 else rng.choice([0, 3, 8])
        frames[f] = [tuple(c) for c in rng.sample(cars, shown)]
    frames[0] = [tuple(c) for c in cars[:3]]
    assert assigned(spark, frames, last_frame=119) == sorted(brute.greedy_tracks(frames))


@pytest.mark.parametrize("block,warm_up,seed", [(None, None, 1), (40, 20, 2), (13, 13, 3), (13, 2, 4), (50, 0, 5), (1, 1, 6)])
def test_blocks_are_walked_as_one_feed(spark, block, warm_up, seed):
    """Gaps of all lengths, blocks and guesses of any size, right or wrong: the rows and ids of one walk over the feed."""
    rng = random.Random(seed)
    frames, f = {}, 3
    while f < 400:
        frames[f] = [(rng.randrange(300), rng.randrange(300)) for _ in range(rng.choice([1, 2, 5]))]
        f += rng.choice([1, 1, 1, 2, 12, 13, 14, 15, 40])
    got = assigned(spark, frames, block=block, warm_up=warm_up)
    assert got == sorted(brute.greedy_tracks({f: frames.get(f, []) for f in range(min(frames), max(frames) + 1)}))
    assert len({t for t, *_ in got}) == max(t for t, *_ in got) + 1


def test_a_feed_without_gaps_is_walked_in_parallel(spark):
    """Cars that pass and one that is parked: all guesses but those of the parked car's order hold, and ids go over all seams."""
    rng = random.Random(4)
    frames = {f: [(640, 300)] + [((17 * f + 400 * n) % 1280, 100 * n + rng.randrange(4)) for n in range(5)] for f in range(600)}
    df = centred(spark, frames)
    how = tracker._Walk(100, 180, 12)
    blocks = tracker.walk_blocks(df, how, 30)
    assert blocks.count() == 6 and len({r.p for r in blocks.select(F.spark_partition_id().alias("p")).collect()}) > 1
    walked, known = tracker._agreed(df.select("camera_name", "side", "frame_id", "box_id", "cx", "cy"), how, 30)
    assert known.count() == 6
    got = assigned(spark, frames, block=100, warm_up=30)
    assert got == sorted(brute.greedy_tracks(frames))
    parked, = {t for t, f, x, y, _ in got if (x, y) == (640, 300) and f == 0}
    assert sum(t == parked for t, *_ in got) >= 500


def test_wrong_guesses_are_walked_again(spark):
    """Without a warm-up every start is wrong; with one that is long enough only the first walk is needed."""
    frames = {f: [(10 * f, 100), (10 * f, 500)] for f in range(100)}
    df = centred(spark, frames).select("camera_name", "side", "frame_id", "box_id", "cx", "cy")
    how = tracker._Walk(20, 180, 12)
    rounds = [max(r["round"] for r in tracker._agreed(df, how, w)[1].collect()) for w in (0, 15)]
    assert rounds[0] >= 1 and rounds[1] == 0


def test_boxes_without_a_key_are_left_out(spark):
    df = spark.createDataFrame([("c", 1, 0, 5, 5, "L"), (None, 1, 0, 5, 5, "L"), ("c", None, 0, 5, 5, "L"), ("c", 1, 0, 5, 5, None)],
                               "camera_name string, frame_id long, box_id int, cx int, cy int, side string")
    assert [tuple(r) for r in tracker.assign_tracks(df).collect()] == [("c", "L", 0, 1, 5, 5, False)]
    assert tracker.assign_tracks(df.limit(0)).collect() == []


def test_match_distance(spark):
    near = assigned(spark, {1: [(0, 0)], 2: [(180, 0)]})
    assert near == [(0, 1, 0, 0, False), (0, 2, 180, 0, False)]
    far = assigned(spark, {1: [(0, 0)], 2: [(180, 6)]})      # 180.1 px
    assert far == [(0, 1, 0, 0, False), (0, 2, 0, 0, True), (1, 2, 180, 6, False)]


def test_ties_go_to_the_older_track_and_the_first_box(spark):
    got = assigned(spark, {1: [(0, 0), (100, 0)], 2: [(50, 0), (50, 0)]})
    assert [r[:3] for r in got if r[1] == 2] == [(0, 2, 50), (1, 2, 50)]


@pytest.mark.parametrize("missing,kept", [(12, True), (13, False)])
def test_lost_tracks(spark, missing, kept):
    got = assigned(spark, {1: [(0, 0)], missing + 2: [(0, 0)]})
    assert max(t for t, *_ in got) == (0 if kept else 1)
    assert sum(1 for r in got if r[4]) == 12
