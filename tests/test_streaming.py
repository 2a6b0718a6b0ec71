"""Streaming jobs on small feeds of files: each file is one batch."""

import json
import functools
import os
import subprocess
import sys
import random
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from laneflow import schemas
from laneflow.config import QUESTION_STREAMS, Camera, StreamSettings
from laneflow.operators import detections, questions, sketches, tracker, trajectories
from laneflow.plans import live, queries
from laneflow.session import work_folder
from laneflow.sources import feeds
from laneflow.sources.cameras import cameras_dim, positions_calibrated
from laneflow.sources.messages import decode_events
from laneflow.streaming import jobs, sinks, state

EVENT = ("vehicle_id", "vehicle_type", "speed_kmh", "carriageway", "segment", "timestamp_s", "speed_source")


def message(vehicle, seconds, speed=60.0, kind="car", lane="x"):
    return json.dumps(dict(zip(EVENT, (vehicle, kind, speed, lane, "cam", seconds, "tripwire"))))


def write_files(path, batches):
    """One file per batch, aged so that the file source takes them in order."""
    os.makedirs(path, exist_ok=True)
    for i, lines in enumerate(batches):
        name = f"{path}/{i:03d}.txt"
        with open(name, "w") as out:
            out.write("\n".join(lines) + "\n")
        os.utime(name, (1_600_000_000 + i, 1_600_000_000 + i))


def settings(folder, sink="memory"):
    return StreamSettings(checkpoint_base=f"{folder}/checkpoints", sink=sink, trigger={"availableNow": True})


GOLDEN = [
    [message("a", 0), message("b", 10), message("a", 299)], [message("c", 301), message("d", 650)],
    [message("z", 0), message("y", 100), message("x", 400)], [message("q", 1300)], [message("late", 0)],
]


@pytest.mark.parametrize("exact", [True, False])
def test_windows_and_late_rows(spark, folder, exact):
    write_files(folder + "/in", GOLDEN)
    events = decode_events(feeds.folder_feed(spark, folder + "/in", files_per_trigger=1))
    rows = questions.q5_vehicles_per_window(events, exact=exact)
    jobs.start(rows, f"windows_{exact}", "append", settings(folder)).awaitTermination(100)
    got = spark.table(f"windows_{exact}").collect()
    assert sorted((r.window_index, r.vehicle_count) for r in got) == [(1, 4), (2, 2), (3, 1)]


@pytest.mark.parametrize("ask", [questions.q5_vehicles_per_window, questions.q6_avg_speed])
def test_far_off_times_end_no_stream(spark, folder, ask):
    """A time beyond all windows neither ends the stream nor moves its watermark."""
    far = [message("f", t) for t in (7e11, 9.22e12, -9.22e12, 1e300)]
    write_files(folder + "/in", [[message("a", 0), *far], [message("b", 10)], [message("c", 900)], [message("d", 1600)]])
    rows = ask(decode_events(feeds.folder_feed(spark, folder + "/in", files_per_trigger=1)))
    name = f"far_{ask.__name__}"
    jobs.start(rows, name, "append", settings(folder)).awaitTermination(100)
    found = spark.table(name).collect()
    assert sorted(r.window_index for r in found) == [1, 4]
    assert [r.vehicle_count for r in found if "vehicle_count" in r and r.window_index == 1] in ([2], [])


def test_five_questions_at_once(spark, folder):
    rng = random.Random(5)
    batches = [[message(f"v{rng.randrange(30)}", 100 * b + rng.randrange(100), rng.choice([60.0, 95.5, 140.25]),
                        rng.choice(["car", "truck", None]), rng.choice("xy")) for _ in range(20)] for b in range(8)]
    write_files(folder + "/in", [b + ["broken"] for b in batches])
    started = jobs.start_questions(feeds.folder_feed(spark, folder + "/in", 2), settings(folder), exact_windows=True)
    assert [q.name for q in started] == list(QUESTION_STREAMS)
    for query in started:
        query.awaitTermination(100)
    assert len(os.listdir(folder + "/checkpoints")) == 5
    table = decode_events(spark.read.text(folder + "/in"))
    closed = F.col("window_index") * 300 <= table.agg(F.max("timestamp_s")).first()[0] // 1 - 300
    expected = {
        "Q1_Vehicle_Speeds": questions.q1_vehicle_speeds(table),
        "Q2_Vehicle_Count_Per_Lane": questions.q2_vehicles_per_lane(table, exact=False),
        "Q3_Speed_Violations": questions.q3_speed_violations(table),
        "Q5_Vehicles_Per_Lane_Per_5min": questions.q5_vehicles_per_window(table).filter(closed),
        "Q6_Avg_Speed_Per_Lane_Per_5min": questions.q6_log(table).filter(closed),
    }
    for name, answer in expected.items():
        ours = sorted(map(str, spark.table(name).collect()))
        assert ours == sorted(map(str, answer.collect())) and ours, name


def test_restart_goes_on_where_it_stopped(spark, folder):
    write_files(folder + "/in", [[message("a", 0)], [message("b", 1)]])
    write = sinks.table_sink(folder + "/out")
    for extra in (None, message("c", 2)):
        if extra:
            write_files(folder + "/in2", [])
            with open(folder + "/in/900.txt", "w") as out:
                out.write(extra + "\n")
        rows = questions.q1_vehicle_speeds(decode_events(feeds.folder_feed(spark, folder + "/in")))
        jobs.start_batches(rows, "restart", write, settings(folder)).awaitTermination(100)
    assert sorted(r.vehicle_id for r in spark.read.parquet(folder + "/out").collect()) == ["a", "b", "c"]


def test_alert_job(spark, folder):
    write_files(folder + "/in", [[message("a", 0, 130.0), message("b", 0, 129.0), "broken"],
                                 [message("c", 0, 150.126), '{"speed_kmh":"x"}', '{"speed_kmh":"135"}']])
    feed = feeds.folder_feed(spark, folder + "/in", 1)
    jobs.start_alerts(feed, folder + "/alerts", folder + "/bad", settings(folder)).awaitTermination(100)
    alerts = sinks.read_table(spark, folder + "/alerts", schemas.SPEED_ALERTS_TABLE)
    assert sorted((r.batch_id, r.camera_name, r.vehicle_id, r.speed_kmh, r.direction) for r in alerts.collect()) == [
        (0, "cam", "a", 130.0, "x"), (1, "?", "UNKNOWN", 135.0, "?"), (1, "cam", "c", 150.13, "x")]
    assert alerts.filter("alerted_at is null").count() == 0
    assert sorted(r.value for r in spark.read.parquet(folder + "/bad").collect()) == ["broken", '{"speed_kmh":"x"}']
    counter = jobs.start_alert_counter(feeds.folder_feed(spark, folder + "/in", 1), settings(folder))
    counter.awaitTermination(100)
    assert spark.table("Q4_Alert_Count").first().alert_count == 3


def test_a_batch_written_twice_counts_once(spark, folder):
    rows = spark.createDataFrame([("cam", "L1", "car", 140.0, "x", "left", "tripwire")],
                                 "camera_name string, vehicle_id string, vehicle_type string, speed_kmh double, "
                                 "direction string, movement string, speed_source string")
    for batch in (0, 1, 1, 0):
        sinks.write_vehicle_events(rows, batch, folder + "/events")
        sinks.write_speed_alerts(rows, batch, folder + "/alerts")
    assert sinks.read_table(spark, folder + "/events", schemas.VEHICLE_EVENTS_TABLE).count() == 2
    assert sinks.read_table(spark, folder + "/alerts", schemas.SPEED_ALERTS_TABLE).count() == 2


CAMERA = Camera("cam", split=640, l1=100, l2=300, r1=700, r2=900)
POSITION = "camera_name string, side string, track_id long, frame_id long, cx int, vehicle_type string"


def test_resolver_equals_the_table_form(spark, folder):
    rng = random.Random(11)
    rows, x = [], {t: rng.randrange(400) for t in range(12)}
    for f in range(90):
        for t in x:
            if rng.random() < 0.7:
                x[t] = max(0, min(420, x[t] + (6 * rng.randint(-6, 9) if t % 2 else rng.randint(-1, 2))))
                rows.append(("cam", "L", t, f, x[t], rng.choice(["car", "truck", None])))
    # tracks that only the lines can measure, one of them across batches
    rows += [("cam", "L", 100, f, x, "car") for f, x in enumerate((90, 310, 290))]
    rows += [("cam", "L", 101, f, x, "car") for f, x in ((3, 90), (5, 150), (17, 310), (31, 90), (33, 400))]
    df = spark.createDataFrame(rows, POSITION)
    for batch in range(6):
        part = df.filter((F.col("frame_id") >= 15 * batch) & (F.col("frame_id") < 15 * batch + 15)).coalesce(1)
        part.write.parquet(f"{folder}/in/{batch:02d}")
    feed = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder + "/in/*")
    cameras = cameras_dim(spark, [CAMERA])
    query = jobs.start_resolver(positions_calibrated(feed, cameras), folder + "/events", settings(folder),
                                folder + "/alerts", sinks.folder_publisher(folder + "/topics"), idle_ms=None)
    query.awaitTermination(100)
    columns = ["camera_name", "vehicle_id", "vehicle_type", "speed_kmh", "direction", "movement", "speed_source"]
    expected = trajectories.resolved_events(positions_calibrated(df, cameras))
    expected = expected.withColumn("speed_kmh", sinks.to_places(F.col("speed_kmh")))
    got = sinks.read_table(spark, folder + "/events", schemas.VEHICLE_EVENTS_TABLE)
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, expected.select(columns).collect()))
    assert {r.speed_source for r in got.collect()} == {"tripwire", "displacement"}
    fast = {r.vehicle_id for r in expected.filter("speed_kmh > 130").collect()}
    alerts = sinks.read_table(spark, folder + "/alerts", schemas.SPEED_ALERTS_TABLE)
    assert {r.vehicle_id for r in alerts.collect()} == fast and fast
    sent = spark.read.text(folder + "/topics").groupBy("topic").count()
    assert {r.topic: r["count"] for r in sent.collect()} == {"traffic-stats": got.count(), "traffic-alerts": len(fast)}
    # what was published can be read back by the statistics job
    assert decode_events(spark.read.text(folder + "/topics").filter("topic = 'traffic-stats'")).count() == got.count()


def test_tracker_equals_the_table_form(spark, folder):
    rng = random.Random(2)
    rows = []
    for f in range(60):
        for b in range(rng.choice([0, 2, 5]) if not 20 <= f < 36 else 0):
            rows.append(("cam", f, rng.choice("LR"), b, rng.randrange(700), rng.randrange(400)))
    rows.append(("cam", 60, "L", 0, 5, 5))
    rows.append(("cam", 60, "R", 0, 5, 5))
    df = spark.createDataFrame(rows, "camera_name string, frame_id long, side string, box_id int, cx int, cy int")
    # frame 30 has no boxes; frame 45 comes in two batches
    cuts = [F.col("frame_id") < 10, (F.col("frame_id") >= 10) & (F.col("frame_id") < 45),
            (F.col("frame_id") == 45) & (F.col("box_id") < 2),
            ((F.col("frame_id") == 45) & (F.col("box_id") >= 2)) | (F.col("frame_id") > 45)]
    for i, cut in enumerate(cuts):
        df.filter(cut).coalesce(1).write.parquet(f"{folder}/in/{i}")
    feed = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder + "/in/*")
    jobs.start(state.tracks_stream(feed, idle_ms=None), "tracks", "append", settings(folder)).awaitTermination(100)
    got = sorted(map(tuple, spark.table("tracks").collect()))
    table = tracker.assign_tracks(df).filter("frame_id < 60")
    assert got == sorted(map(tuple, table.collect())) and got


def session_with(master, checkpoint_dir):
    conf = SimpleNamespace(get=lambda key, default: checkpoint_dir or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_a_plain_local_session_needs_no_setting(tmp_path):
    """Spark with an empty folder of settings: what is stored goes to a temporary folder."""
    code = """
from laneflow.session import local_session, stored
spark = local_session(2, 2)
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert stored(spark.range(5), "x").count() == 5
print("fine")
"""
    (tmp_path / "conf").mkdir()
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path / "conf"), "PYTHONPATH": here}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=200, cwd=tmp_path)
    assert done.returncode == 0 and "fine" in done.stdout, done.stderr[-2000:]


def test_work_folder_follows_the_session():
    assert work_folder(session_with("yarn", "hdfs:///shared/"), "x").startswith("hdfs:///shared/x-")
    assert work_folder(session_with("local[2]", None), "x").startswith("/")
    with pytest.raises(ValueError):
        work_folder(session_with("yarn", None), "x")


@pytest.mark.parametrize("files", [1, 3])
def test_streams_read_what_the_tables_read(spark, folder, files):
    """One file or a folder of parts: the streaming queries give the rows of the batch queries."""
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    if files == 1:
        source = "/root/testdata/sf0.001"
    else:
        source = folder + "/sf"
        events.repartitionByRange(files, "event_id").write.parquet(source + "/events.parquet")
    rows = lambda df: sorted(map(str, df.collect()))
    for stream, batch in (("stream_q1", queries.q1_vehicle_speeds), ("stream_q3", queries.q3_speed_violations)):
        got = queries.QUERIES[stream](spark, source)
        assert rows(got) == rows(batch(spark, source).select(*got.columns)) != []


def test_empty_feed(spark, folder):
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(0).write.parquet(folder + "/sf/events.parquet")
    for name in ("stream_q1", "stream_q3", "stream_tracks"):
        assert queries.QUERIES[name](spark, folder + "/sf").count() == 0


def test_state_is_on_disk(spark):
    jobs.with_state_on_disk(spark)
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


@pytest.mark.parametrize("batches", [1, 5])
def test_live_service(spark, folder, batches):
    """Boxes as a stream, in one batch or several, give the events that they give as a table."""
    rng, rows = random.Random(11), []
    cars = [[rng.randrange(1280), rng.randrange(600), rng.choice([-25, -9, 8, 30])] for _ in range(14)]
    for f in range(120):
        for b, car in enumerate(cars):
            car[0] += car[2] + rng.randint(-3, 3)
            if 0 < car[0] < 1280 and rng.random() < 0.9 and not 60 <= f < 64:
                rows.append((rng.choice(["IC_Papagou", "elsewhere"]) if f < 2 else ["IC_Papagou", "elsewhere"][b % 2], f, b, car[0] - 40, car[1], 80 + b * 8, 90, 8000.0, None))
            elif rng.random() < 0.3:
                car[0] = rng.choice([5, 1270])
    df = spark.createDataFrame(rows, schemas.DETECTIONS)
    for i in range(batches):
        df.filter((F.col("frame_id") >= 120 * i // batches) & (F.col("frame_id") < 120 * (i + 1) // batches)).coalesce(1).write.parquet(f"{folder}/in/{i}")
    feed = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder + "/in/*")
    query = jobs.start_live(feed, cameras_dim(spark), folder + "/events", settings(folder))
    query.awaitTermination(100)
    columns = ("camera_name", "vehicle_id", "vehicle_type", "speed_kmh", "direction", "movement", "speed_source")
    got = sinks.read_table(spark, folder + "/events", schemas.VEHICLE_EVENTS_TABLE).select(*columns).collect()
    expected = live.boxes_to_events(df, cameras_dim(spark), folder + "/positions").select(*columns).collect()
    plain = lambda rows: sorted((*r[:3], round(r[3], 2), *r[4:]) for r in rows)
    assert plain(got) == plain(expected) and len(got) > 10


def test_run_analytics_starts_all_questions(spark, folder, monkeypatch):
    os.makedirs(folder + "/in")
    with open(folder + "/in/0.txt", "w") as file:
        file.write("\n".join([message("a", 0), message("b", 10), message("c", 301)]))
    monkeypatch.setattr(feeds, "stats_feed", lambda session, _: feeds.folder_feed(session, folder + "/in"))
    jobs.run_analytics(spark, settings(folder))
    for query in spark.streams.active:
        query.awaitTermination(100)
    for name in QUESTION_STREAMS:
        assert os.path.isdir(f"{folder}/checkpoints/{name}")
    assert spark.table("Q1_Vehicle_Speeds").count() == 3
    spark.streams.resetTerminated()


def test_boxes_file_by_file_give_the_table(spark, folder, monkeypatch):
    """One file a batch, with frames split over two files: the named queries give the rows of the table, the last frame too."""
    monkeypatch.setattr(feeds, "table_feed", functools.partial(feeds.table_feed, files_per_trigger=1))
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    top = events.agg(F.max("event_id")).first()[0] + 1
    cuts = [0, top // 3 // 10 * 10 + 3, top * 2 // 3 // 10 * 10 + 4, top]
    for low, high in zip(cuts, cuts[1:]):
        events.filter((F.col("event_id") >= low) & (F.col("event_id") < high)).coalesce(1).write.mode("append").parquet(folder + "/sf/events.parquet")
    for stream, batch in (("stream_tracks", "assign_tracks"), ("stream_live", "live_events")):
        got = queries.QUERIES[stream](spark, folder + "/sf")
        expected = queries.QUERIES[batch](spark, folder + "/sf").select(*got.columns)
        plain = lambda df: sorted(str([round(x, 2) if isinstance(x, float) else x for x in r]) for r in df.collect())
        assert plain(got) == plain(expected) != []


def test_late_boxes_are_counted(spark, folder):
    """Boxes of frames that are done go to a table of their own, of the tracker and of the live service."""
    rows = [[("IC_Papagou", f, b, 100 + 10 * f + 300 * b, 100, 80, 90, 8000.0, None) for f in frames for b in boxes] for frames, boxes in (
        (range(10), (0,)), (range(10, 20), (0,)), (range(3, 6), (1,)))]
    for part in rows:
        spark.createDataFrame(part, schemas.DETECTIONS).coalesce(1).write.mode("append").parquet(folder + "/in")
    read = lambda: feeds.table_feed(spark, folder + "/in", schemas.DETECTIONS, 1)
    jobs.start_live(read(), cameras_dim(spark), folder + "/events", settings(folder), late_path=folder + "/late").awaitTermination(100)
    late = spark.read.parquet(folder + "/late")
    assert sorted((r.frame_id, r.box_id) for r in late.collect()) == [(3, 1), (4, 1), (5, 1)]
    centred = detections.detections_clean(read(), cameras_dim(spark))
    both = sinks.late_sink(folder + "/late-tracks", sinks.table_sink(folder + "/tracks"))
    jobs.start_batches(state.tracks_stream(centred, with_late=True), "late-tracks", both, settings(folder)).awaitTermination(100)
    assert sorted(r.frame_id for r in spark.read.parquet(folder + "/late-tracks").collect()) == [3, 4, 5]
    assert {r.frame_id for r in spark.read.parquet(folder + "/tracks").collect()} == set(range(19))


def test_sketches_of_batches_are_merged(spark, folder):
    """Windows over several batches, a late row and a batch that runs twice: each vehicle counts once."""
    write_files(folder + "/in", [*GOLDEN, [message(None, 5), message("a", float("nan")), message("b", 10)]])
    events = decode_events(feeds.folder_feed(spark, folder + "/in", files_per_trigger=1))
    write = sketches.sketches_sink(folder + "/sketches")
    jobs.start_batches(events, "sketches", write, settings(folder)).awaitTermination(100)
    write(decode_events(spark.read.text(folder + "/in/000.txt")), 0)
    kept = spark.read.parquet(folder + "/sketches")
    assert kept.select("batch_id").distinct().count() == 6
    assert {r.window_index: r.vehicle_count for r in sketches.vehicles_by(kept, "window_index").collect()} == {1: 5, 2: 2, 3: 1, 5: 1}
    spans = sketches.vehicles_by(sketches.with_span(kept, 2), "carriageway", "span").collect()
    assert {(r.carriageway, r.span): r.vehicle_count for r in spans} == {("x", 1): 7, ("x", 2): 1, ("x", 3): 1}


class Keyed:
    """Stands for a stream: gives out the keyed function that a streaming operator makes of it."""

    def select(self, *columns):
        return self

    groupBy = select

    def applyInPandasWithState(self, function, *how):
        return function


class KeptState:
    exists, hasTimedOut, get = False, False, None

    def update(self, value):
        self.exists, self.get = True, value


def feed_in_batches(frames, per_frame, rows_each):
    """Frames of boxes out of order, as a keyed task gets them: a few rows at a time."""
    rng, rows = random.Random(3), []
    cars = [[rng.randrange(600), 60 * b] for b in range(per_frame)]
    for f in range(frames):
        for b, car in enumerate(cars):
            car[0] = (car[0] + rng.choice([0, 9, 30])) % 640
            if rng.random() < 0.8 and f % 50 < 40:
                rows.append((f, b, car[0], car[1], 60 + 20 * b, 100, 100, 300, 28.0, 16.0, "x"))
    rng.shuffle(rows)
    columns = ["frame_id", "box_id", "cx", "cy", "w", "h", "first_line", "second_line", "dist_m", "px_per_m", "direction"]
    return (pd.DataFrame(rows[i : i + rows_each], columns=columns) for i in range(0, len(rows), rows_each))


@pytest.mark.parametrize("make", [state.tracks_stream, state.live_stream])
def test_a_large_batch_is_walked_in_pieces(monkeypatch, make):
    """What a keyed task gives out at once doesn't grow with its batch, and pieces of any size give the same rows and state."""
    found = []
    for size in (100, 1_000_000):
        monkeypatch.setattr(state, "PIECE_BOXES", size, raising=False)
        kept = KeptState()
        parts = list(make(Keyed())(("cam", "L"), feed_in_batches(2000, 5, 300), kept))
        rows = pd.concat(parts).astype(object)
        found.append((sorted(map(str, rows.itertuples(index=False))), str(kept.get)))
        assert len(rows) > 100
        if size == 100:
            assert len(parts) > 20 and max(map(len, parts)) < 2_000
    assert found[0] == found[1]


def test_many_tracks_at_once_are_each_as_alone():
    rng = random.Random(9)
    histories, firsts, tracks = [], [], []
    for n in range(60):
        histories.append([rng.randrange(400) for _ in range(rng.randrange(10))])
        firsts.append(rng.choice([None, 3]) if histories[-1] else None)
        tracks.append(pd.DataFrame({"frame_id": range(20, 20 + rng.randrange(1, 15)), "first_line": 100, "second_line": 300, "dist_m": 28.0,
                                    "px_per_m": 16.0, "direction": "x", "vehicle_type": "car"}).assign(cx=lambda t: [rng.randrange(400) for _ in range(len(t))]))
    sizes, all_rows = [len(t) for t in tracks], pd.concat(tracks)
    kept, first, row, crossed, speed, way = state.resolve_tracks(
        histories, firsts, sizes, all_rows["frame_id"].to_numpy(), all_rows["cx"].to_numpy(), (100, 300), 16.0, 25.0)
    at = 0
    for i, rows in enumerate(tracks):
        history, first_frame, event = state.resolve_track(histories[i], firsts[i], rows, 25.0)
        assert (history, first_frame) == (kept[i], first[i])
        assert (event is not None) == (row[i] < len(all_rows))
        if event is not None:
            assert event[5 + 1] == all_rows["frame_id"].iloc[row[i]] and 0 <= row[i] - at < len(rows)
            assert event[4] == ("tripwire" if crossed[i] else "displacement")
        at += len(rows)
