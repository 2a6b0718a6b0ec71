"""What the cameras see over time: first sightings, periodic snapshots, totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laneflow.config import NO_SPEEDS, SNAPSHOT_FRAMES
from laneflow.functions.numbers import fixed_point
from laneflow.operators.blocks import running_total
from laneflow.schemas import LIVE_KEYS
from laneflow.session import stored

# Snapshots made from one row at a time, so that no array grows with the feed.
_BATCH = 10_000


def first_seen(calibrated: DataFrame, keys: Sequence[str] = LIVE_KEYS) -> DataFrame:
    """First frame of every track."""
    return calibrated.groupBy(*keys).agg(
        F.min("frame_id").alias("frame_id"), F.first("direction").alias("direction"),
    )


def _next_snapshot(frame: Column, every: int) -> Column:
    """The first snapshot at or after a frame."""
    return (F.ceil(frame / every) * every).cast("long")


def _snapshots(frames: DataFrame, every: int) -> DataFrame:
    """Every snapshot of every camera up to its last frame."""
    last = frames.groupBy("camera_name").agg(F.max("frame_id").alias("_last")).filter(F.col("_last") >= every)
    count = F.floor(F.col("_last") / every)
    batches = F.sequence(F.lit(0).cast("long"), F.floor((count - 1) / _BATCH))
    numbers = F.sequence(F.col("_batch") * _BATCH + 1, F.least((F.col("_batch") + 1) * _BATCH, count))
    return (
        last.withColumn("_batch", F.explode(batches)).withColumn("_n", F.explode(numbers))
        .select("camera_name", (F.col("_n") * every).cast("long").alias("frame_id"))
    )


def activity_snapshot(positions: DataFrame, resolved: DataFrame, every: int = SNAPSHOT_FRAMES) -> DataFrame:
    """At every `every`-th frame: tracks on each side, and events saved so far.

    `positions` are read at the snapshot frames only. Events are counted into
    the snapshot that follows them and then added up, so no frame is paired
    with the events before it.
    """
    zero = F.lit(0).cast("long")
    seen = positions.filter(F.col("frame_id") % every == 0).select(
        "camera_name", "frame_id", F.when(F.col("side") == "L", 1).otherwise(0).cast("long").alias("_left"),
        F.when(F.col("side") == "R", 1).otherwise(0).cast("long").alias("_right"), zero.alias("_saved"),
        zero.alias("_shot"))
    saved = resolved.select(
        "camera_name", _next_snapshot(F.col("frame_id"), every).alias("frame_id"), zero.alias("_left"),
        zero.alias("_right"), F.lit(1).cast("long").alias("_saved"), zero.alias("_shot"))
    shots = _snapshots(positions, every).select(
        "camera_name", "frame_id", zero.alias("_left"), zero.alias("_right"), zero.alias("_saved"),
        F.lit(1).cast("long").alias("_shot"))
    counted = (
        seen.unionByName(saved).unionByName(shots).groupBy("camera_name", "frame_id")
        .agg(F.sum("_left").alias("active_left"), F.sum("_right").alias("active_right"),
             F.sum("_saved").alias("_saved"), F.max("_shot").alias("_shot"))
        .filter(F.col("_shot") == 1)
    )
    # frame / every: neighbouring snapshots share a block of the running total
    numbered = stored(counted.withColumn("_n", (F.col("frame_id") / every).cast("long")), "snapshots")
    return (running_total(numbered, F.col("_saved"), "events_saved", "_n", ["camera_name"])
            .select("camera_name", "frame_id", "active_left", "active_right", "events_saved"))


def snapshot_speed_list(frames: DataFrame, tripwire: DataFrame, every: int = SNAPSHOT_FRAMES) -> DataFrame:
    """The tripwire speeds shown at each snapshot, by side, in the order they were measured.

    The list shown at a snapshot is the join of `new_speeds` of all rows up to
    it, with two spaces between the parts. Only what is new is stored: the whole
    list at each snapshot would grow with the square of the feed. `new_speeds`
    is `—` where nothing is new, `speeds_so_far` is the length of the whole list.
    """
    token = F.concat(F.col("side"), F.col("track_id").cast("string"), F.lit("="), fixed_point(F.col("speed_kmh"), 0))
    entries = tripwire.select(
        "camera_name", "side", _next_snapshot(F.col("second_frame"), every).alias("frame_id"),
        F.struct("second_frame", "track_id", token.alias("token")).alias("_entry"))
    # collect_list skips nulls, so the snapshots themselves add no entry
    shots = (_snapshots(frames, every).withColumn("side", F.explode(F.array(F.lit("L"), F.lit("R"))))
             .withColumn("_entry", F.lit(None).cast(entries.schema["_entry"].dataType)).withColumn("_shot", F.lit(1)))
    lists = (
        entries.withColumn("_shot", F.lit(0)).unionByName(shots.select(*entries.columns, "_shot"))
        .groupBy("camera_name", "side", "frame_id")
        .agg(F.sort_array(F.collect_list("_entry")).alias("_entries"), F.max("_shot").alias("_shot"))
        .filter(F.col("_shot") == 1)
        .withColumn("_n", (F.col("frame_id") / every).cast("long"))
    )
    size = F.size("_entries").cast("long")
    text = F.when(size > 0, F.array_join(F.col("_entries.token"), "  ")).otherwise(NO_SPEEDS)
    lines = lists.select("camera_name", "side", "frame_id", "_n", size.alias("_new"), text.alias("new_speeds"))
    return (
        running_total(stored(lines, "speed-lists"), F.col("_new"), "speeds_so_far", "_n", ["camera_name", "side"])
        .select("camera_name", "side", "frame_id", "new_speeds", "speeds_so_far")
    )


def snapshot_speeds_at(lists: DataFrame, asked: DataFrame, every: int = SNAPSHOT_FRAMES) -> DataFrame:
    """The whole list a viewer saw at the asked snapshots (camera_name, frame_id), by side: camera_name, side, frame_id, speeds.

    `lists`: rows of `snapshot_speed_list`. A part stands in every node of a binary-indexed tree that covers its snapshot, an
    asked snapshot reads the few nodes that make up all before it. So each part meets each asked list once, by equality of
    nodes, and no node is stored as one row. Repeated questions are one. `—` where nothing was measured yet; snapshots that
    `lists` does not have give no row.
    """
    number = (F.col("frame_id") / every).cast("long")
    shots = lists.select("camera_name", "side", "frame_id").join(asked.select("camera_name", "frame_id").distinct(), ["camera_name", "frame_id"])
    shots = stored(shots.withColumn("_n", number), "asked-lists")
    top = shots.agg(F.max("_n")).first()[0] or 0
    levels = F.sequence(F.lit(0), F.lit(top.bit_length()))
    before = F.transform(levels, lambda k: F.call_function("shiftleft", F.call_function("shiftright", F.col("_n"), k), k))
    width = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), k)
    around = F.transform(levels, lambda k: F.ceil(F.col("_n") / width(k)) * width(k))
    parts = lists.filter(F.col("new_speeds") != NO_SPEEDS).select(
        "camera_name", "side", number.alias("_n"), F.struct(number.alias("n"), F.col("new_speeds").alias("text")).alias("_part"))
    parts = parts.filter(F.col("_n") <= top).select(
        "camera_name", "side", "_part", F.explode(F.array_distinct(F.filter(around, lambda v: v <= top))).alias("_node"))
    read = shots.select("camera_name", "side", "frame_id", F.explode(F.array_distinct(before)).alias("_node"))
    # node 0 has no part, so that an empty list keeps its row
    whole = read.join(parts, ["camera_name", "side", "_node"], "left").groupBy("camera_name", "side", "frame_id").agg(
        F.sort_array(F.collect_list("_part")).alias("_parts"))
    text = F.when(F.size("_parts") > 0, F.array_join(F.col("_parts.text"), "  ")).otherwise(NO_SPEEDS)
    return whole.select("camera_name", "side", "frame_id", text.alias("speeds"))


def session_totals(positions: DataFrame, resolved: DataFrame) -> DataFrame:
    """Frames processed and events saved by each camera."""
    frames = positions.select("camera_name", "frame_id", F.lit(0).cast("long").alias("_saved"))
    saved = resolved.select("camera_name", F.lit(None).cast("long").alias("frame_id"),
                            F.lit(1).cast("long").alias("_saved"))
    return frames.unionByName(saved).groupBy("camera_name").agg(
        F.max("frame_id").alias("frames_processed"), F.sum("_saved").alias("events_saved"))
