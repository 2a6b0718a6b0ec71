"""Offline analysis of a camera that looks along the road: perspective, speeds, report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laneflow.config import CLASS_NAMES, FPS, REPORT_SPEEDS, ROAD_PLANE, ZONE_GAP_FRAMES, ZONE_MARGIN_PX, RoadPlane
from laneflow.functions.geometry import (
    KMH_PER_MS, class_name, corrected_distance, effect_percent, foot_point, kmh, naive_distance, project,
)
from laneflow.functions.numbers import fixed_point
from laneflow.functions.text import speed_label
from laneflow.operators.blocks import HALO, in_blocks
from laneflow.operators.tripwires import (
    ORDER, crossings_carried, lap_seconds, mark_crossings, pair_crossings, with_history,
)
from laneflow.schemas import OFFLINE_KEYS


def class_filter(detections: DataFrame) -> DataFrame:
    """Boxes of vehicles, with the name of their class."""
    return (detections.filter(F.col("class_id").isin(*CLASS_NAMES))
            .withColumn("vehicle_type", class_name(F.col("class_id"))))


def bev_positions(boxes: DataFrame, plane: RoadPlane = ROAD_PLANE) -> DataFrame:
    """Boxes with their foot point, in pixels and in metres on the road."""
    foot_x, foot_y = foot_point(F.col("x"), F.col("y"), F.col("w"), F.col("h"))
    footed = boxes.withColumn("foot_x", foot_x).withColumn("foot_y", foot_y)
    bev_x, bev_y = project(plane, F.col("foot_x"), F.col("foot_y"))
    return footed.withColumn("bev_x", bev_x).withColumn("bev_y", bev_y)


def with_road_lines(rows: DataFrame, plane: RoadPlane = ROAD_PLANE) -> DataFrame:
    """Adds the two lines across the road, for crossings of variant y."""
    return (rows.withColumn("first_line", F.lit(plane.line_1[2]))
            .withColumn("second_line", F.lit(plane.line_2[2])))


def tripwire_distances(cameras: DataFrame, plane: RoadPlane = ROAD_PLANE) -> DataFrame:
    """Distance between the lines, corrected and naive, for each camera name given."""
    corrected, naive = corrected_distance(plane), naive_distance(plane)
    return cameras.select(
        "camera_name", corrected.alias("corrected_m"), naive.alias("naive_m"),
        effect_percent(corrected, naive).alias("effect_pct"),
    )


def road_traces(boxes: DataFrame, plane: RoadPlane = ROAD_PLANE, fps: float = FPS,
                keys: Sequence[str] = OFFLINE_KEYS, block: int | None = None) -> DataFrame:
    """Every vehicle and frame with the speeds known by then.

    `corrected_kmh` and `naive_kmh` from the frame of the second crossing on;
    before it `bev_kmh`, the shift on the road over the last second, once there
    is more than half a second of positions.
    """
    kept = int(fps)
    needed = with_road_lines(bev_positions(boxes, plane), plane).select(
        *keys, ORDER, "vehicle_type", "foot_y", "bev_y", "first_line", "second_line")
    rows = in_blocks(needed, keys, ORDER, kept - 1, block, carried=crossings_carried("foot_y", "y", keys))
    rows = with_history(mark_crossings(rows, "foot_y", "y", keys), "bev_y", kept, keys)
    rows = pair_crossings(rows, keys).filter(~F.col(HALO))
    timed = F.col(ORDER) >= F.col("second_frame")
    seconds = F.col("history_rows") / F.lit(fps)
    sample = F.abs(F.col("bev_y") - F.col("history_start")) / seconds * KMH_PER_MS
    return rows.select(
        *keys, ORDER, "vehicle_type", "foot_y",
        F.when(timed, kmh(corrected_distance(plane), lap_seconds(fps))).alias("corrected_kmh"),
        F.when(timed, kmh(naive_distance(plane), lap_seconds(fps))).alias("naive_kmh"),
        F.when((F.col("history_rows") > fps / 2) & ~F.coalesce(timed, F.lit(False)), sample).alias("bev_kmh"),
    )


def bev_speeds(traces: DataFrame, keys: Sequence[str] = OFFLINE_KEYS) -> DataFrame:
    """All speed samples on the road plane."""
    return traces.filter(F.col("bev_kmh").isNotNull()).select(*keys, ORDER, "bev_kmh")


def position_labels(traces: DataFrame, keys: Sequence[str] = OFFLINE_KEYS) -> DataFrame:
    """Text shown at each vehicle: exact speed, `~` estimate, or the name alone."""
    label = speed_label(F.col("vehicle_type"), F.col("track_id"), F.col("corrected_kmh"), F.col("bev_kmh"))
    return traces.select(*keys, ORDER, label.alias("label"))


def frame_axis(boxes: DataFrame, gap: int = ZONE_GAP_FRAMES) -> DataFrame:
    """Every frame of each camera from its first box to its last, with or without boxes.

    Where no box comes for more than `gap` frames the feed was off: the frames between are left out. The axis is
    made from one row per camera and `gap` frames, so no row grows with the feed and a far-off number makes no endless axis.
    """
    block = F.floor(F.col(ORDER) / F.lit(gap))
    blocks = boxes.filter(F.col(ORDER).isNotNull()).groupBy("camera_name", block.alias("_block")).agg(
        F.min(ORDER).alias("_first"), F.max(ORDER).alias("_last"))
    following = F.lead("_first").over(W.partitionBy("camera_name").orderBy("_first"))
    until = F.when(F.expr("try_subtract(_next, _last)") <= gap, F.col("_next") - 1).otherwise(F.col("_last"))
    return blocks.withColumn("_next", following).select("camera_name", F.explode(F.sequence("_first", until)).alias(ORDER))


def zone_occupancy(boxes: DataFrame, plane: RoadPlane = ROAD_PLANE, margin: int = ZONE_MARGIN_PX,
                   gap: int = ZONE_GAP_FRAMES) -> DataFrame:
    """Per frame: vehicles shown (lines with a margin) and vehicles between the lines; 0 in a frame without vehicles or boxes.

    `boxes` are those of all classes. Frames without boxes come from `frame_axis`; they join the boxes in the one
    aggregation by frame.
    """
    vehicle = F.col("class_id").isin(*CLASS_NAMES)
    y, line_1, line_2 = F.col("foot_y"), plane.line_1[2], plane.line_2[2]
    marked = bev_positions(boxes, plane).select(
        "camera_name", ORDER, (vehicle & y.between(line_1 - margin, line_2 + margin)).alias("shown"),
        (vehicle & y.between(line_1, line_2)).alias("in_zone"))
    empty = frame_axis(boxes, gap).select("camera_name", ORDER, F.lit(False).alias("shown"), F.lit(False).alias("in_zone"))
    return marked.unionByName(empty).groupBy("camera_name", ORDER).agg(
        F.count_if("shown").alias("shown"), F.count_if("in_zone").alias("in_zone"))


def vehicle_report(traces: DataFrame) -> DataFrame:
    """One row per vehicle with a speed of either kind; the other kind stays null.

    Both kinds come from the same rows, so their union by vehicle is one
    aggregate instead of a full outer join.
    """
    # The class is the one of the latest frame; the exact speeds are the same in all rows that have them.
    return (
        traces.groupBy("camera_name", F.col("track_id").alias("vehicle_id")).agg(
            F.max_by("vehicle_type", ORDER).alias("vehicle_type"),
            F.max("corrected_kmh").alias("tripwire_speed_corrected_kmh"),
            F.max("naive_kmh").alias("tripwire_speed_naive_kmh"),
            F.avg("bev_kmh").alias("bev_avg_speed_kmh"),
            F.min("bev_kmh").alias("bev_min_speed_kmh"),
            F.max("bev_kmh").alias("bev_max_speed_kmh"),
        )
        .filter(F.col("tripwire_speed_corrected_kmh").isNotNull() | F.col("bev_avg_speed_kmh").isNotNull())
    )


def report_text(report: DataFrame) -> DataFrame:
    """The report as it is written: one digit, empty where there is no speed."""
    return report.select("camera_name", "vehicle_id", "vehicle_type", *[
        F.coalesce(fixed_point(F.col(c), 1), F.lit("")).alias(c) for c in REPORT_SPEEDS])


def run_summary(report: DataFrame) -> DataFrame:
    """Vehicles measured by each method, mean exact speeds, effect of the perspective correction."""
    corrected, naive = F.avg("tripwire_speed_corrected_kmh"), F.avg("tripwire_speed_naive_kmh")
    return report.agg(
        F.count("tripwire_speed_corrected_kmh").alias("tripwire_vehicles"),
        F.count("bev_avg_speed_kmh").alias("bev_vehicles"),
        corrected.alias("mean_corrected_kmh"),
        naive.alias("mean_naive_kmh"),
        effect_percent(corrected, naive).alias("effect_pct"),
    )


def measured_vehicle_ids(*speeds: DataFrame, keys: Sequence[str] = OFFLINE_KEYS) -> DataFrame:
    """Vehicles that occur in any of the given tables, each once."""
    first, *others = [s.select(*keys) for s in speeds]
    for other in others:
        first = first.unionByName(other)
    return first.distinct()
