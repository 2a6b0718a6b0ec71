"""Boxes of single frames: cleaning, classes, matches between frames."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laneflow.config import MAX_MATCH_PX, MIN_AREA_PX, TRUCK_MIN_AREA_PX
from laneflow.functions.geometry import box_middle, euclidean, size_class
from laneflow.operators.blocks import HALO, all_of, in_blocks
from laneflow.operators.tripwires import ORDER, by_frame
from laneflow.schemas import LIVE_KEYS
from laneflow.sources.cameras import with_camera

_PLACE = ("camera_name", "frame_id", "side")


def detections_clean(detections: DataFrame, cameras: DataFrame, min_area: float = MIN_AREA_PX) -> DataFrame:
    """Boxes that are large enough, with their centre and side of the road."""
    centred = (
        detections.filter(F.col("area") >= min_area)
        .withColumn("cx", box_middle(F.col("x"), F.col("w")))
        .withColumn("cy", box_middle(F.col("y"), F.col("h")))
    )
    side = F.when(F.col("cx") < F.col("split"), "L").otherwise("R")
    return with_camera(centred, cameras, "split").withColumn("side", side).drop("split")


def vehicle_class(positions: DataFrame, boxes: DataFrame, truck_area: int = TRUCK_MIN_AREA_PX,
                  keys: Sequence[str] = LIVE_KEYS, block: int | None = None) -> DataFrame:
    """Positions with `vehicle_type`, car or truck by the nearest box of the track's side; null while unknown.

    Nearest is by |dx| + |dy|, ties go to the lowest `box_id`. In a frame without boxes on its side a track keeps its
    class. The boxes of a frame and side travel as one array, which a frame's image bounds.
    """
    classed = _nearest_class(positions, boxes, truck_area)
    rows = in_blocks(classed, keys, ORDER, 1, block, history=F.col("_class").isNotNull())
    so_far = by_frame(keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (rows.withColumn("vehicle_type", F.last("_class", ignorenulls=True).over(so_far))
            .filter(~F.col(HALO)).select(*positions.columns, "vehicle_type"))


def _nearest_class(positions: DataFrame, boxes: DataFrame, truck_area: int) -> DataFrame:
    """Positions with `_class`, the class of the nearest box of their frame and side; null without one."""
    is_truck = size_class(F.col("w"), F.col("h"), truck_area) == "truck"
    frames = boxes.groupBy(*[F.col(c).alias(f"_at_{c}") for c in _PLACE]).agg(
        F.collect_list(F.struct("cx", "cy", "box_id", is_truck.alias("truck"))).alias("_boxes"))
    here = all_of(F.col(c) == F.col(f"_at_{c}") for c in _PLACE)
    ranked = F.transform("_boxes", lambda b: F.struct(
        (F.abs(F.col("cx") - b["cx"]) + F.abs(F.col("cy") - b["cy"])).alias("apart"), b["box_id"].alias("box_id"), b["truck"].alias("truck")))
    nearest = F.array_min(ranked)["truck"]
    return positions.join(frames, here, "left").select(
        *positions.columns, F.when(nearest, "truck").when(~nearest, "car").alias("_class"))


def match_candidates(centred: DataFrame, max_dist: float = MAX_MATCH_PX) -> DataFrame:
    """Pairs of boxes in neighbouring frames that may be the same vehicle.

    Boxes meet only within their own and the adjoining cells of a grid as wide
    as the match distance.
    """
    size = ceil(max_dist)
    columns = ["camera_name", "side", "frame_id"]
    cell_x, cell_y = F.floor(F.col("cx") / size), F.floor(F.col("cy") / size)
    before = centred.select(
        *columns, F.col("box_id").alias("box_before"), F.col("cx").alias("_x0"), F.col("cy").alias("_y0"),
        cell_x.alias("_cell_x"), cell_y.alias("_cell_y"))
    around = F.array(*[F.lit(d) for d in (-1, 0, 1)])
    after = (
        centred.select("camera_name", "side", (F.col("frame_id") - 1).alias("frame_id"),
                       F.col("box_id").alias("box_after"), F.col("cx").alias("_x1"), F.col("cy").alias("_y1"),
                       cell_x.alias("_own_x"), cell_y.alias("_own_y"))
        .withColumn("_dx", F.explode(around)).withColumn("_dy", F.explode(around))
        .withColumn("_cell_x", F.col("_own_x") + F.col("_dx")).withColumn("_cell_y", F.col("_own_y") + F.col("_dy"))
    )
    distance = euclidean(F.col("_x0"), F.col("_y0"), F.col("_x1"), F.col("_y1"))
    return (
        before.join(after, [*columns, "_cell_x", "_cell_y"])
        .withColumn("distance_px", distance).filter(F.col("distance_px") <= max_dist)
        .select(*columns, "box_before", "box_after", "distance_px")
    )
