"""Speeds, movement and the one resolved event of each track."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laneflow.config import (
    FPS, HISTORY_MIN_ROWS, HISTORY_ROWS, MOVEMENT_MIN_ROWS, MOVEMENT_PX, SPEED_HIGH_KMH, SPEED_LOW_KMH,
)
from laneflow.functions.geometry import KMH_PER_MS, kmh
from laneflow.operators.blocks import BLOCK, HALO, in_blocks
from laneflow.operators.tripwires import ORDER, lap_per_track, lap_seconds, mark_crossings, with_history
from laneflow.schemas import LIVE_KEYS


def displacement_kmh(fps: float = FPS, min_pts: int = HISTORY_MIN_ROWS,
                     lo: float = SPEED_LOW_KMH, hi: float = SPEED_HIGH_KMH) -> Column:
    """Speed from the shift over the kept positions; null if they are too few or the speed is out of range."""
    shift = F.abs(F.col("cx") - F.col("history_start")).cast("double")
    steps = (F.col("history_rows") - 1).cast("double")
    speed = F.when(F.col("history_rows") >= min_pts,
                   shift / steps / F.col("px_per_m") * F.lit(fps) * KMH_PER_MS)
    return F.when((speed > lo) & (speed < hi), speed)


def movement_of(min_pts: int = MOVEMENT_MIN_ROWS, threshold: int = MOVEMENT_PX) -> Column:
    shift = F.col("cx") - F.col("history_start")
    return (
        F.when(F.col("history_rows") < min_pts, "unknown")
        .when(shift > threshold, "right").when(shift < -threshold, "left")
        .otherwise("unknown")
    )


def displacement_speeds(calibrated: DataFrame, window: int = HISTORY_ROWS, min_pts: int = HISTORY_MIN_ROWS,
                        fps: float = FPS, lo: float = SPEED_LOW_KMH, hi: float = SPEED_HIGH_KMH,
                        keys: Sequence[str] = LIVE_KEYS, block: int | None = None) -> DataFrame:
    """Every valid displacement speed, by track and frame."""
    needed = calibrated.select(*keys, ORDER, "cx", "px_per_m")
    rows = with_history(in_blocks(needed, keys, ORDER, window - 1, block), "cx", window, keys)
    return (
        rows.withColumn("speed_kmh", displacement_kmh(fps, min_pts, lo, hi))
        .filter(F.col("speed_kmh").isNotNull() & ~F.col(HALO))
        .select(*keys, ORDER, "history_rows", "speed_kmh")
    )


def movement(positions: DataFrame, window: int = HISTORY_ROWS, min_pts: int = MOVEMENT_MIN_ROWS,
             threshold: int = MOVEMENT_PX, keys: Sequence[str] = LIVE_KEYS,
             block: int | None = None) -> DataFrame:
    """left, right or unknown for every track and frame."""
    needed = positions.select(*keys, ORDER, "cx")
    rows = with_history(in_blocks(needed, keys, ORDER, window - 1, block), "cx", window, keys)
    return rows.filter(~F.col(HALO)).select(*keys, ORDER, movement_of(min_pts, threshold).alias("movement"))


def resolved_events(calibrated: DataFrame, policy: str = "first_resolved", fps: float = FPS,
                    keys: Sequence[str] = LIVE_KEYS, block: int | None = None) -> DataFrame:
    """One event per track, taken when its speed is first known.

    A tripwire speed wins over a displacement speed of the same frame. Later
    speeds are ignored. With `prefer_tripwire` a tripwire speed wins whenever
    the track has one. The event time is the first crossing, or 0 for a
    displacement speed.

    All windows share one exchange of the positions; each track or block is
    reduced to one row before the second, small exchange.
    """
    if policy not in ("first_resolved", "prefer_tripwire"):
        raise ValueError(f"unknown policy {policy!r}")
    needed = calibrated.select(*keys, ORDER, "cx", "first_line", "second_line", "dist_m", "px_per_m",
                               "direction", "vehicle_type")
    rows = in_blocks(needed, keys, ORDER, HISTORY_ROWS - 1, block)
    rows = with_history(mark_crossings(rows, "cx", "x", keys), "cx", HISTORY_ROWS, keys)
    rows = rows.filter(~F.col(HALO)).select(
        *keys, BLOCK, ORDER, "crossed_1", "crossed_2", "dist_m", "direction",
        displacement_kmh(fps).alias("_shift_kmh"), movement_of().alias("movement"),
        F.coalesce("vehicle_type", F.lit("unknown")).alias("vehicle_type"))
    # only crossings and the first displacement speed of a track or block matter from here on
    first_shift = F.min(F.when(F.col("_shift_kmh").isNotNull(), F.col(ORDER))).over(
        Window.partitionBy(*keys, BLOCK))
    rows = rows.withColumn("_is_shift", F.coalesce(F.col(ORDER) == first_shift, F.lit(False)))
    rows = rows.filter(F.col("crossed_1") | F.col("crossed_2") | F.col("_is_shift"))
    seen = ("movement", "vehicle_type", "direction")
    shift = F.when(F.col("_is_shift"), F.struct(F.col(ORDER), F.col("_shift_kmh").alias("speed_kmh"), *seen))
    tracks = lap_per_track(rows, keys, ["dist_m", *seen], also={"shift": shift})
    by_line = F.col("second").isNotNull()
    if policy == "first_resolved":
        by_line &= F.col("shift").isNull() | (F.col("second.second_frame") <= F.col(f"shift.{ORDER}"))
    line_kmh = kmh(F.col("second.dist_m"), lap_seconds(fps, "second.second_frame"))

    def either(line: Column, shifted: Column) -> Column:
        return F.when(by_line, line).otherwise(shifted)

    return tracks.filter(F.col("second").isNotNull() | F.col("shift").isNotNull()).select(
        *keys,
        F.concat(F.col("side"), F.col("track_id").cast("string")).alias("vehicle_id"),
        either(F.col("second.vehicle_type"), F.col("shift.vehicle_type")).alias("vehicle_type"),
        either(line_kmh, F.col("shift.speed_kmh")).alias("speed_kmh"),
        either(F.col("second.direction"), F.col("shift.direction")).alias("direction"),
        either(F.col("second.movement"), F.col("shift.movement")).alias("movement"),
        either(F.lit("tripwire"), F.lit("displacement")).alias("speed_source"),
        either(F.col("first_frame") / F.lit(fps), F.lit(0.0)).alias("timestamp_s"),
        either(F.col("second.second_frame"), F.col(f"shift.{ORDER}")).alias(ORDER),
    )


def as_messages(resolved: DataFrame) -> DataFrame:
    """Resolved events with the names of the message fields."""
    return resolved.select(
        "vehicle_id", "vehicle_type", "speed_kmh", F.col("direction").alias("carriageway"),
        F.col("camera_name").alias("segment"), "timestamp_s", "speed_source",
    )
