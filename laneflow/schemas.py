"""Declared schemas. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# One vehicle with a measured speed, as sent in a message.
VEHICLE_EVENT = T.StructType([
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("vehicle_type", T.StringType()),
    T.StructField("speed_kmh", T.DoubleType()),
    T.StructField("carriageway", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("timestamp_s", T.DoubleType()),
    T.StructField("speed_source", T.StringType()),
])

# The same message read by the alert job: all text, so that a speed sent as
# text still counts.
ALERT_MESSAGE = T.StructType([
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("vehicle_type", T.StringType()),
    T.StructField("speed_kmh", T.StringType()),
    T.StructField("carriageway", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("_corrupt", T.StringType()),
])

CAMERAS = T.StructType([
    T.StructField("camera_name", T.StringType()),
    T.StructField("split", T.IntegerType()),
    T.StructField("l1", T.IntegerType()),
    T.StructField("l2", T.IntegerType()),
    T.StructField("r1", T.IntegerType()),
    T.StructField("r2", T.IntegerType()),
    T.StructField("dist_m", T.DoubleType()),
    T.StructField("px_per_m", T.DoubleType()),
    T.StructField("left_label", T.StringType()),
    T.StructField("right_label", T.StringType()),
])

# One detected box in one frame.
DETECTIONS = T.StructType([
    T.StructField("camera_name", T.StringType()),
    T.StructField("frame_id", T.LongType()),
    T.StructField("box_id", T.IntegerType()),
    T.StructField("x", T.IntegerType()),
    T.StructField("y", T.IntegerType()),
    T.StructField("w", T.IntegerType()),
    T.StructField("h", T.IntegerType()),
    T.StructField("area", T.DoubleType()),
    T.StructField("class_id", T.IntegerType()),
])

# One row per track and frame, frames without a matching box included.
TRACK_POSITIONS = T.StructType([
    T.StructField("camera_name", T.StringType()),
    T.StructField("side", T.StringType()),
    T.StructField("track_id", T.LongType()),
    T.StructField("frame_id", T.LongType()),
    T.StructField("cx", T.IntegerType()),
    T.StructField("cy", T.IntegerType()),
    T.StructField("coasting", T.BooleanType()),
    T.StructField("vehicle_type", T.StringType()),
])

# Stored tables. `batch_id` and `camera_name` are partition columns.
VEHICLE_EVENTS_TABLE = T.StructType([
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("vehicle_type", T.StringType()),
    T.StructField("speed_kmh", T.DoubleType()),
    T.StructField("direction", T.StringType()),
    T.StructField("movement", T.StringType()),
    T.StructField("speed_source", T.StringType()),
    T.StructField("recorded_at", T.TimestampType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("camera_name", T.StringType()),
])

SPEED_ALERTS_TABLE = T.StructType([
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("vehicle_type", T.StringType()),
    T.StructField("speed_kmh", T.DoubleType()),
    T.StructField("direction", T.StringType()),
    T.StructField("alerted_at", T.TimestampType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("camera_name", T.StringType()),
])

LIVE_KEYS = ("camera_name", "side", "track_id")
OFFLINE_KEYS = ("camera_name", "track_id")
