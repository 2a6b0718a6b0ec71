"""The whole way from the boxes of a camera feed to vehicle events, for stored boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame

from laneflow.operators.detections import detections_clean, vehicle_class
from laneflow.operators.tracker import assign_tracks
from laneflow.operators.trajectories import resolved_events
from laneflow.sources.cameras import positions_calibrated


def boxes_to_events(boxes: DataFrame, cameras: DataFrame, positions_path: str) -> DataFrame:
    """Boxes to resolved events, one per vehicle. Writes the track positions to `positions_path`.

    Everything after the tracker reads its rows several times; stored, they are tracked once, and a lost executor costs
    a scan instead of a new walk.
    """
    spark = boxes.sparkSession
    clean = detections_clean(boxes, cameras)
    tracks = assign_tracks(clean)
    tracks.write.mode("overwrite").partitionBy("camera_name").parquet(positions_path)
    positions = spark.read.schema(tracks.schema).parquet(positions_path)
    return resolved_events(positions_calibrated(vehicle_class(positions, clean), cameras))
