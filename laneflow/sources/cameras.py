"""The camera dimension."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import asdict, fields

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from laneflow import schemas
from laneflow.config import CAMERAS, Camera


def cameras_dim(spark: SparkSession, cameras: Iterable[Camera] = CAMERAS) -> DataFrame:
    """Declared cameras as a table.

    The rows travel by Arrow as a local relation, so the planner knows their
    size and broadcasts them only while they are below its own limit.
    """
    rows = pa.Table.from_pylist([asdict(c) for c in cameras], schema=to_arrow_schema(schemas.CAMERAS))
    return spark.createDataFrame(rows, schema=schemas.CAMERAS)


def with_camera(rows: DataFrame, cameras: DataFrame, *wanted: str) -> DataFrame:
    """Rows with columns of their camera; a camera without settings has the default ones."""
    own = cameras.select(F.col("camera_name").alias("_camera"), *[F.col(c).alias(f"_own_{c}") for c in wanted])
    standard = {f.name: f.default for f in fields(Camera)}
    joined = rows.join(own, F.col("camera_name") == F.col("_camera"), "left")
    return joined.select(*rows.columns, *[
        F.coalesce(F.col(f"_own_{c}"), F.lit(standard[c]).cast(schemas.CAMERAS[c].dataType)).alias(c) for c in wanted])


def of_side(left: str, right: str) -> Column:
    """The camera's value for the carriageway of a row."""
    return F.when(F.col("side") == "L", F.col(left)).otherwise(F.col(right))


def positions_calibrated(positions: DataFrame, cameras: DataFrame) -> DataFrame:
    """Track positions with the lines, scale and lane of their camera and side."""
    return (
        with_camera(positions, cameras, "l1", "l2", "r1", "r2", "dist_m", "px_per_m", "left_label", "right_label")
        .select(
            *positions.columns,
            of_side("l1", "r1").alias("first_line"),
            of_side("l2", "r2").alias("second_line"),
            "dist_m",
            "px_per_m",
            of_side("left_label", "right_label").alias("direction"),
        )
    )
