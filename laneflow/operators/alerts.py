"""Speed alerts: from messages to numbered log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laneflow import schemas
from laneflow.config import ALERT_DEFAULTS, ALERT_KMH
from laneflow.functions.text import alert_line, tracker_alert_line
from laneflow.operators.blocks import numbered
from laneflow.sources.messages import read_once


def decoded_alerts(raw: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages with `raw_value`, their text fields, the speed as a number and `bad`, the reason to refuse."""
    value = F.col(value_col).cast("string")
    message = F.from_json(value, schemas.ALERT_MESSAGE, {"columnNameOfCorruptRecord": "_corrupt"})
    rows = raw.select(*keep, value.alias("raw_value"), read_once(message))
    speed = F.expr("try_cast(speed_kmh as double)")
    is_object = F.trim("raw_value").rlike(r"(?s)^\{.*\}$")
    finite = speed.isNotNull() & ~F.isnan(speed) & (F.abs(speed) < float("inf"))
    bad = (
        F.when(F.col("raw_value").isNull() | F.col("_corrupt").isNotNull() | ~is_object, "not a JSON object")
        .when(F.col("speed_kmh").isNotNull() & ~finite, "speed is not a number")
    )
    return rows.withColumn("bad", bad).withColumn("speed_kmh", F.coalesce(speed, F.lit(0.0)))


def _or_default(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(ALERT_DEFAULTS[name]))


def q4_speed_alerts(raw: DataFrame, threshold: float = ALERT_KMH, value_col: str = "value",
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Alerts at or above the threshold.

    The router sends what is above it before rounding, so a message may carry
    the threshold itself. Missing and null fields get stand-ins, a missing
    speed counts as 0.
    """
    return usable_alerts(decoded_alerts(raw, value_col, keep), threshold, keep)


def usable_alerts(decoded: DataFrame, threshold: float = ALERT_KMH, keep: tuple[str, ...] = ()) -> DataFrame:
    """The alerts among decoded messages."""
    return (
        decoded.filter(F.col("bad").isNull() & (F.col("speed_kmh") >= threshold))
        .select(
            *keep,
            _or_default("segment").alias("camera_name"),
            _or_default("vehicle_id").alias("vehicle_id"),
            _or_default("vehicle_type").alias("vehicle_type"),
            "speed_kmh",
            _or_default("carriageway").alias("direction"),
        )
    )


def malformed_alerts(raw: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Alert messages that cannot be used, as they came, with the reason."""
    return unusable_alerts(decoded_alerts(raw, value_col, keep), keep)


def unusable_alerts(decoded: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The messages that could not be decoded."""
    return (decoded.filter(F.col("bad").isNotNull())
            .select(*keep, F.col("raw_value").alias("value"), F.col("bad").alias("reason")))


def alert_numbering(alerts: DataFrame, order: str) -> DataFrame:
    """Alerts with `alert_no`, 1 for the first in the order of arrival.

    `order` is a number or time that no two alerts share, spaced in any way. The alerts are stored in ranges of it: their
    messages are decoded once.
    """
    return numbered(alerts, order, "alert_no")


def alert_log(numbered: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Log lines of the alert job (`log_line`) and of the tracking job (`tracker_line`)."""
    camera, kind, vehicle = F.col("camera_name"), F.col("vehicle_type"), F.col("vehicle_id")
    speed, lane = F.col("speed_kmh"), F.col("direction")
    return numbered.select(
        *keep,
        "alert_no",
        alert_line(F.col("alert_no"), camera, kind, vehicle, speed, lane).alias("log_line"),
        tracker_alert_line(camera, kind, vehicle, speed, lane).alias("tracker_line"),
    )


def alert_total(alerts: DataFrame) -> DataFrame:
    """How many alerts there are; in a stream the running counter."""
    return alerts.agg(F.count(F.lit(1)).alias("alert_count"))
