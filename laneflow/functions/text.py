"""Texts of the reports and log lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from laneflow.config import ALERT_LINE, TRACKER_ALERT_LINE
from laneflow.functions.numbers import fixed_point


def ordinal(n: Column) -> Column:
    """1 -> 1st, 2 -> 2nd, 3 -> 3rd, 4 -> 4th, 11 -> 11th, 21 -> 21st."""
    ten, hundred = F.pmod(n, F.lit(10)), F.pmod(n, F.lit(100))
    ending = (
        F.when(hundred.between(11, 13), "th")
        .when(ten == 1, "st").when(ten == 2, "nd").when(ten == 3, "rd")
        .otherwise("th")
    )
    return F.concat(n.cast("string"), ending)


def window_line(lane: Column, index: Column, speed: Column) -> Column:
    """`(inbound, 3rd 5min, 72kmh)`; a null part is left out."""
    parts = F.concat_ws(
        ", ", lane, F.concat(ordinal(index), F.lit(" 5min")), F.concat(speed.cast("string"), F.lit("kmh"))
    )
    return F.concat(F.lit("("), parts, F.lit(")"))


def alert_line(number: Column, camera: Column, vehicle_type: Column, vehicle_id: Column,
               speed: Column, lane: Column) -> Column:
    """Log line of the alert job."""
    return F.format_string(
        ALERT_LINE,
        number, camera, F.upper(vehicle_type), vehicle_id, fixed_point(speed, 1), lane,
    )


def tracker_alert_line(camera: Column, vehicle_type: Column, vehicle_id: Column,
                       speed: Column, direction: Column) -> Column:
    """Log line of the tracking job."""
    return F.format_string(
        TRACKER_ALERT_LINE,
        camera, F.upper(vehicle_type), vehicle_id, fixed_point(speed, 1), direction,
    )


def speed_label(vehicle_type: Column, vehicle_id: Column, exact: Column, estimate: Column) -> Column:
    """`CAR #7  93 km/h`, `CAR #7  ~93 km/h` for an estimate, `CAR #7` without a speed."""
    head = F.concat(F.upper(vehicle_type), F.lit(" #"), vehicle_id.cast("string"))
    return (
        F.when(exact.isNotNull(), F.concat(head, F.lit("  "), exact.cast("int").cast("string"), F.lit(" km/h")))
        .when(estimate.isNotNull(),
              F.concat(head, F.lit("  ~"), estimate.cast("int").cast("string"), F.lit(" km/h")))
        .otherwise(head)
    )
