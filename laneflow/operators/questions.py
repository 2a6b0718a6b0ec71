"""The per-lane questions, for a table and for a stream alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laneflow.config import CAR_LIMIT_KMH, TRUCK_LIMIT_KMH, WATERMARK, WINDOW_S
from laneflow.functions.text import window_line
from laneflow.functions.timing import in_some_window, tumbling, window_index


def q1_vehicle_speeds(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every measured speed, one row per event."""
    return events.select(*keep, "vehicle_id", "carriageway", "vehicle_type", "speed_kmh", "speed_source", "segment")


def q2_vehicles_per_lane(events: DataFrame, exact: bool = True) -> DataFrame:
    """Vehicles per lane. A stream needs `exact=False`: Spark counts distinct values there by sketch only."""
    return events.groupBy("carriageway").agg(_vehicles(exact).alias("vehicle_count"))


def violation(car_limit: float = CAR_LIMIT_KMH, truck_limit: float = TRUCK_LIMIT_KMH) -> Column:
    """Above the limit of its type; all but trucks have the limit of cars, an unknown null type has none."""
    kind, speed = F.col("vehicle_type"), F.col("speed_kmh")
    return ((kind == "truck") & (speed > truck_limit)) | ((kind != "truck") & (speed > car_limit))


def q3_speed_violations(events: DataFrame, car_limit: float = CAR_LIMIT_KMH,
                        truck_limit: float = TRUCK_LIMIT_KMH) -> DataFrame:
    """Violating events per lane and type."""
    return (events.filter(violation(car_limit, truck_limit))
            .groupBy("carriageway", "vehicle_type").agg(F.count(F.lit(1)).alias("violation_count")))


def q3_total(events: DataFrame, car_limit: float = CAR_LIMIT_KMH, truck_limit: float = TRUCK_LIMIT_KMH) -> DataFrame:
    """Violating events in all."""
    return events.filter(violation(car_limit, truck_limit)).agg(F.count(F.lit(1)).alias("violation_count"))


def without_window(events: DataFrame, window_s: int = WINDOW_S) -> DataFrame:
    """Events that questions 5 and 6 leave out, in a table or a stream: no time, or one that no window can hold."""
    return events.filter(~in_some_window(window_s=window_s))


def _timed(events: DataFrame, window_s: int, watermark: str) -> DataFrame:
    return events.filter(in_some_window(window_s=window_s)).withWatermark("event_time", watermark)


def q5_vehicles_per_window(events: DataFrame, window_s: int = WINDOW_S, watermark: str = WATERMARK,
                           exact: bool = True) -> DataFrame:
    """Vehicles per lane and window.

    Exact in a stream too: there the (window, lane, vehicle) triples are made
    unique first, and the state of a window goes away with the watermark.
    """
    timed = _timed(events, window_s, watermark)
    if exact and events.isStreaming:
        timed = timed.select("event_time", "carriageway", "vehicle_id", tumbling(window_s=window_s).alias("window"))
        # a missing id is no vehicle, but it keeps its lane's window alive
        timed = timed.dropDuplicates(["window", "carriageway", "vehicle_id"])
        grouped = timed.groupBy("window", "carriageway").agg(F.count("vehicle_id").alias("vehicle_count"))
    else:
        grouped = (timed.groupBy(tumbling(window_s=window_s).alias("window"), "carriageway")
                   .agg(_vehicles(exact).alias("vehicle_count")))
    return grouped.select(
        "carriageway",
        "vehicle_count",
        F.col("window.start").alias("window_start"),
        window_index(F.col("window.start"), window_s).alias("window_index"),
    )


def q6_avg_speed(events: DataFrame, window_s: int = WINDOW_S, watermark: str = WATERMARK) -> DataFrame:
    """Mean speed per lane and window, in whole km/h."""
    return (
        _timed(events, window_s, watermark)
        .groupBy(tumbling(window_s=window_s).alias("window"), "carriageway")
        .agg(F.avg("speed_kmh").alias("mean"))
        .select(
            "carriageway",
            F.round("mean", 0).cast("int").alias("avg_speed_kmh"),
            window_index(F.col("window.start"), window_s).alias("window_index"),
        )
    )


def q6_log(events: DataFrame, window_s: int = WINDOW_S, watermark: str = WATERMARK) -> DataFrame:
    """The mean speeds as log lines such as `(inbound, 3rd 5min, 72kmh)`."""
    line = window_line(F.col("carriageway"), F.col("window_index"), F.col("avg_speed_kmh"))
    return (q6_avg_speed(events, window_s, watermark)
            .select(line.alias("log_entry"), "carriageway", "window_index", "avg_speed_kmh"))


def _vehicles(exact: bool) -> Column:
    return F.count_distinct("vehicle_id") if exact else F.approx_count_distinct("vehicle_id")
