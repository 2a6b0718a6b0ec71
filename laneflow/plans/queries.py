"""The named queries: every operator on the given tables, all rows of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laneflow.config import MAX_SEGMENTS, REPORT_SPEEDS, SPAN_WINDOWS
from laneflow.functions.text import ordinal
from laneflow.functions.timing import event_time
from laneflow.operators import activity, alerts, detections, questions, road, segments, sketches, tracker, trajectories, tripwires
from laneflow.plans import live, streams, views
from laneflow.session import stored, work_folder
from laneflow.sources import cameras, messages

DIGITS = 6


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS) for c in columns})


# --- messages ----------------------------------------------------------------

def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.with_event_time(views.traffic_events(spark, sf_dir))


def encode_events(spark, sf_dir):
    return messages.encode_events(views.traffic_events(spark, sf_dir), keep=("event_id",))


def decode_events(spark, sf_dir):
    return messages.decode_events(encode_events(spark, sf_dir), keep=("event_id",))


def route_events(spark, sf_dir):
    return messages.route_events(measured(spark, sf_dir), keep=("event_id",))


def event_times(spark, sf_dir):
    events = views.traffic_events(spark, sf_dir)
    return events.select("event_id", event_time(F.col("timestamp_s")).alias("event_time"))


def ordinals(spark, sf_dir):
    return views.traffic_events(spark, sf_dir).select("event_id", ordinal(F.col("event_id")).alias("ordinal"))


# --- questions ---------------------------------------------------------------

def q1_vehicle_speeds(spark, sf_dir):
    return questions.q1_vehicle_speeds(measured(spark, sf_dir), keep=("event_id",))


def q2_vehicles_per_lane(spark, sf_dir):
    return questions.q2_vehicles_per_lane(measured(spark, sf_dir))


SKETCH_ERROR = 0.15


def _close(sketched: DataFrame, exact: DataFrame, *keys: str) -> DataFrame:
    """Keys, and whether the sketched count is as close to the exact one as a sketch must be."""
    counted = exact.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("vehicle_count").alias("_exact"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    # one more or less is no error of a small count
    near = F.abs(F.col("vehicle_count") - F.col("_exact")) <= F.greatest(SKETCH_ERROR * F.col("_exact"), F.lit(1.0))
    return sketched.join(counted, same, "left").select(*keys, F.coalesce(near, F.lit(False)).alias("close"))


def q2_approx(spark, sf_dir):
    rows = measured(spark, sf_dir)
    return _close(questions.q2_vehicles_per_lane(rows, exact=False), questions.q2_vehicles_per_lane(rows), "carriageway")


def q3_speed_violations(spark, sf_dir):
    return questions.q3_speed_violations(measured(spark, sf_dir))


def q3_total(spark, sf_dir):
    return questions.q3_total(measured(spark, sf_dir))


def q5_vehicles_per_window(spark, sf_dir):
    return questions.q5_vehicles_per_window(measured(spark, sf_dir))


def q5_approx(spark, sf_dir):
    rows = measured(spark, sf_dir)
    return _close(questions.q5_vehicles_per_window(rows, exact=False), questions.q5_vehicles_per_window(rows),
                  "carriageway", "window_index")


def q2_from_sketches(spark, sf_dir):
    """Vehicles per lane, by stored sketches of its windows."""
    return sketches.vehicles_by(stored(sketches.lane_sketches(measured(spark, sf_dir)), "sketches"), "carriageway")


def q5_hours_from_sketches(spark, sf_dir):
    """Vehicles per lane and hour, by stored sketches of its windows."""
    kept = stored(sketches.lane_sketches(measured(spark, sf_dir)), "sketches")
    return sketches.vehicles_by(sketches.with_span(kept, SPAN_WINDOWS), "carriageway", "span")


def q6_avg_speed(spark, sf_dir):
    return questions.q6_avg_speed(measured(spark, sf_dir))


def q6_log(spark, sf_dir):
    return questions.q6_log(measured(spark, sf_dir))


# --- alerts ------------------------------------------------------------------

def q4_speed_alerts(spark, sf_dir):
    return alerts.q4_speed_alerts(views.alert_messages(spark, sf_dir), keep=("event_id",))


def malformed_alerts(spark, sf_dir):
    return alerts.malformed_alerts(views.alert_messages(spark, sf_dir), keep=("event_id",))


def alert_numbering(spark, sf_dir):
    return alerts.alert_numbering(q4_speed_alerts(spark, sf_dir), "event_id")


def alert_log(spark, sf_dir):
    return alerts.alert_log(alert_numbering(spark, sf_dir), keep=("event_id",))


def alert_total(spark, sf_dir):
    return alerts.alert_total(q4_speed_alerts(spark, sf_dir))


# --- tracks ------------------------------------------------------------------

def positions_calibrated(spark, sf_dir):
    return cameras.positions_calibrated(views.track_positions(spark, sf_dir), cameras.cameras_dim(spark))


def tripwire_crossings(spark, sf_dir):
    return tripwires.tripwire_crossings(positions_calibrated(spark, sf_dir))


def tripwire_crossings_y(spark, sf_dir):
    feet = road.with_road_lines(road.bev_positions(vehicles(spark, sf_dir)))
    return tripwires.tripwire_crossings(feet, "foot_y", "y", keys=("camera_name", "track_id"))


def tripwire_speeds(spark, sf_dir):
    return rounded(tripwires.tripwire_speeds(positions_calibrated(spark, sf_dir)), "speed_kmh")


def displacement_speeds(spark, sf_dir):
    return rounded(trajectories.displacement_speeds(positions_calibrated(spark, sf_dir)), "speed_kmh")


def movement(spark, sf_dir):
    return trajectories.movement(views.track_positions(spark, sf_dir))


def resolved_events(spark, sf_dir):
    return rounded(trajectories.resolved_events(positions_calibrated(spark, sf_dir)), "speed_kmh", "timestamp_s")


def resolved_prefer_tripwire(spark, sf_dir):
    events = trajectories.resolved_events(positions_calibrated(spark, sf_dir), policy="prefer_tripwire")
    return rounded(events, "speed_kmh", "timestamp_s")


def first_seen(spark, sf_dir):
    return activity.first_seen(positions_calibrated(spark, sf_dir))


def _dense(spark, sf_dir):
    return cameras.positions_calibrated(views.dense_positions(spark, sf_dir), cameras.cameras_dim(spark))


def activity_snapshot(spark, sf_dir):
    dense = _dense(spark, sf_dir)
    return activity.activity_snapshot(dense, trajectories.resolved_events(dense))


def snapshot_speeds_at(spark, sf_dir):
    """The whole lists at the snapshots whose number is a power of two, and at the last one of each camera."""
    lists = stored(snapshot_speed_list(spark, sf_dir), "speed-lists")
    number, last = F.col("frame_id") / activity.SNAPSHOT_FRAMES, lists.groupBy("camera_name").agg(F.max("frame_id").alias("frame_id"))
    asked = lists.filter(F.bit_count(number.cast("long")) == 1).select("camera_name", "frame_id").unionByName(last)
    return activity.snapshot_speeds_at(lists, asked)


def snapshot_speed_list(spark, sf_dir):
    dense = _dense(spark, sf_dir)
    return activity.snapshot_speed_list(dense, tripwires.tripwire_speeds(dense))


def session_totals(spark, sf_dir):
    calibrated = positions_calibrated(spark, sf_dir)
    return activity.session_totals(calibrated, trajectories.resolved_events(calibrated))


# --- road plane and report ---------------------------------------------------

def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return road.class_filter(views.tracked_boxes(spark, sf_dir))


def class_filter(spark, sf_dir):
    return vehicles(spark, sf_dir).select("camera_name", "track_id", "frame_id", "class_id", "vehicle_type")


def bev_positions(spark, sf_dir):
    placed = road.bev_positions(vehicles(spark, sf_dir))
    return rounded(placed.select("frame_id", "track_id", "foot_x", "foot_y", "bev_x", "bev_y"), "bev_x", "bev_y")


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return road.road_traces(vehicles(spark, sf_dir))


def tripwire_speeds_y(spark, sf_dir):
    feet = road.with_road_lines(road.bev_positions(vehicles(spark, sf_dir)))
    speeds = tripwires.tripwire_speeds(
        feet, position="foot_y", variant="y", keys=("camera_name", "track_id"),
        distances={"corrected_kmh": road.corrected_distance(road.ROAD_PLANE),
                   "naive_kmh": road.naive_distance(road.ROAD_PLANE)})
    return rounded(speeds, "corrected_kmh", "naive_kmh")


def bev_speeds(spark, sf_dir):
    return rounded(road.bev_speeds(traces(spark, sf_dir)), "bev_kmh")


def position_labels(spark, sf_dir):
    return road.position_labels(traces(spark, sf_dir))


def zone_occupancy(spark, sf_dir):
    return road.zone_occupancy(views.detections(spark, sf_dir))


def vehicle_report(spark, sf_dir):
    report = rounded(road.vehicle_report(traces(spark, sf_dir)), *REPORT_SPEEDS)
    return report.orderBy("vehicle_id", "camera_name")


def vehicle_report_text(spark, sf_dir):
    # six digits first, so that the sum order of a mean cannot flip the last digit shown
    return road.report_text(rounded(road.vehicle_report(traces(spark, sf_dir)), *REPORT_SPEEDS))


def run_summary(spark, sf_dir):
    return rounded(road.run_summary(road.vehicle_report(traces(spark, sf_dir))),
                   "mean_corrected_kmh", "mean_naive_kmh", "effect_pct")


def measured_vehicle_ids(spark, sf_dir):
    # both kinds of speed come from the same rows: one filter instead of a union of two
    measured_rows = traces(spark, sf_dir).filter(F.col("corrected_kmh").isNotNull() | F.col("bev_kmh").isNotNull())
    return road.measured_vehicle_ids(measured_rows)


# --- boxes and segments ------------------------------------------------------

def centred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections.detections_clean(views.detections(spark, sf_dir), cameras.cameras_dim(spark))


def detections_clean(spark, sf_dir):
    return centred(spark, sf_dir).drop("area")


def vehicle_class(spark, sf_dir):
    classed = detections.vehicle_class(views.box_positions(spark, sf_dir), centred(spark, sf_dir))
    return classed.drop("cx", "cy")


def match_candidates(spark, sf_dir):
    return rounded(detections.match_candidates(centred(spark, sf_dir)), "distance_px")


def assign_tracks(spark, sf_dir):
    return tracker.assign_tracks(centred(spark, sf_dir))


def live_events(spark, sf_dir):
    """From boxes to one event per track, with the track positions stored on the way."""
    boxes, known = views.detections(spark, sf_dir), cameras.cameras_dim(spark)
    folder = work_folder(spark, "live")
    return rounded(live.boxes_to_events(boxes, known, f"{folder}/positions"), "speed_kmh", "timestamp_s")


def tracked_boxes(spark, sf_dir):
    """Where tracks have a box of their own: at every box, once."""
    own = assign_tracks(spark, sf_dir).filter(~F.col("coasting"))
    return own.select("camera_name", "side", "frame_id", "cx", "cy")


def stream_tracked_boxes(spark, sf_dir):
    """The same of the streaming tracker."""
    own = streams.stream_tracks(spark, sf_dir).filter(~F.col("coasting"))
    return own.select("camera_name", "side", "frame_id", "cx", "cy")


def _events_each(events: DataFrame) -> DataFrame:
    return events.groupBy("camera_name", "vehicle_id").agg(F.count(F.lit(1)).alias("events"))


def stream_vehicles(spark, sf_dir):
    """The vehicles of the streaming service, with the number of their events."""
    return _events_each(streams.stream_live(spark, sf_dir))


def vehicles_with_events(spark, sf_dir):
    """The vehicles of the live path, with the number of their events."""
    return _events_each(live_events(spark, sf_dir))


def segment_plan(spark, sf_dir):
    return segments.segment_plan(views.videos(spark, sf_dir))


def segment_plan_first(spark, sf_dir):
    """The first pieces of each video only, as many as the splitter makes."""
    return segments.segment_plan(views.videos(spark, sf_dir), max_segments=MAX_SEGMENTS)


def stream_q2(spark, sf_dir):
    """Streams count the vehicles of a lane by sketch."""
    return _close(streams.stream_q2(spark, sf_dir), questions.q2_vehicles_per_lane(measured(spark, sf_dir)), "carriageway")


def segment_assign(spark, sf_dir):
    events = views.traffic_events(spark, sf_dir).select("event_id", "segment", "timestamp_s")
    return segments.segment_assign(events)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "decode_events": decode_events,
    "encode_events": encode_events,
    "route_events": route_events,
    "event_time": event_times,
    "ordinal": ordinals,
    "q1_vehicle_speeds": q1_vehicle_speeds,
    "q2_vehicles_per_lane": q2_vehicles_per_lane,
    "q2_approx": q2_approx,
    "q2_from_sketches": q2_from_sketches,
    "q5_hours_from_sketches": q5_hours_from_sketches,
    "q3_speed_violations": q3_speed_violations,
    "q3_total": q3_total,
    "q4_speed_alerts": q4_speed_alerts,
    "malformed_alerts": malformed_alerts,
    "alert_numbering": alert_numbering,
    "alert_log": alert_log,
    "alert_total": alert_total,
    "q5_vehicles_per_window": q5_vehicles_per_window,
    "q5_approx": q5_approx,
    "q6_avg_speed": q6_avg_speed,
    "q6_log": q6_log,
    "positions_calibrated": positions_calibrated,
    "tripwire_crossings": tripwire_crossings,
    "tripwire_crossings_y": tripwire_crossings_y,
    "tripwire_speeds": tripwire_speeds,
    "tripwire_speeds_y": tripwire_speeds_y,
    "displacement_speeds": displacement_speeds,
    "movement": movement,
    "resolved_events": resolved_events,
    "resolved_prefer_tripwire": resolved_prefer_tripwire,
    "first_seen": first_seen,
    "activity_snapshot": activity_snapshot,
    "snapshot_speed_list": snapshot_speed_list,
    "snapshot_speeds_at": snapshot_speeds_at,
    "session_totals": session_totals,
    "class_filter": class_filter,
    "bev_positions": bev_positions,
    "bev_speeds": bev_speeds,
    "position_labels": position_labels,
    "zone_occupancy": zone_occupancy,
    "vehicle_report": vehicle_report,
    "vehicle_report_text": vehicle_report_text,
    "run_summary": run_summary,
    "measured_vehicle_ids": measured_vehicle_ids,
    "detections_clean": detections_clean,
    "vehicle_class": vehicle_class,
    "match_candidates": match_candidates,
    "assign_tracks": assign_tracks,
    "live_events": live_events,
    "tracked_boxes": tracked_boxes,
    "vehicles_with_events": vehicles_with_events,
    "segment_plan": segment_plan,
    "segment_plan_first": segment_plan_first,
    "segment_assign": segment_assign,
    "stream_q1": streams.stream_q1,
    "stream_q2": stream_q2,
    "stream_q3": streams.stream_q3,
    "stream_q4": streams.stream_q4,
    "stream_malformed": streams.stream_malformed,
    "stream_q5": streams.stream_q5,
    "stream_q6": streams.stream_q6,
    "stream_resolved": streams.stream_resolved,
    "stream_tracks": streams.stream_tracks,
    "stream_tracked_boxes": stream_tracked_boxes,
    "stream_live": streams.stream_live,
    "stream_vehicles": stream_vehicles,
}
