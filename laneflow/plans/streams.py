"""The streaming jobs on the given tables: each reads `events` as a stream to its end into a table.

The tables and checkpoints lie in the shared work folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from laneflow import schemas
from laneflow.config import QUESTION_STREAMS, StreamSettings
from laneflow.operators import detections
from laneflow.plans import views
from laneflow.session import work_folder
from laneflow.sources import cameras, feeds
from laneflow.sources.messages import with_event_time
from laneflow.streaming import jobs, sinks
from laneflow.streaming.state import ASSIGNED, tracks_stream, with_ends


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = views.table(spark, sf_dir, "events").schema
    return feeds.table_feed(spark, f"{sf_dir}/events.parquet", schema)


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_event_time(views.event_columns(_feed(spark, sf_dir)).drop("event_id"))


def _settings(folder: str) -> StreamSettings:
    return StreamSettings(checkpoint_base=f"{folder}/checkpoints", trigger={"availableNow": True})


def _to_table(spark: SparkSession, rows: DataFrame, name: str, mode: str = "append") -> DataFrame:
    folder = work_folder(spark, name)
    path = f"{folder}/table"
    write = sinks.table_sink(path) if mode == "append" else sinks.latest_sink(path)
    query = jobs.start_batches(rows, name, write, _settings(folder), mode)
    query.awaitTermination()
    if not query.recentProgress:     # an empty feed makes no batch
        return spark.createDataFrame([], rows.schema)
    if mode != "append":
        return sinks.read_latest(spark, path, rows.schema)
    return spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


def _question(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = jobs.question_streams(_measured(spark, sf_dir), exact_windows=True)[name]
        return _to_table(spark, rows, name, QUESTION_STREAMS[name])

    return run


stream_q1 = _question("Q1_Vehicle_Speeds")
stream_q2 = _question("Q2_Vehicle_Count_Per_Lane")
stream_q3 = _question("Q3_Speed_Violations")
stream_q5 = _question("Q5_Vehicles_Per_Lane_Per_5min")
stream_q6 = _question("Q6_Avg_Speed_Per_Lane_Per_5min")


def _alert_job(spark: SparkSession, sf_dir: str) -> str:
    folder = work_folder(spark, "alerts")
    messages = views.message_columns(_feed(spark, sf_dir))
    jobs.start_alerts(messages, f"{folder}/alerts", f"{folder}/malformed", _settings(folder)).awaitTermination()
    return folder


def stream_q4(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _alert_job(spark, sf_dir)
    table = sinks.read_table(spark, f"{folder}/alerts", schemas.SPEED_ALERTS_TABLE)
    return table.select("camera_name", "vehicle_id", "vehicle_type", "speed_kmh", "direction")


def stream_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _alert_job(spark, sf_dir)
    return spark.read.schema("value string, reason string").parquet(f"{folder}/malformed").select(
        "value", "reason")


def stream_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From positions to the event table, the alert table and the topic folders."""
    folder = work_folder(spark, "resolved")
    positions = views.position_columns(_feed(spark, sf_dir))
    calibrated = cameras.positions_calibrated(positions, cameras.cameras_dim(spark))
    jobs.start_resolver(calibrated, f"{folder}/events", _settings(folder), f"{folder}/alerts",
                        sinks.folder_publisher(f"{folder}/topics"), idle_ms=None).awaitTermination()
    table = sinks.read_table(spark, f"{folder}/events", schemas.VEHICLE_EVENTS_TABLE)
    return table.select("camera_name", "vehicle_id", "vehicle_type", "speed_kmh", "direction", "movement",
                        "speed_source")


def _to_the_end(spark: SparkSession, sf_dir: str, folder: str, start: Callable[[DataFrame, DataFrame], StreamingQuery]) -> None:
    """Runs a stream of boxes to the end of the stored table, then once more for the rows that end the feeds.

    start: gets the boxes and the ends, both as streams, and goes on from its checkpoint.
    """
    schema, path = "camera_name string, side string", f"{folder}/ends"
    boxes = views.detection_columns(spark.read.parquet(f"{sf_dir}/events.parquet"))
    keys = detections.detections_clean(boxes, cameras.cameras_dim(spark)).select("camera_name", "side").distinct()
    for ends in (spark.createDataFrame([], schema), keys):
        ends.write.mode("append").parquet(path)
        start(views.detection_columns(_feed(spark, sf_dir)), spark.readStream.schema(schema).parquet(path)).awaitTermination()


def stream_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Track positions; boxes that came too late are in the table `late` beside."""
    folder, known = work_folder(spark, "tracks"), cameras.cameras_dim(spark)

    def start(boxes: DataFrame, ends: DataFrame) -> StreamingQuery:
        centred = with_ends(detections.detections_clean(boxes, known), ends)
        write = sinks.late_sink(f"{folder}/late", sinks.table_sink(f"{folder}/table"))
        return jobs.start_batches(tracks_stream(centred, with_late=True), "tracks", write, _settings(folder))

    _to_the_end(spark, sf_dir, folder, start)
    return spark.read.schema(ASSIGNED).parquet(f"{folder}/table").drop("batch_id")


def stream_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole service on boxes: to the event table, the alert table and the topic folders; late boxes to one of their own."""
    folder = work_folder(spark, "live-stream")
    _to_the_end(spark, sf_dir, folder, lambda boxes, ends: jobs.start_live(
        boxes, cameras.cameras_dim(spark), f"{folder}/events", _settings(folder), f"{folder}/alerts",
        sinks.folder_publisher(f"{folder}/topics"), ends=ends, late_path=f"{folder}/late"))
    columns = ("camera_name", "vehicle_id", "vehicle_type", "speed_kmh", "direction", "movement", "speed_source")
    return sinks.read_table(spark, f"{folder}/events", schemas.VEHICLE_EVENTS_TABLE).select(*columns)
