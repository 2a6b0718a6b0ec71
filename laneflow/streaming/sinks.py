"""Where results go: stored tables, topics, report files.

A streaming batch is written to a folder of its own, named by its number, and
replaces that folder. A batch that runs twice, because an executor or the whole
job was lost, leaves its rows in the table once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laneflow.config import ALERT_KMH, StreamSettings
from laneflow.functions.numbers import to_places
from laneflow.operators.alerts import decoded_alerts, unusable_alerts, usable_alerts
from laneflow.operators.road import report_text
from laneflow.operators.trajectories import as_messages
from laneflow.sources.messages import route_events

Publish = Callable[[DataFrame, int], None]


def _write_batch(rows: DataFrame, batch_id: int, path: str, *partitions: str) -> None:
    writer = rows.write.mode("overwrite")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(f"{path}/batch_id={batch_id}")


def write_vehicle_events(resolved: DataFrame, batch_id: int, path: str) -> None:
    """Resolved events to the event table, by camera."""
    rows = resolved.select(
        "camera_name", "vehicle_id", "vehicle_type", to_places(F.col("speed_kmh")).alias("speed_kmh"), "direction",
        "movement", "speed_source", F.current_timestamp().alias("recorded_at"))
    _write_batch(rows, batch_id, path, "camera_name")


def write_speed_alerts(alerts: DataFrame, batch_id: int, path: str) -> None:
    """Alerts to the alert table, by camera."""
    rows = alerts.select(
        "camera_name", "vehicle_id", "vehicle_type", to_places(F.col("speed_kmh")).alias("speed_kmh"), "direction",
        F.current_timestamp().alias("alerted_at"))
    _write_batch(rows, batch_id, path, "camera_name")


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table written batch by batch, with `batch_id` and `camera_name`."""
    return spark.read.schema(schema).parquet(path)


def events_sink(events_path: str, alerts_path: str | None = None, publish: Publish | None = None,
                threshold: float = ALERT_KMH) -> Publish:
    """One batch of resolved events to the event table and, if asked for, to the alert table and the topics.

    Let only one job write an alert table: this one, or the one that reads the
    alert topic.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write_vehicle_events(batch, batch_id, events_path)
            if alerts_path is not None:
                write_speed_alerts(batch.filter(F.col("speed_kmh") > threshold), batch_id, alerts_path)
            if publish is not None:
                publish(route_events(as_messages(batch), threshold), batch_id)
        finally:
            batch.unpersist()

    return write


def alerts_sink(alerts_path: str, malformed_path: str, threshold: float = ALERT_KMH) -> Publish:
    """One batch of alert messages to the alert table, and the unusable ones to a table of their own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        decoded = decoded_alerts(batch).persist()      # each message is decoded once
        try:
            write_speed_alerts(usable_alerts(decoded, threshold), batch_id, alerts_path)
            _write_batch(unusable_alerts(decoded), batch_id, malformed_path)
        finally:
            decoded.unpersist()

    return write


def kafka_publisher(settings: StreamSettings) -> Publish:
    """Routed messages (`topic`, `value`) to Kafka. A batch that runs twice is sent twice.

    Needs the Kafka connector, see `laneflow.sources.feeds`.
    """

    def publish(routed: DataFrame, batch_id: int) -> None:
        (routed.select("topic", "value").write.format("kafka")
         .option("kafka.bootstrap.servers", settings.bootstrap)
         .option("kafka.acks", "1").option("kafka.retries", "3")
         .option("kafka.linger.ms", "50").option("kafka.batch.size", "16384").save())

    return publish


def folder_publisher(path: str) -> Publish:
    """Routed messages to one folder per topic, a file of lines per batch, for `folder_feed`."""

    def publish(routed: DataFrame, batch_id: int) -> None:
        routed.select("topic", "value").write.mode("overwrite").partitionBy("topic").text(f"{path}/batch_id={batch_id}")

    return publish


def table_sink(path: str) -> Publish:
    """Any stream to a table, batch by batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        _write_batch(batch, batch_id, path)

    return write


def latest_sink(path: str) -> Publish:
    """A stream in complete mode to a table that holds its latest answer.

    Answers go to two slots in turn, each with its number as `version`; readers take the newest that is whole
    (`read_latest`). An answer replaces the one before the last, so there is always one, also after a crash, and never more
    than two. A reader has the time of a batch to read it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("version", F.lit(batch_id).cast("long"))
        numbered.write.mode("overwrite").parquet(f"{path}/slot={batch_id % 2}")

    return write


def read_latest(spark: SparkSession, path: str, schema) -> DataFrame:
    """The newest whole version of a table of `latest_sink`."""
    # the committer moves an answer's files in place at its end; an answer never gets fewer rows than none
    versions = spark.read.schema(T.StructType([*schema.fields]).add("version", T.LongType())).parquet(path)
    newest = versions.agg(F.max("version")).first()[0]
    return versions.filter(F.col("version") == newest).drop("version", "slot")


def write_report_csv(report: DataFrame, path: str) -> None:
    """The vehicle report as CSV with a header, by vehicle, empty where there is no speed."""
    report_text(report).orderBy("vehicle_id", "camera_name").write.mode("overwrite").option("header", True).csv(path)


def late_sink(path: str, write: Publish) -> Publish:
    """Rows whose `late` is true to the table at path, batch by batch; the others to `write`, without that column."""

    def split(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            _write_batch(batch.filter("late").select([c for c in ("camera_name", "side", "frame_id", "box_id", "cx", "cy") if c in batch.columns]), batch_id, path)
            write(batch.filter("not late").drop("late"), batch_id)
        finally:
            batch.unpersist()

    return split
