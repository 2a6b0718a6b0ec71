"""Start functions of the streaming jobs.

Each query keeps its progress in a checkpoint folder of its own below
`settings.checkpoint_base`; a restarted query goes on where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from laneflow.config import ALERT_KMH, FPS, QUESTION_STREAMS, StreamSettings
from laneflow.operators import questions
from laneflow.operators.alerts import alert_total, q4_speed_alerts
from laneflow.operators.detections import detections_clean
from laneflow.sources import feeds
from laneflow.sources.cameras import positions_calibrated
from laneflow.sources.messages import decode_events
from laneflow.streaming.sinks import Publish, alerts_sink, events_sink, late_sink
from laneflow.streaming.state import IDLE_MS, live_stream, resolved_stream, with_ends


def start(rows: DataFrame, name: str, mode: str, settings: StreamSettings) -> StreamingQuery:
    """Starts one query into the sink of the settings (`console`, `memory`, ...)."""
    with_state_on_disk(rows.sparkSession)
    writer = (rows.writeStream.queryName(name).outputMode(mode).format(settings.sink)
              .option("checkpointLocation", f"{settings.checkpoint_base}/{name}"))
    if settings.sink == "console":
        writer = writer.option("truncate", False)
    return _triggered(writer, settings).start()


def start_batches(rows: DataFrame, name: str, write: Publish, settings: StreamSettings,
                  mode: str = "append") -> StreamingQuery:
    """Starts one query that hands each batch to `write`."""
    with_state_on_disk(rows.sparkSession)
    writer = (rows.writeStream.queryName(name).outputMode(mode).foreachBatch(write)
              .option("checkpointLocation", f"{settings.checkpoint_base}/{name}"))
    return _triggered(writer, settings).start()


#: Keeps state on disk, so that its size isn't bounded by the executors' memory.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_state_on_disk(spark: SparkSession) -> None:
    """A query takes the store that is set when it starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def _triggered(writer, settings: StreamSettings):
    return writer.trigger(**settings.trigger) if settings.trigger else writer


def question_streams(events: DataFrame, exact_windows: bool = False) -> dict[str, DataFrame]:
    """The five questions on a stream of events, by query name."""
    answers = (
        questions.q1_vehicle_speeds(events),
        questions.q2_vehicles_per_lane(events, exact=False),
        questions.q3_speed_violations(events),
        questions.q5_vehicles_per_window(events, exact=exact_windows),
        questions.q6_log(events),
    )
    return dict(zip(QUESTION_STREAMS, answers))


def start_questions(raw: DataFrame, settings: StreamSettings, exact_windows: bool = False) -> list[StreamingQuery]:
    """Starts the five questions on a feed of messages."""
    streams = question_streams(decode_events(raw), exact_windows)
    return [start(rows, name, QUESTION_STREAMS[name], settings) for name, rows in streams.items()]


def start_alerts(raw: DataFrame, alerts_path: str, malformed_path: str, settings: StreamSettings,
                 threshold: float = ALERT_KMH) -> StreamingQuery:
    """Starts the alert job: alert messages to the alert table, unusable ones aside."""
    return start_batches(raw, "Q4_Speed_Alerts", alerts_sink(alerts_path, malformed_path, threshold), settings)


def start_alert_counter(raw: DataFrame, settings: StreamSettings, threshold: float = ALERT_KMH) -> StreamingQuery:
    """Starts the running count of alerts."""
    return start(alert_total(q4_speed_alerts(raw, threshold)), "Q4_Alert_Count", "complete", settings)


def start_resolver(calibrated: DataFrame, events_path: str, settings: StreamSettings,
                   alerts_path: str | None = None, publish: Publish | None = None,
                   fps: float = FPS, idle_ms: int | None = IDLE_MS) -> StreamingQuery:
    """Starts the job from track positions to stored events, alerts and messages."""
    return start_batches(resolved_stream(calibrated, fps, idle_ms), "Resolved_Events",
                         events_sink(events_path, alerts_path, publish), settings)


def start_live(boxes: DataFrame, cameras: DataFrame, events_path: str, settings: StreamSettings, alerts_path: str | None = None,
               publish: Publish | None = None, whole_frames: bool = False, ends: DataFrame | None = None,
               late_path: str | None = None) -> StreamingQuery:
    """Starts the whole service: boxes of all cameras to stored events, alerts and messages.

    The last frame of a camera side is held until a later one or its row in the stream `ends` (camera_name, side) arrives.
    Boxes of frames that are done go to the table at late_path, without one to `<events_path>-late`.
    """
    centred = with_ends(positions_calibrated(detections_clean(boxes, cameras), cameras), ends)
    write = events_sink(events_path, alerts_path, publish)
    return start_batches(live_stream(centred, whole_frames=whole_frames), "Live_Events",
                         late_sink(late_path or f"{events_path.rstrip('/')}-late", write), settings)


def run_analytics(spark: SparkSession, settings: StreamSettings) -> None:
    """The five questions on the statistics topic, until one of them ends."""
    start_questions(feeds.stats_feed(spark, settings), settings)
    spark.streams.awaitAnyTermination()


def run_alerts(spark: SparkSession, settings: StreamSettings, alerts_path: str, malformed_path: str) -> None:
    """The alert job on the alert topic."""
    start_alerts(feeds.alerts_feed(spark, settings), alerts_path, malformed_path, settings)
    spark.streams.awaitAnyTermination()
