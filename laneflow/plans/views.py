"""The given tables seen as traffic data.

`events` holds numbered events of users over a month. Here a user is a vehicle,
and an event is one sighting of it. No view needs a window: frames, boxes and
tracks are numbered by arithmetic on the event number, so their groups keep
their size when the table grows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laneflow.functions.geometry import box_middle, size_class
from laneflow.functions.timing import seconds_since

FEED_START = "2024-01-01 00:00:00"
BOXES_PER_FRAME = 16
SESSION_FRAMES = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def _camera() -> Column:
    """Two cameras with settings, and one, `Side_Road`, without."""
    return (F.when(F.expr("user_id % 7 = 3"), "Side_Road").when(F.expr("(user_id div 2) % 2 = 0"), "IC_Papagou")
            .otherwise("Roupaki_Toll_Station"))


def _int(expression: str) -> Column:
    return F.expr(expression).cast("int")


def _box() -> dict[str, Column]:
    return {
        "x": _int("(event_id * 37) % 1200"), "y": _int("(event_id * 53) % 640"),
        "w": _int("20 + (event_id * 7) % 140"), "h": _int("20 + (event_id * 11) % 100"),
        "class_id": F.element_at(F.array(*[F.lit(c) for c in (2, 3, 5, 7, 0, 1)]), _int("event_id % 6 + 1")),
    }


def traffic_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle events, some without a speed or a type."""
    return event_columns(_events(spark, sf_dir))


def event_columns(events: DataFrame) -> DataFrame:
    """The same for any frame or stream with the columns of `events`."""
    kind = F.col("event_type")
    return events.select(
        F.concat(F.lit("V"), F.col("user_id").cast("string")).alias("vehicle_id"),
        F.when(F.col("event_id") % 41 == 0, None)
        .when(kind == "purchase", "truck").when(kind.isin("click", "view"), "car")
        .when(kind == "signup", "motorcycle").otherwise("bus").alias("vehicle_type"),
        F.when(F.col("event_id") % 50 != 0, F.col("value")).alias("speed_kmh"),
        F.when(F.col("user_id") % 2 == 0, "inbound").otherwise("outbound").alias("carriageway"),
        _camera().alias("segment"),
        seconds_since(F.col("ts"), FEED_START).alias("timestamp_s"),
        F.when(F.col("event_id") % 3 == 0, "displacement").otherwise("tripwire").alias("speed_source"),
        "event_id",
    )


def alert_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert messages in arrival order (`event_id`), a few of them damaged, bare or with a speed as text."""
    return message_columns(_events(spark, sf_dir))


def message_columns(events: DataFrame) -> DataFrame:
    events = event_columns(events)
    n, quote = F.col("event_id"), F.lit('{"vehicle_id":"')
    whole = F.struct("vehicle_id", "vehicle_type", "speed_kmh", "carriageway", "segment", "timestamp_s",
                     "speed_source")
    as_text = F.struct("vehicle_id", F.col("speed_kmh").cast("string").alias("speed_kmh"))
    value = (
        F.when(n % 97 == 0, "not json").when(n % 89 == 0, "[1, 2]")
        .when(n % 83 == 0, F.concat(quote, F.col("vehicle_id"), F.lit('","speed_kmh":"abc"}')))
        .when(n % 79 == 0, '{"speed_kmh": 150.5}')
        .when(n % 73 == 0, F.to_json(as_text))
        .otherwise(F.to_json(whole))
    )
    return events.select("event_id", value.alias("value"))


def track_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of tracks that show up now and then: the frame is the event."""
    return position_columns(_events(spark, sf_dir))


def position_columns(events: DataFrame) -> DataFrame:
    box = _box()
    return events.select(
        _camera().alias("camera_name"),
        F.when(F.col("user_id") % 2 == 0, "L").otherwise("R").alias("side"),
        F.col("user_id").alias("track_id"),
        F.col("event_id").alias("frame_id"),
        _int("floor(value * 4) % 1280").alias("cx"),
        _int("(event_id * 37) % 720").alias("cy"),
        F.lit(False).alias("coasting"),
        size_class(box["w"], box["h"]).alias("vehicle_type"),
    )


def dense_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks with a position in every frame: the nth event of a frame moves track n of its session."""
    box, slot = _box(), f"event_id % {BOXES_PER_FRAME}"
    frame = f"event_id div {BOXES_PER_FRAME}"
    return _events(spark, sf_dir).select(
        F.when(F.expr(f"({slot}) % 2 = 0"), "IC_Papagou").otherwise("Roupaki_Toll_Station").alias("camera_name"),
        F.when(F.expr(f"(({slot}) div 2) % 2 = 0"), "L").otherwise("R").alias("side"),
        F.expr(f"({slot}) + {BOXES_PER_FRAME} * (({frame}) div {SESSION_FRAMES})").alias("track_id"),
        F.expr(frame).alias("frame_id"),
        _int("floor(value * 4) % 1280").alias("cx"),
        _int("(event_id * 37) % 720").alias("cy"),
        F.lit(False).alias("coasting"),
        size_class(box["w"], box["h"]).alias("vehicle_type"),
    )


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes, `BOXES_PER_FRAME` events to a frame."""
    return detection_columns(_events(spark, sf_dir))


def detection_columns(events: DataFrame) -> DataFrame:
    box = _box()
    return events.select(
        _camera().alias("camera_name"),
        F.expr(f"event_id div {BOXES_PER_FRAME}").alias("frame_id"),
        _int(f"event_id % {BOXES_PER_FRAME}").alias("box_id"),
        *[box[c].alias(c) for c in ("x", "y", "w", "h")],
        (F.lit(0.8) * box["w"] * box["h"]).alias("area"),
        box["class_id"].alias("class_id"),
    )


def box_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A track position for every box, every fifth of them a little off its box."""
    boxes = detections(spark, sf_dir)
    cx, cy = box_middle(F.col("x"), F.col("w")), box_middle(F.col("y"), F.col("h"))
    off = (F.col("frame_id") + F.col("box_id")) % 5 == 0
    return boxes.select(
        "camera_name",
        F.when(cx < 640, "L").otherwise("R").alias("side"),
        (F.col("box_id") + BOXES_PER_FRAME * F.expr(f"frame_id div {SESSION_FRAMES}")).alias("track_id"),
        "frame_id",
        (cx + F.when(off, F.col("w") % 7).otherwise(0)).cast("int").alias("cx"),
        (cy + F.when(off, F.col("h") % 11).otherwise(0)).cast("int").alias("cy"),
    )


def tracked_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes that already carry a track id, as the offline analysis gets them."""
    box = _box()
    return _events(spark, sf_dir).select(
        _camera().alias("camera_name"), F.col("user_id").alias("track_id"), F.col("event_id").alias("frame_id"),
        *[box[c].alias(c) for c in ("x", "y", "w", "h", "class_id")],
    )


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings: a document is a video, its length in characters the duration in tenths of a second."""
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("Downloads/clip.v1_"), F.col("doc_id").cast("string"), F.lit(".mp4")).alias("video_name"),
        (F.col("n_chars") / 10.0).alias("duration_s"),
    )
