"""Vehicle events as JSON messages: encode, decode, route."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laneflow import schemas
from laneflow.config import ALERT_KMH, ALERTS_TOPIC, STATS_TOPIC
from laneflow.functions.numbers import to_places
from laneflow.functions.timing import event_time

_FIELDS = [f.name for f in schemas.VEHICLE_EVENT.fields]


def decode_events(raw: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages to events with an `event_time`.

    Rows without a speed go away; that covers messages that cannot be read.
    `keep` names further columns of `raw` to carry along.
    """
    message = F.from_json(F.col(value_col).cast("string"), schemas.VEHICLE_EVENT)
    return with_event_time(raw.select(*keep, read_once(message)))


def read_once(message: Column) -> Column:
    """The fields of a decoded message as columns.

    As a generator's output they are computed once per row; plain `d.*` would
    decode the text again for every filter that is moved below the projection.
    """
    return F.inline(F.array(message))


def with_event_time(events: DataFrame) -> DataFrame:
    """Measured events with the time that the windows use."""
    return (events.filter(F.col("speed_kmh").isNotNull())
            .withColumn("event_time", event_time(F.col("timestamp_s"))))


def payload() -> Column:
    """The message of one event. Speed and time carry two digits."""
    rounded = {"speed_kmh", "timestamp_s"}
    return F.to_json(F.struct(*[
        to_places(F.col(f).cast("double")).alias(f) if f in rounded else F.col(f) for f in _FIELDS
    ]), {"ignoreNullFields": "false"})


def encode_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One `value` per event, ready for a topic."""
    return events.select(*keep, payload().alias("value"))


def route_events(events: DataFrame, threshold: float = ALERT_KMH, stats_topic: str = STATS_TOPIC,
                 alerts_topic: str = ALERTS_TOPIC, keep: tuple[str, ...] = ()) -> DataFrame:
    """`topic` and `value` of every message to send.

    Each event goes to the statistics topic; one above the threshold, judged
    before rounding, goes to the alert topic too.
    """
    stats, both = F.array(F.lit(stats_topic)), F.array(F.lit(stats_topic), F.lit(alerts_topic))
    topics = F.when(F.col("speed_kmh") > threshold, both).otherwise(stats)
    return events.select(*keep, F.explode(topics).alias("topic"), payload().alias("value"))
