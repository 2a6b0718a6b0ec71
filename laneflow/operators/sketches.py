"""Vehicle counts from stored sketches: one small sketch per lane and window, merged to any longer span."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laneflow.config import SKETCH_BITS, WINDOW_S
from laneflow.functions.timing import in_some_window, tumbling, window_index
from laneflow.streaming.sinks import table_sink


def lane_sketches(events: DataFrame, window_s: int = WINDOW_S, bits: int = SKETCH_BITS) -> DataFrame:
    """carriageway, window_index, sketch of the vehicle ids in it.

    Null ids are no vehicles. Events without a window number are left out (`questions.without_window`). A sketch has
    at most 2^bits bytes and a standard error of about 1.04 / sqrt(2^bits); counts of some hundreds are exact.
    """
    grouped = events.filter(in_some_window(window_s=window_s)).groupBy("carriageway", tumbling(window_s=window_s).alias("window"))
    return grouped.agg(F.hll_sketch_agg("vehicle_id", F.lit(bits)).alias("sketch")).select(
        "carriageway", window_index(F.col("window.start"), window_s).alias("window_index"), "sketch")


def sketches_sink(path: str, window_s: int = WINDOW_S, bits: int = SKETCH_BITS) -> Callable[[DataFrame, int], None]:
    """Each batch of events to a table of its sketches.

    A window that spans batches has a row of each, and a batch that runs twice replaces its own. No state is held, and events
    of any lateness count.
    """
    write = table_sink(path)
    return lambda events, batch_id: write(lane_sketches(events, window_s, bits), batch_id)


def vehicles_by(sketches: DataFrame, *keys: str) -> DataFrame:
    """Vehicles per combination of the keys, each counted once however many of the merged sketches hold it."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("vehicle_count"))


def with_span(sketches: DataFrame, windows: int) -> DataFrame:
    """Sketches with `span`: 1 for the first `windows` windows from the feed's start, and so on."""
    return sketches.withColumn("span", (F.floor((F.col("window_index").cast("long") - 1) / F.lit(windows)) + 1).cast("int"))
