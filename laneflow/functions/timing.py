"""Event time and windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from laneflow.config import WINDOW_S

# Spark's timestamps count microseconds in 64 bits. A window around a time must fit them too, so a day at each end stays free.
_MAX_SECONDS = float((1 << 63) // 1_000_000 - 86_400)


def event_time(seconds: Column) -> Column:
    """Seconds since the start of the feed as a time counted from 1970-01-01.

    The fraction is cut off towards zero. The session time zone plays no part.
    NaN, infinite values and those that timestamps, or windows of up to a day around them, cannot hold give null instead of
    ending the job. A null time falls in no window.
    """
    usable = F.when(F.abs(seconds) < _MAX_SECONDS, seconds)
    return F.timestamp_seconds(usable.cast("long"))


def seconds_since(stamp: Column, start: str) -> Column:
    """Seconds between `start` and a timestamp without time zone."""
    gap = stamp - F.lit(start).cast("timestamp_ntz")
    return gap.cast("interval second").cast("decimal(20,6)").cast("double")


def tumbling(time_col: str = "event_time", window_s: int = WINDOW_S) -> Column:
    return F.window(time_col, f"{window_s} seconds")


def in_some_window(time_col: str = "event_time", window_s: int = WINDOW_S) -> Column:
    """Whether a time lies in a window whose number fits an int: some twenty thousand years around the start for 300 s."""
    return F.coalesce(F.abs(F.unix_seconds(F.col(time_col))) < window_s * float((1 << 31) - 1), F.lit(False))


def window_index(start: Column, window_s: int = WINDOW_S) -> Column:
    """Number of a window, 1 for the one that starts at the feed's start; null for one beyond `in_some_window`."""
    return (F.floor(F.unix_seconds(start) / window_s) + 1).try_cast("int")
