"""Line crossings and the speed between two lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laneflow.config import FPS
from laneflow.functions.geometry import crossed, kmh
from laneflow.operators.blocks import BLOCK, HALO, Carried, in_blocks
from laneflow.schemas import LIVE_KEYS

ORDER = "frame_id"


def by_frame(keys: Sequence[str]):
    """Window over the rows of one block of a track, in frame order."""
    return Window.partitionBy(*keys, BLOCK).orderBy(ORDER)


def with_history(blocked: DataFrame, position: str, window: int, keys: Sequence[str]) -> DataFrame:
    """Adds `history_rows` and `history_start`: how many of the last `window` rows there are, and the oldest position.

    Offsets and running frames cost the same for any `window`; a sliding frame
    would go over all its rows again at each step.
    """
    rows = by_frame(keys)
    so_far = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    oldest = F.coalesce(F.lag(position, window - 1).over(rows), F.first(position).over(so_far))
    return (blocked.withColumn("history_rows", F.least(F.row_number().over(rows), F.lit(window)).cast("long"))
            .withColumn("history_start", oldest))


def mark_crossings(blocked: DataFrame, position: str, variant: str, keys: Sequence[str]) -> DataFrame:
    """Adds `previous`, `crossed_1` and `crossed_2` to rows from `in_blocks`."""
    previous, here = F.col("previous"), F.col(position)
    own = ~F.col(HALO)
    return (
        blocked.withColumn("previous", F.lag(position).over(by_frame(keys)))
        .withColumn("crossed_1", own & crossed(previous, here, F.col("first_line"), variant))
        .withColumn("crossed_2", own & crossed(previous, here, F.col("second_line"), variant))
    )


def crossings_carried(position: str, variant: str, keys: Sequence[str]) -> Carried:
    """The two crossings that lie in earlier blocks, for `in_blocks`: `_begun` and `_done`.

    A block knows the crossings between its own rows; the step from the block before to its first row is added when the
    summaries, one row per block, stand in order.
    """
    frame, here, block = F.col(ORDER), F.col(position), Window.partitionBy(*keys, BLOCK)
    first_row, earlier = F.col("_first_row"), Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    previous = F.col("_previous")
    return Carried(
        rows=({"_previous": F.lag(position).over(by_frame(keys))},
              {"_hit_1": crossed(previous, here, F.col("first_line"), variant), "_hit_2": crossed(previous, here, F.col("second_line"), variant)},
              {"_first_hit": F.min(F.when(F.col("_hit_1"), frame)).over(block)}),
        summary={
            "_first_row": F.min(F.struct(frame, here.alias("_at"), "first_line", "second_line")),
            "_last_at": F.max_by(here, frame),
            "_first": F.min("_first_hit"),
            "_any_second": F.min(F.when(F.col("_hit_2"), frame)),
            "_second_after": F.min(F.when(F.col("_hit_2") & (frame > F.col("_first_hit")), frame))},
        steps=({"_from": F.lag("_last_at").over(Window.partitionBy(*keys).orderBy(BLOCK))},
               {"_step_1": crossed(F.col("_from"), first_row["_at"], first_row["first_line"], variant),
                "_step_2": crossed(F.col("_from"), first_row["_at"], first_row["second_line"], variant)},
               {"_second_after": F.when(F.col("_step_1"), F.col("_any_second")).otherwise(F.col("_second_after")),
                "_first": F.when(F.col("_step_1"), first_row[ORDER]).otherwise(F.col("_first")),
                "_any_second": F.when(F.col("_step_2"), first_row[ORDER]).otherwise(F.col("_any_second"))},
               {"_begun": F.min("_first").over(earlier)},
               {"_second": F.when(F.col("_begun").isNotNull(), F.col("_any_second")).otherwise(F.col("_second_after"))},
               {"_done": F.min("_second").over(earlier)}),
        names=("_begun", "_done"))


def pair_crossings(marked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds `first_frame` and `second_frame`, the two crossings that give a track its speed.

    The first is the first crossing of line 1, the second the first crossing of line 2 in a later frame. Both are known by
    the end of the row's block; a second crossing in a later block is null here. `marked` has the columns of
    `crossings_carried`.
    """
    block, frame = Window.partitionBy(*keys, BLOCK), F.col(ORDER)
    first_here = F.min(F.when(F.col("crossed_1"), frame)).over(block)
    rows = marked.withColumn("first_frame", F.coalesce(F.min("_begun").over(block), first_here))
    second_here = F.min(F.when(F.col("crossed_2") & (frame > F.col("first_frame")), frame)).over(block)
    return rows.withColumn("second_frame", F.coalesce(F.min("_done").over(block), second_here)).drop("_begun", "_done")


def lap_per_track(marked: DataFrame, keys: Sequence[str], carry: Sequence[str] = (),
                  also: dict[str, Column] | None = None) -> DataFrame:
    """One row per track: `first_frame`, and `second`, a struct of `second_frame` and the `carry` columns there.

    The same two crossings as `pair_crossings`, for use where single rows are
    not wanted: each block is reduced to one row before anything is exchanged.
    `also` gives further columns, as minima over the track.
    """
    block = Window.partitionBy(*keys, BLOCK)
    frame, hit_2 = F.col(ORDER), F.col("crossed_2")
    there = F.struct(frame.alias("second_frame"), *carry)
    first_here = F.min(F.when(F.col("crossed_1"), frame)).over(block)
    blocks = (
        marked.withColumn("_first_here", first_here).groupBy(*keys, BLOCK).agg(
            F.min("_first_here").alias("_first"),
            F.min(F.when(hit_2, there)).alias("_any_second"),
            F.min(F.when(hit_2 & (frame > F.col("_first_here")), there)).alias("_second_after"),
            *[F.min(column).alias(name) for name, column in (also or {}).items()],
        )
    )
    first = F.min("_first").over(Window.partitionBy(*keys))
    # the block of the first crossing, or a later one
    second = (F.when(F.col("_first") == F.col("first_frame"), F.col("_second_after"))
              .when(F.col("_any_second.second_frame") > F.col("first_frame"), F.col("_any_second")))
    return (
        blocks.withColumn("first_frame", first).withColumn("_second", second).groupBy(*keys).agg(
            F.min("first_frame").alias("first_frame"), F.min("_second").alias("second"),
            *[F.min(name).alias(name) for name in (also or {})])
    )


def lap_seconds(fps: float, second: str = "second_frame") -> Column:
    return (F.col(second) - F.col("first_frame")) / F.lit(fps)


def tripwire_crossings(calibrated: DataFrame, position: str = "cx", variant: str = "x",
                       keys: Sequence[str] = LIVE_KEYS, block: int | None = None) -> DataFrame:
    """Every step of a track over one of its two lines."""
    needed = calibrated.select(*keys, ORDER, position, "first_line", "second_line")
    marked = mark_crossings(in_blocks(needed, keys, ORDER, 1, block), position, variant, keys)
    return (
        marked.filter(F.col("crossed_1") | F.col("crossed_2"))
        .select(*keys, ORDER, "previous", F.col(position).alias("current"), "crossed_1", "crossed_2")
    )


def tripwire_speeds(calibrated: DataFrame, fps: float = FPS, position: str = "cx", variant: str = "x",
                    keys: Sequence[str] = LIVE_KEYS, distances: dict[str, Column] | None = None,
                    block: int | None = None) -> DataFrame:
    """One row per track that crossed both lines, with a speed for each given distance.

    Either direction counts. Both lines in one frame count as line 1 only.
    """
    distances = distances or {"speed_kmh": F.col("dist_m")}
    needed = calibrated.select(
        *keys, ORDER, position, "first_line", "second_line",
        *[metres.alias(f"_metres_{name}") for name, metres in distances.items()])
    marked = mark_crossings(in_blocks(needed, keys, ORDER, 1, block), position, variant, keys)
    hits = marked.filter(F.col("crossed_1") | F.col("crossed_2"))
    laps = lap_per_track(hits, keys, [f"_metres_{name}" for name in distances])
    seconds = lap_seconds(fps, "second.second_frame")
    return laps.filter(F.col("second").isNotNull()).select(
        *keys, "first_frame", "second.second_frame",
        *[kmh(F.col(f"second._metres_{name}"), seconds).alias(name) for name in distances])
