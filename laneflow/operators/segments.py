"""Fixed-length pieces of a recording."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laneflow.config import SEGMENT_S


def segment_plan(videos: DataFrame, length_s: float = SEGMENT_S, max_segments: int | None = None) -> DataFrame:
    """The pieces of each video (`video_name`, `duration_s`), or the first `max_segments` of them.

    The last piece ends with the video.
    """
    total = F.ceil(F.col("duration_s") / length_s)
    wanted = total if max_segments is None else F.least(total, F.lit(max_segments).cast("long"))
    base = F.regexp_replace(F.regexp_extract("video_name", r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
    index = F.explode(F.sequence(F.lit(0).cast("long"), wanted - 1))
    return (
        videos.filter(F.col("duration_s") > 0)
        .select("video_name", "duration_s", base.alias("_base"), total.alias("total_segments"), index.alias("_i"))
        .select(
            "video_name", "total_segments", (F.col("_i") + 1).alias("segment_no"),
            (F.col("_i") * F.lit(float(length_s))).alias("start_s"),
            F.least((F.col("_i") + 1) * F.lit(float(length_s)), F.col("duration_s").cast("double")).alias("end_s"),
            F.concat("_base", F.lit("_part_"), (F.col("_i") + 1).cast("string"), F.lit(".mp4")).alias("segment_name"),
        )
    )


def segment_assign(rows: DataFrame, length_s: float = SEGMENT_S, time_col: str = "timestamp_s",
                   total_s: Column | None = None) -> DataFrame:
    """Rows with the piece that their time falls in; `total_s` cuts the last one short."""
    index = F.floor(F.col(time_col) / length_s)
    end = (index + 1) * F.lit(float(length_s))
    return (
        rows.withColumn("segment_no", (index + 1).cast("long"))
        .withColumn("segment_start_s", index * F.lit(float(length_s)))
        .withColumn("segment_end_s", end if total_s is None else F.least(end, total_s))
    )
