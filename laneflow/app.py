"""Command line of the jobs, for `spark-submit`.

    spark-submit --packages <kafka connector> laneflow/app.py analytics --bootstrap host:9092 --work hdfs:///traffic
    spark-submit --packages <kafka connector> laneflow/app.py alerts    --bootstrap host:9092 --work hdfs:///traffic
    spark-submit laneflow/app.py events --boxes hdfs:///boxes --work hdfs:///traffic --out hdfs:///events
    spark-submit laneflow/app.py live   --boxes hdfs:///boxes --work hdfs:///traffic --out hdfs:///events --seconds 5
    spark-submit laneflow/app.py report --boxes hdfs:///tracked --out hdfs:///report
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laneflow import schemas
from laneflow.config import StreamSettings
from laneflow.operators import road
from laneflow.plans.live import boxes_to_events
from laneflow.session import stored
from laneflow.sources import feeds
from laneflow.sources.cameras import cameras_dim
from laneflow.streaming import jobs, sinks


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="laneflow")
    commands = top.add_subparsers(dest="command", required=True)
    for name in ("analytics", "alerts"):
        command = commands.add_parser(name)
        command.add_argument("--bootstrap", required=True, help="Kafka servers")
        command.add_argument("--work", required=True, help="shared folder for checkpoints and tables")
        command.add_argument("--max-offsets", type=int, help="messages per batch")
    events = commands.add_parser("events")
    events.add_argument("--boxes", required=True, help="Parquet folder of boxes")
    events.add_argument("--work", required=True, help="shared folder for the track positions")
    events.add_argument("--out", required=True, help="event table")
    events.add_argument("--alerts", help="alert table")
    events.add_argument("--topics", help="folder of message files, one below it for each topic")
    live = commands.add_parser("live")
    live.add_argument("--boxes", required=True, help="Parquet folder that boxes arrive in")
    live.add_argument("--work", required=True, help="shared folder for checkpoints")
    live.add_argument("--out", required=True, help="event table")
    live.add_argument("--alerts", help="alert table")
    live.add_argument("--topics", help="folder of message files")
    live.add_argument("--ends", help="Parquet folder that rows (camera_name, side) arrive in when a feed ends")
    live.add_argument("--seconds", type=float, help="time between batches; without it the job ends with its input")
    report = commands.add_parser("report")
    report.add_argument("--boxes", required=True, help="Parquet folder of boxes with track ids")
    report.add_argument("--out", required=True, help="CSV folder")
    return top


#: Runs over tables are numbered from here on, beyond the batches of any stream.
FIRST_RUN = 1 << 61


def run_number(rows: DataFrame) -> int:
    """A number that names a run by the files it reads: a second attempt gets the same one and replaces the first."""
    files = rows.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    found = files.agg(F.sum(F.pmod(F.xxhash64("*"), F.lit(FIRST_RUN)).cast("decimal(38,0)"))).first()[0]
    return FIRST_RUN + int(found or 0) % FIRST_RUN


def main(spark: SparkSession, arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    if args.command in ("analytics", "alerts"):
        settings = StreamSettings(checkpoint_base=f"{args.work}/checkpoints", bootstrap=args.bootstrap,
                                  max_offsets_per_trigger=args.max_offsets)
        if args.command == "analytics":
            jobs.run_analytics(spark, settings)
        else:
            jobs.run_alerts(spark, settings, f"{args.work}/speed_alerts", f"{args.work}/malformed_alerts")
    elif args.command == "events":
        boxes = spark.read.schema(schemas.DETECTIONS).parquet(args.boxes)
        run = run_number(boxes)      # replaces an earlier attempt on these files, no other run, and no batch of a stream
        events = stored(boxes_to_events(boxes, cameras_dim(spark), f"{args.work}/positions-{run}"), "events")
        publish = sinks.folder_publisher(args.topics) if args.topics else None
        sinks.events_sink(args.out, args.alerts, publish)(events, run)
    elif args.command == "live":
        trigger = {"processingTime": f"{args.seconds} seconds"} if args.seconds else {"availableNow": True}
        settings = StreamSettings(checkpoint_base=f"{args.work}/checkpoints", trigger=trigger)
        publish = sinks.folder_publisher(args.topics) if args.topics else None
        boxes = feeds.table_feed(spark, args.boxes, schemas.DETECTIONS)
        ends = spark.readStream.schema("camera_name string, side string").parquet(args.ends) if args.ends else None
        jobs.start_live(boxes, cameras_dim(spark), args.out, settings, args.alerts, publish, ends=ends).awaitTermination()
    else:
        boxes = road.class_filter(spark.read.parquet(args.boxes))
        sinks.write_report_csv(road.vehicle_report(road.road_traces(boxes)), args.out)


if __name__ == "__main__":
    main(SparkSession.builder.appName("laneflow").getOrCreate())
