"""Readers of message feeds: Kafka topics, and folders of message files.

The Kafka connector is a separate package of the Spark distribution. Where it
is not installed, as on the machine of the tests, the Kafka reader cannot be
run; the folder reader gives the same `value` column to the same decoder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from laneflow.config import FILES_PER_TRIGGER, StreamSettings


def kafka_options(settings: StreamSettings, topic: str) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": settings.bootstrap,
        "subscribe": topic,
        "startingOffsets": settings.starting_offsets,
        "failOnDataLoss": str(settings.fail_on_data_loss).lower(),
    }
    if settings.max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(settings.max_offsets_per_trigger)
    return options


def kafka_feed(spark: SparkSession, settings: StreamSettings, topic: str) -> DataFrame:
    """A topic as a stream with the columns of Spark's Kafka source."""
    return spark.readStream.format("kafka").options(**kafka_options(settings, topic)).load()


def stats_feed(spark: SparkSession, settings: StreamSettings) -> DataFrame:
    return kafka_feed(spark, settings, settings.stats_topic)


def alerts_feed(spark: SparkSession, settings: StreamSettings) -> DataFrame:
    """The alert topic. The position is kept in the checkpoint of the job that reads it."""
    return kafka_feed(spark, settings, settings.alerts_topic)


def folder_feed(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A folder of text files, one message per line, as a stream with a `value` column."""
    reader = spark.readStream.format("text")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def table_feed(spark: SparkSession, path: str, schema, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """A Parquet table, a folder of files or one file, as a stream; a batch takes so many files at most."""
    reader = spark.readStream.schema(schema).format("parquet").option("maxFilesPerTrigger", files_per_trigger)
    folder, _, name = path.rstrip("/").rpartition("/")
    # Spark's stream reader wants a folder: where rows come from a file of the very name, it reads the folder around it
    row = spark.read.schema(schema).parquet(path).select("_metadata.file_name").first()
    if row is not None and row.file_name == name:
        return reader.option("pathGlobFilter", name).load(folder)
    return reader.load(path)
