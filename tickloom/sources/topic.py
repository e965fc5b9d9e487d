"""Keyed bar messages from a topic, or from files that stand in for one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.schema import MESSAGE_SCHEMA, TopicOptions


def _options(options: TopicOptions) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": options.brokers,
        "subscribe": options.topic,
        **dict(options.extra),
    }


def topic_stream(
    spark: SparkSession, options: TopicOptions, fmt: str = "kafka"
) -> DataFrame:
    """Unbounded messages of a topic, from the newest on unless told otherwise."""
    reader = spark.readStream.format(fmt).options(**_options(options))
    reader = reader.option("startingOffsets", options.starting_offsets)
    reader = reader.option("maxOffsetsPerTrigger", options.max_offsets_per_trigger)
    return as_messages(reader.load())


def topic_replay(
    spark: SparkSession, options: TopicOptions, fmt: str = "kafka"
) -> DataFrame:
    """Everything the topic holds at this moment, from its earliest record."""
    reader = spark.read.format(fmt).options(**_options(options))
    reader = reader.option("startingOffsets", "earliest").option("endingOffsets", "latest")
    return as_messages(reader.load())


def as_messages(records: DataFrame) -> DataFrame:
    """Topic records as ``key``, ``value`` text, ``arrival`` time and ``offset``.

    Records without a value are tombstones, not bars, and are skipped. The offset
    tells copies of a record apart.
    """
    return records.where(F.col("value").isNotNull()).select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("arrival"),
        "offset",
    )


def tombstones(records: DataFrame) -> DataFrame:
    """What :func:`as_messages` skips: keys, arrival times and offsets of deletions."""
    return records.where(F.col("value").isNull()).select(
        F.col("key").cast("string").alias("key"), F.col("timestamp").alias("arrival"), "offset"
    )


def message_file_stream(
    spark: SparkSession, path: str, files_per_batch: int = 1000
) -> DataFrame:
    """A stream over a folder of Parquet message files, shaped like a topic stream.

    A large backlog is worked off in batches of bounded size.
    """
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _file_messages(reader.parquet(path))


def message_file_replay(spark: SparkSession, path: str) -> DataFrame:
    """The batch form of :func:`message_file_stream`."""
    return _file_messages(spark.read.schema(MESSAGE_SCHEMA).parquet(path))


def message_file_tombstones(spark: SparkSession, path: str) -> DataFrame:
    """The records of a folder of message files that have no value."""
    return tombstones(_records(spark.read.schema(MESSAGE_SCHEMA).parquet(path)))


def _file_messages(files: DataFrame) -> DataFrame:
    return as_messages(_records(files))


def _records(files: DataFrame) -> DataFrame:
    """Message files in the shape of topic records."""
    return files.select(
        "key",
        "value",
        F.col("_metadata.file_modification_time").alias("timestamp"),
        F.col("_metadata.row_index").alias("offset"),
    )
