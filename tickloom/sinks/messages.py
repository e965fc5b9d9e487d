"""Keyed messages out to a topic, or to files that stand in for one."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickloom.schema import TopicOptions


def publish(messages: DataFrame, options: TopicOptions, fmt: str = "kafka") -> None:
    """Send ``key`` and ``value`` columns to the topic; the key picks the partition."""
    messages.write.format(fmt).options(
        **{
            "kafka.bootstrap.servers": options.brokers,
            "topic": options.topic,
            **dict(options.extra),
        }
    ).save()


def write_message_files(messages: DataFrame, path: str, mode: str = "append") -> None:
    """Write messages as Parquet files for ``message_file_stream`` to pick up."""
    messages.select("key", "value").write.mode(mode).parquet(path)
