"""Ingest: the newest bar of each symbol of the universe, as keyed messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.encode import to_messages
from tickloom.operators.latest import (
    in_universe,
    latest_bar,
    latest_in_universe,
    lookback,
)
from tickloom.schema import TopicOptions
from tickloom.sinks.messages import publish, write_message_files
from tickloom.streaming.live import POLL_EVERY, BatchSink, run_of, start_batches


def latest_messages(
    bars: DataFrame, universe: Sequence[str] | DataFrame, as_of: Column, span: str = "1 day"
) -> DataFrame:
    """Messages with the newest bar before ``as_of``, at most ``span`` old, per symbol."""
    return to_messages(latest_in_universe(lookback(bars, as_of, span), universe))


def publish_to_files(path: str) -> BatchSink:
    """A batch sink that writes the newest bar of each symbol as message files.

    Files go by run and batch: a batch that is repeated replaces its own, and a new
    checkpoint, which numbers its batches from 0 again, adds to what is there.
    """

    def deliver(batch: DataFrame, batch_id: int) -> None:
        newest = to_messages(latest_bar(batch))
        write_message_files(newest, f"{path}/run={run_of(batch)}/batch_id={batch_id}", "overwrite")

    return deliver


def publish_to_topic(options: TopicOptions) -> BatchSink:
    """A batch sink that sends the newest bar of each symbol to a topic."""

    def deliver(batch: DataFrame, batch_id: int) -> None:
        publish(to_messages(latest_bar(batch)), options)

    return deliver


def run_ingest(
    landed: DataFrame,
    universe: Sequence[str] | DataFrame,
    deliver: BatchSink,
    checkpoint: str,
    every: str | None = POLL_EVERY,
    span: str | None = None,
) -> StreamingQuery:
    """Every few seconds, pass on the newest bars that landed since the last time.

    With ``span`` (such as ``1 day``) bars older than that when their batch runs are
    not news and are left out; that is the trailing range of a live feed.
    """
    if span is not None:
        landed = landed.where(F.col("date") >= F.current_timestamp() - F.expr(f"interval {span}"))
    return start_batches(in_universe(landed, universe), deliver, checkpoint, every)
