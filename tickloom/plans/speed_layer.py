"""The speed layer: messages in; points, archive and dead letters out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.decode import accepted, decode_bars, rejected
from tickloom.operators.encode import bar_lines
from tickloom.plans.audit import write_deliveries
from tickloom.sinks.archive import replace_partitions, write_archive
from tickloom.sinks.points import settle_points, write_point_lines
from tickloom.streaming.live import BatchSink, fan_out, run_of, start_batches

# A stock's messages share a partition, where the offset is their order.
ARRIVAL_ORDER = ["ingest_ts", "offset"]


def write_rejects(batch: DataFrame, path: str, batch_id: int) -> None:
    """File dead letters by batch; one without any leaves no folder."""
    replace_partitions(rejected(batch), path, "parquet", (batch_id, run_of(batch)), by=())


def write_progress(batch: DataFrame, path: str, batch_id: int) -> None:
    """File one row per batch: how many records it read, and how many it refused."""
    counts = batch.agg(
        F.count(F.lit(1)).alias("rows_read"), F.count("reject_reason").alias("rows_rejected")
    )
    replace_partitions(counts, path, "parquet", (batch_id, run_of(batch)), by=())


def good(batch: DataFrame) -> DataFrame:
    """Good bars with what says which of two came later."""
    return accepted(batch, *ARRIVAL_ORDER)


def send_lines(fmt: str) -> BatchSink:
    """A batch sink that sends good bars as lines to a registered ``line_sink``."""

    def deliver(batch: DataFrame, batch_id: int) -> None:
        points = settle_points(good(batch), ARRIVAL_ORDER)
        bar_lines(points).write.format(fmt).mode("append").save()

    return deliver


def run_speed_layer(
    messages: DataFrame,
    target: str,
    every: str | None = None,
    more: Sequence[BatchSink] = (),
    audited: bool = False,
) -> StreamingQuery:
    """Decode messages once and write points, archive and dead letters per batch.

    Below ``target``: ``points`` (line protocol), ``archive`` (JSON lines),
    ``rejects``, ``progress`` (a row per batch) and the query's ``checkpoint``. All
    writes replace the folders of their query and batch, so a restart repeats a broken
    batch without doubling rows, and a new checkpoint replaces nothing.
    Nothing is collected: every task writes its own rows. The archive keeps every
    bar; of revisions within a batch the points keep the one that arrived last. Sinks
    in ``more`` get the decoded batch as well. ``audited`` also files what every sink is
    due to hold, for :func:`tickloom.plans.audit.audit_deliveries`; it encodes the batch
    a second time.
    """
    decoded = decode_bars(messages, "value", arrival="arrival").observe(
        "batch",
        F.count(F.lit(1)).alias("read"),
        F.count("reject_reason").alias("rejected"),
    )
    deliver = fan_out(
        lambda b, i: write_point_lines(good(b), f"{target}/points", i, ARRIVAL_ORDER, run_of(b)),
        lambda b, i: write_archive(accepted(b, "ingest_ts"), f"{target}/archive", i, run=run_of(b)),
        lambda b, i: write_rejects(b, f"{target}/rejects", i),
        lambda b, i: write_progress(b, f"{target}/progress", i),
        *([lambda b, i: write_deliveries(b, f"{target}/deliveries", i, ARRIVAL_ORDER)] if audited else []),
        *more,
    )
    return start_batches(decoded, deliver, f"{target}/checkpoint", every)
