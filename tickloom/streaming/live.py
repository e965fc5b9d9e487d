"""Micro-batch plumbing: start a query, feed several sinks, drop redeliveries."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tickloom.schema import BAR_FIELDS

BatchSink = Callable[[DataFrame, int], None]

# Fixed value: how often the feed is polled.
POLL_EVERY = "5 seconds"

log = logging.getLogger(__name__)


def fan_out(*sinks: BatchSink) -> BatchSink:
    """One batch into several sinks, computed once.

    With more than one sink the batch is kept, on disk where memory is short, until all sinks have it. The
    sinks must replace what an earlier try of the same batch id wrote, since a
    failure between two of them repeats the batch from the start.
    """

    if len(sinks) == 1:
        return sinks[0]

    def deliver(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return deliver


def run_of(batch: DataFrame) -> str:
    """The query a micro-batch belongs to: kept in its checkpoint, so restarts share it."""
    name = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not name:
        raise ValueError("only a micro-batch of a running query has a run")
    return f"query-{name}"


def start_batches(
    stream: DataFrame,
    deliver: BatchSink,
    checkpoint: str,
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Run ``deliver`` on each appended micro-batch.

    With ``every`` (such as ``POLL_EVERY``) the query runs until stopped; without
    it, until the data present now is used up. The checkpoint must be on shared
    storage: it is what a restart continues from.
    """
    writer = stream.writeStream.foreachBatch(deliver).outputMode("append")
    return _start(writer, checkpoint, every, name)


def start_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to a folder of files, exactly once."""
    writer = stream.writeStream.format(fmt).outputMode("append").option("path", path)
    return _start(writer, checkpoint, every, name)


def _start(writer, checkpoint: str, every: str | None, name: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if every:
        return writer.trigger(processingTime=every).start()
    return writer.trigger(availableNow=True).start()


def distinct_stream(
    bars: DataFrame,
    delay: str,
    keys: Sequence[str] = tuple(BAR_FIELDS),
    spread_by: Column | None = None,
    salts: int = 32,
) -> DataFrame:
    """Let the first of several exact redeliveries through, over the whole stream.

    ``delay`` is how far apart in event time copies may arrive, and the age beyond
    which rows count as late and are dropped; the progress log shows how many were.
    For revised bars use ``settle_revisions`` instead: those keep the last, not the
    first.

    Streaming deduplication shuffles every copy to the key's task. Where one record
    may be a large part of the stream, give a ``spread_by`` column that differs
    between copies (a topic offset, a row index): copies then meet in ``salts``
    places first and only one from each goes on to the key.
    """
    marked = bars.withWatermark("date", delay)
    if spread_by is not None:
        marked = marked.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)))
        marked = marked.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return marked.dropDuplicatesWithinWatermark(list(keys))


class ProgressLog(StreamingQueryListener):
    """Acknowledge each batch: rows read, rows too late, and observed metrics.

    ``report`` gets one JSON line per batch; by default it goes to the logger.
    """

    def __init__(self, report: Callable[[str], None] = log.info) -> None:
        self.report = report

    def onQueryStarted(self, event) -> None:
        self.report(json.dumps({"started": str(event.id), "name": event.name}))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        late = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        observed = {
            name: row.asDict() for name, row in (progress.observedMetrics or {}).items()
        }
        self.report(
            json.dumps(
                {
                    "batch": progress.batchId,
                    "rows": progress.numInputRows,
                    "late": late,
                    "observed": observed,
                },
                default=str,
            )
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.report(json.dumps({"ended": str(event.id), "error": event.exception}))
