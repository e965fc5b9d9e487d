"""Time-series points: a stored table, line files, and a line-protocol endpoint."""

from __future__ import annotations

import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)

from tickloom.functions.scalar import calendar_day
from tickloom.operators.clean import last_write_wins
from tickloom.operators.encode import MEASUREMENT, bar_lines
from tickloom.schema import VALUE_FIELDS
from tickloom.sinks.archive import filed_under, replace_partitions, spread_by_day

Send = Callable[[bytes], None]


def settle_points(bars: DataFrame, order: Sequence[str]) -> DataFrame:
    """One bar per point identity, stock and second: the last in ``order``.

    Where that is a single column, the later bar wins among those it puts level.
    """
    second = F.date_trunc("second", F.col("date").cast("timestamp"))
    keyed = bars.withColumn("time", second)
    if len(order) == 1:
        order = list(dict.fromkeys([*order, "date"]))
    return last_write_wins(keyed, ["stock", "time"], order)


def write_point_table(
    bars: DataFrame,
    path: str,
    batch_id: int | None = None,
    order: Sequence[str] = ("date",),
    measurement: str = MEASUREMENT,
    spread: bool = False,
    run: str | None = None,
) -> None:
    """File bars as points, Parquet by day, run and batch, for ``read_points``.

    ``batch_id`` and ``run`` are those of :func:`tickloom.sinks.archive.write_archive`.

    A batch may carry several revisions of a point; the last in ``order`` is written.
    """
    rows = settle_points(bars, order).select(
        F.lit(measurement).alias("measurement"),
        "stock",
        "time",
        *VALUE_FIELDS,
        calendar_day("date").alias("day"),
    )
    rows = spread_by_day(rows) if spread else rows
    replace_partitions(rows, path, "parquet", filed_under(batch_id, run))


def write_point_lines(
    bars: DataFrame,
    path: str,
    batch_id: int | None = None,
    order: Sequence[str] = ("date",),
    run: str | None = None,
) -> None:
    """File bars as line-protocol text by day, run and batch, ready for bulk loading.

    As in :func:`write_point_table`, a batch has at most one line per point: lines of
    one identity would otherwise overwrite each other in whatever order they load.
    """
    filed = settle_points(bars, order).withColumn("day", calendar_day("date"))
    lines = bar_lines(filed, keep=["day"])
    replace_partitions(lines, path, "text", filed_under(batch_id, run))


def http_send(url: str, org: str, bucket: str, token: str, tries: int = 5) -> Send:
    """A sender that posts lines to a write endpoint, second precision, with retries."""
    query = urllib.parse.urlencode({"org": org, "bucket": bucket, "precision": "s"})
    target = f"{url.rstrip('/')}/api/v2/write?{query}"
    headers = {"Authorization": f"Token {token}", "Content-Type": "text/plain; charset=utf-8"}

    def send(body: bytes) -> None:
        for attempt in range(tries):
            try:
                request = urllib.request.Request(target, data=body, headers=headers)
                urllib.request.urlopen(request, timeout=60).close()
                return
            except urllib.error.HTTPError as error:
                if error.code not in (429, 503) or attempt == tries - 1:
                    raise
            except urllib.error.URLError:
                if attempt == tries - 1:
                    raise
            time.sleep(2**attempt)

    return send


def line_sink(send: Send, name: str = "line_points", lines_per_request: int = 5000) -> type[DataSource]:
    """A Spark data source that writes a frame with a ``line`` column through ``send``.

    Register it with ``spark.dataSource.register(line_sink(...))`` and write to
    ``format(name)``, in batch or as a stream. Each task sends its own rows in
    requests of limited size. Points are identified by measurement, tags and second,
    so a task or batch that is run again overwrites what it already sent.
    """

    def deliver(batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        for batch in batches:
            lines = batch.column("line")
            for start in range(0, len(lines), lines_per_request):
                part = lines.slice(start, lines_per_request).drop_null().to_pylist()
                if part:
                    send("\n".join(part).encode())
        return WriterCommitMessage()

    class BatchWriter(DataSourceArrowWriter):
        def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
            return deliver(iterator)

    class StreamWriter(DataSourceStreamArrowWriter):
        def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
            return deliver(iterator)

        def commit(self, messages: list, batchId: int) -> None:
            pass

        def abort(self, messages: list, batchId: int) -> None:
            pass

    class LineSink(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite: bool) -> BatchWriter:
            return BatchWriter()

        def streamWriter(self, schema, overwrite: bool) -> StreamWriter:
            return StreamWriter()

    return LineSink
