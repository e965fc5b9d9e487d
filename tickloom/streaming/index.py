"""Exact-copy removal over any delay: an index of what has passed, filed by day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalar import calendar_day
from tickloom.schema import BAR_FIELDS
from tickloom.sinks.archive import replace_partitions
from tickloom.streaming.live import BatchSink, run_of

_INDEX = "digest binary, day date, run string, batch_id bigint"


def digest_of(keys: Sequence[str]):
    """A SHA-256 of the values of ``keys``: equal ones, nulls and types included, agree."""
    return F.unhex(F.sha2(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}), 256))


def pass_once(path: str, keys: Sequence[str] = tuple(BAR_FIELDS), time: str = "date") -> BatchSink:
    """A batch sink that files the rows it has not seen before, however long ago.

    Below ``path``: ``rows``, by day, and ``index``, their digests, by the same day. A
    batch is joined with the index of the days it has rows of, other folders are not
    read, and nothing expires, so copies may be weeks apart. State is not kept in the
    stream: what a batch costs grows with the history of its days, not of the stream.

    Both are filed by run and batch and replaced as folders. A batch that is repeated
    leaves its own earlier digests out of account and files the same rows again: rows
    are written first, so a batch that breaks off between the two is whole after its
    repetition. Rows without ``time`` are filed, and compared, under a day of their own.
    One stream writes below ``path`` at a time.
    """

    def deliver(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, run_of(batch)
        day = F.coalesce(calendar_day(F.col(time).cast("timestamp")), F.to_date(F.lit("0001-01-01")))
        # Copies within a batch meet in each map task first.
        marked = batch.dropDuplicates(list(keys)).withColumns({"day": day, "digest": digest_of(keys)})
        fresh = marked
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/index")
        if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            # As text: calendars of Python and Java part ways in early years.
            days = [row[0] for row in batch.select(day.cast("string")).distinct().collect()]
            days = [F.lit(text).cast("date") for text in days]
            index = spark.read.schema(_INDEX).parquet(f"{path}/index").where(F.col("day").isin(days))
            index = index.where(~((F.col("run") == run) & (F.col("batch_id") == batch_id)))
            fresh = marked.join(index.select("day", "digest"), ["day", "digest"], "left_anti")
        fresh = fresh.persist()
        try:
            replace_partitions(fresh.drop("digest"), f"{path}/rows", "parquet", (batch_id, run))
            replace_partitions(fresh.select("digest", "day"), f"{path}/index", "parquet", (batch_id, run))
        finally:
            fresh.unpersist()

    return deliver
