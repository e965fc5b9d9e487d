"""Registered queries over data that arrives in parts, late, twice or revised.

Their feeds are made from the whole ``events`` table: parts follow each other in time,
and some rows come a part later than they should.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow.fs as pafs
from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.asof import as_of, poll_instants
from tickloom.operators.clean import distinct_bars, last_write_wins, union_bars
from tickloom.operators.cluster import cluster_by_coreset, cluster_stocks
from tickloom.operators.decode import accepted, typed_bars
from tickloom.operators.encode import bar_lines
from tickloom.operators.moments import update_summary
from tickloom.operators.settle import settle_by
from tickloom.operators.stats import stock_summary
from tickloom.plans.catalog import (
    MEAN_DECIMALS,
    events_table,
    message_folder,
    query,
    resent_bars,
    rounded,
    rounded_summary,
    tick_messages,
    zoneless,
)
from tickloom.plans.audit import audit_deliveries
from tickloom.plans.speed_layer import run_speed_layer
from tickloom.schema import BAR_FIELDS, BAR_SCHEMA, empty_bars
from tickloom.session import run_dir
from tickloom.sinks.archive import clean_archive, compact_tail, replace_partitions, scan_with_tail, write_archive
from tickloom.sinks.messages import write_message_files
from tickloom.sinks.staged import published_lines, staged_sink
from tickloom.sources.archive import scan_archive
from tickloom.sources.folders import move
from tickloom.sources.ticks import event_bars
from tickloom.sources.topic import message_file_replay, message_file_stream, message_file_tombstones
from tickloom.streaming.index import pass_once
from tickloom.streaming.keyed import rocksdb_state, rolling_returns, superseding_bars
from tickloom.streaming.live import POLL_EVERY, BatchSink, distinct_stream, run_of, start_batches, start_files


def in_parts(rows: DataFrame, time: str, parts: int, late: Column | None = None) -> DataFrame:
    """``rows`` with the number of their ``part``, ranges of ``time`` of one length.

    Rows that are ``late`` come one part after their own; the last part is the last.
    """
    seconds = F.unix_timestamp(time)
    lo, hi = rows.agg(F.min(seconds), F.max(seconds)).first()
    place = F.floor(F.lit(parts) * (seconds - F.lit(lo or 0)) / F.lit((hi or 0) - (lo or 0) + 1))
    if late is not None:
        place = F.least(place + late.cast("int"), F.lit(parts - 1))
    return rows.withColumn("part", place.cast("int"))


def run_parts(landed: DataFrame, topic: str, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Feed a stream with the parts of ``landed``, each when the one before is done.

    A part is moved into sight as a whole, so it makes one batch.
    """
    spark, rows, query = landed.sparkSession, landed.drop("part"), None
    for part in sorted(r[0] for r in landed.select("part").distinct().collect()):
        landed.where(F.col("part") == part).drop("part").write.parquet(f"{topic}/_part-{part}")
        move(spark, f"{topic}/_part-{part}", f"{topic}/part-{part}")
        if query is None:
            with rocksdb_state(spark):
                query = start(spark.readStream.schema(rows.schema).parquet(f"{topic}/part-*"))
        query.processAllAvailable()
    if query is not None:
        query.stop()
    landed.unpersist()


def change_log(path: str) -> BatchSink:
    """A batch sink that files what a batch changed under its run and number."""

    def deliver(batch: DataFrame, batch_id: int) -> None:
        replace_partitions(batch, path, "parquet", (batch_id, run_of(batch)), by=())

    return deliver


@query
def stream_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-sent bars in four batches, every fifth a batch late: the last version of each
    bar, and in how many batches it was sent on."""
    target = run_dir(spark, "revisions")
    ticks = resent_bars(spark, sf_dir).withColumn("offset", F.col("volume").cast("bigint"))
    parts = in_parts(ticks, "ingest_ts", 4, F.col("offset") % 5 == 0)
    # All of a part reach the topic at its end, by the topic's clock.
    landed = typed_bars(
        parts,
        F.col("ingest_ts").cast("timestamp").alias("ingest_ts"),
        "offset",
        "part",
        F.timestamp_seconds((F.col("part") + 1) * 86_400).alias("arrival"),
    ).persist()
    run_parts(
        landed,
        f"{target}/topic",
        lambda stream: start_batches(
            superseding_bars(stream, "1 day"), change_log(f"{target}/sent"), f"{target}/checkpoint", "0 seconds"
        ),
    )
    log = spark.read.parquet(f"{target}/sent")
    last = last_write_wins(log.select(*BAR_FIELDS, "ingest_ts"), ["stock", "date"], ["ingest_ts"])
    times = log.groupBy("stock", "date").agg(F.count("*").alias("times_sent"))
    return zoneless(last.join(times, ["stock", "date"]).drop("ingest_ts"))


@query
def stream_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns and averages over five rows from five batches, some bars a batch late."""
    target = run_dir(spark, "rolling")
    late = F.floor(F.unix_timestamp("date") / 3600) % 7 == 0
    parts = in_parts(event_bars(spark, sf_dir), "date", 5, late)
    landed = typed_bars(parts, F.col("date").cast("timestamp").alias("ingest_ts"), "part").persist()
    run_parts(
        landed,
        f"{target}/topic",
        lambda stream: start_batches(
            rolling_returns(stream, 5, lateness="15 days"), change_log(f"{target}/told"), f"{target}/checkpoint", "0 seconds"
        ),
    )
    log = spark.read.parquet(f"{target}/told").where("not late").drop("late", "run", "close")
    settled = zoneless(last_write_wins(log, ["stock", "date"], ["batch_id"]).drop("batch_id"))
    return rounded(settled, MEAN_DECIMALS, "moving_avg")


def archived_in_parts(spark: SparkSession, sf_dir: str, archive: str, parts: int):
    """Write bars to an archive in ranges of time, the last part with copies of all before."""
    bars = event_bars(spark, sf_dir).withColumn("ingest_ts", F.col("date"))
    cut = in_parts(bars, "date", parts).persist()
    for part in range(parts):
        rows = cut.where(F.col("part") == part) if part < parts - 1 else cut
        write_archive(rows.drop("part"), archive, part, spread=True)
        yield part
    cut.unpersist()


@query
def archive_tail_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive that grows by parts and is compacted after the first, cleaned after
    the second and compacted again: every bar once, the last part from the tail."""
    archive, store = run_dir(spark, "archive"), run_dir(spark, "store")
    for part in archived_in_parts(spark, sf_dir, archive, 4):
        if part < 2:
            compact_tail(spark, archive, store)
        if part == 1:
            clean_archive(spark, archive, store)
    return zoneless(distinct_bars(accepted(scan_with_tail(spark, archive, store))))


@query
def summary_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-stock summary kept up while an archive grows; each run reads changed days only."""
    archive, store, kept = (run_dir(spark, name) for name in ("archive", "store", "moments"))
    summary = None
    for part in archived_in_parts(spark, sf_dir, archive, 3):
        if part == 1:
            compact_tail(spark, archive, store)
        summary = update_summary(spark, archive, store, kept)
    return rounded_summary(summary)


def appended(frame: DataFrame, path: str) -> DataFrame:
    """``frame`` added to a folder that streams read, and the stream over it."""
    frame.write.mode("append").parquet(path)
    return frame.sparkSession.readStream.schema(frame.schema).parquet(path)


def none_late(query) -> None:
    """Wait for a stream, and fail if its watermark has let a row go."""
    query.awaitTermination()
    late = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    if late:
        raise AssertionError(f"{late} rows came behind the watermark")


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every bar delivered twice, let through once, with state of some hours only.

    The feed comes in ranges of time, a batch each whatever its number of files; when a
    range has passed, what the one before it left in the state has expired.
    """
    target = run_dir(spark, "distinct")
    once = typed_bars(in_parts(event_bars(spark, sf_dir), "date", 3), "part").persist()
    for part in range(3):
        bars = once.where(F.col("part") == part).drop("part")
        twice = union_bars(bars, bars).withColumn("offset", F.monotonically_increasing_id())
        stream = appended(twice, f"{target}/topic")
        passed = distinct_stream(stream, "2 hours", spread_by=F.col("offset")).select(*BAR_FIELDS)
        none_late(start_files(passed, f"{target}/bars", f"{target}/checkpoint"))
    once.unpersist()
    return zoneless(spark.read.schema(BAR_SCHEMA).parquet(f"{target}/bars"))


@query
def stream_dedup_any_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars in ranges of time, each followed by copies of all before it, weeks late."""
    target = run_dir(spark, "once")
    parts = typed_bars(in_parts(event_bars(spark, sf_dir), "date", 3), "part").persist()
    for part in range(3):
        stream = appended(parts.where(F.col("part") <= part).drop("part"), f"{target}/topic")
        start_batches(stream, pass_once(f"{target}/seen"), f"{target}/checkpoint").awaitTermination()
    parts.unpersist()
    return zoneless(spark.read.parquet(f"{target}/seen/rows").select(*BAR_FIELDS))


@query
def poll_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest bar of every stock, of the trailing day, every six hours."""
    bars = event_bars(spark, sf_dir)
    stocks = bars.select("stock").distinct()
    return as_of(bars, poll_instants(bars, stocks, "6 hours"), span="1 day")


def fails_once(folder: str):
    """A hook that raises in the first task that calls it, in all of a run's tries."""

    def check(partition: int) -> None:
        files, root = pafs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
        files.create_dir(root, recursive=True)
        if files.get_file_info(f"{root}/failed").type == pafs.FileType.NotFound:
            with files.open_output_stream(f"{root}/failed") as out:
                out.write(str(partition).encode())
            raise RuntimeError("this task fails once")

    return check


@query
def stream_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars as lines through the two-step sink: a task fails, and the batch runs again.

    Where a failed task is not run again by itself, the query stops, withdraws what it
    staged and is started once more.
    """
    target = run_dir(spark, "staged")
    stream = bar_lines(appended(typed_bars(event_bars(spark, sf_dir)), f"{target}/landed"))
    spark.dataSource.register(staged_sink("staged_lines", before_write=fails_once(f"{target}/hook")))
    for _ in range(2):
        writer = stream.writeStream.format("staged_lines").option("checkpointLocation", f"{target}/checkpoint")
        query = writer.option("run", "bars").trigger(availableNow=True).start(f"{target}/lines")
        try:
            query.awaitTermination()
        except StreamingQueryException as stopped:
            if "this task fails once" not in str(stopped):
                raise
    return published_lines(spark, f"{target}/lines").select("line")


@query
def empty_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of the table's bars where every record is refused: a typed relation
    without rows, joined to the bars by union."""
    archive = run_dir(spark, "archive")
    bars = event_bars(spark, sf_dir)
    bar_json_without_date = bars.select(F.to_json(F.struct("stock", "close")).alias("value"))
    bar_json_without_date.write.text(archive)
    nothing = zoneless(accepted(scan_archive(spark, archive)))
    return union_bars(zoneless(empty_bars(spark)), nothing, bars)


@query
def tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic in which every view deletes its key: messages and tombstones per kind."""
    ticks = events_table(spark, sf_dir)
    value = F.when(F.col("event_type") != "view", F.col("props"))
    messages = ticks.select(F.col("event_type").alias("key"), value.alias("value"))
    path = f"{run_dir(spark, 'topic')}/messages"
    write_message_files(messages, path)
    kept = message_file_replay(spark, path).groupBy("key").agg(F.count("value").alias("messages"))
    deleted = message_file_tombstones(spark, path).groupBy("key").agg(F.count("*").alias("tombstones"))
    both = kept.join(deleted, "key", "full_outer")
    return both.fillna(0, ["messages", "tombstones"])


@query
def stream_poll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed bars polled at a fixed cadence until all have been passed on."""
    target = run_dir(spark, "poll")
    stream = appended(typed_bars(event_bars(spark, sf_dir)), f"{target}/landed")
    query = start_batches(stream, change_log(f"{target}/polled"), f"{target}/checkpoint", POLL_EVERY)
    query.processAllAvailable()
    query.stop()
    return zoneless(spark.read.parquet(f"{target}/polled").select(*BAR_FIELDS))


@query
def stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The speed layer over damaged messages: rows that each sink was due and holds, and
    the batches of which it does not hold what it should."""
    damaged = tick_messages(spark, sf_dir).select(F.col("event_id").cast("string").alias("key"), "value")
    target = run_dir(spark, "live")
    stream = message_file_stream(spark, message_folder(spark, damaged))
    run_speed_layer(stream, target, audited=True).awaitTermination()
    due = spark.read.parquet(f"{target}/deliveries").groupBy("sink").agg(F.sum("rows").alias("rows"))
    off = audit_deliveries(spark, target).groupBy("sink").agg(F.count("*").alias("batches_off"))
    return due.join(off, "sink", "left").fillna(0, "batches_off")


@query
def clusters_coreset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups fitted on a coreset: stocks labelled, groups used, and whether the cost is
    within 5% of a fit on all stocks."""
    summary = stock_summary(event_bars(spark, sf_dir)).persist()
    whole, cut = cluster_stocks(summary), cluster_by_coreset(summary)
    checks = cut.labels.agg(F.count("*").alias("stocks"), F.count_distinct("prediction").alias("groups"))
    return checks.withColumn("near", F.lit(cut.cost <= 1.05 * whole.cost))


@query
def settled_any_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each user's day the last event by type, then price, then a text of its number."""
    writes = events_table(spark, sf_dir).select(
        "user_id",
        F.to_date("ts").alias("day"),
        "event_type",
        F.floor(F.col("value") / 10).alias("price_band"),
        F.concat(F.lit("e"), F.col("event_id")).alias("name"),
        "value",
    )
    return settle_by(writes, ["user_id", "day"], ["event_type", "price_band", "name"])
