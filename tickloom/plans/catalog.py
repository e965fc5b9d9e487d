"""The registered queries: each operator over bars made from the ``events`` table.

Every query takes ``(spark, sf_dir)`` and reads the whole table. Dates are returned
without zone, as the oracle has them. Queries that write do so below a fresh folder
in the shared directory.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.text import iso_utc
from tickloom.operators.clean import (
    distinct_bars,
    last_write_wins,
    settle_revisions,
    union_bars,
)
from tickloom.operators.cluster import assemble_features, cluster_stocks
from tickloom.operators.decode import accepted, decode_bars, rejected, typed_bars
from tickloom.operators.encode import (
    bar_json,
    bar_lines,
    point_lines,
    to_messages,
    to_points,
)
from tickloom.operators.latest import (
    explode_universe,
    latest_bar,
    latest_in_universe,
    newest_instant,
    time_range,
)
from tickloom.operators.order import preview, sorted_bars
from tickloom.operators.returns import bar_returns, return_series
from tickloom.operators.stats import (
    AVERAGE_FIELDS,
    daily_prices,
    market_breadth,
    stock_summary,
)
from tickloom.plans.batch_layer import run_batch_layer, stored
from tickloom.plans.ingest import publish_to_files, run_ingest
from tickloom.plans.speed_layer import run_speed_layer
from tickloom.schema import BAR_FIELDS, BAR_SCHEMA, MESSAGE_SCHEMA, VALUE_FIELDS
from tickloom.session import pin_runtime, run_dir
from tickloom.sinks.archive import compact_archive, write_archive
from tickloom.sinks.messages import write_message_files
from tickloom.sinks.points import write_point_table
from tickloom.sinks.results import read_result, write_results
from tickloom.sources.archive import raw_dump, scan_archive
from tickloom.sources.points import read_points
from tickloom.sources.ticks import bars_of_events, event_bars
from tickloom.sources.topic import message_file_replay, message_file_stream
from tickloom.streaming.live import fan_out, run_of, start_batches, start_files

Query = Callable[[SparkSession, str], DataFrame]

# Decimals kept of means and deviations, whose last bits depend on the order of
# addition in any engine.
MEAN_DECIMALS = 10
DEVIATION_DECIMALS = 8

_REGISTERED: dict[str, Query] = {}


def registered() -> dict[str, Query]:
    """All queries, those of changing data included, which build on the ones here."""
    from tickloom.plans import changes  # noqa: F401  registers its queries

    return dict(_REGISTERED)


def query(build: Query) -> Query:
    """Register a query under its function name; its calendar is always UTC.

    Queries named like the operator they run end in ``_query`` here.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(pin_runtime(spark), sf_dir)

    _REGISTERED[build.__name__.removesuffix("_query")] = run
    return run


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def zoneless(frame: DataFrame, *columns: str) -> DataFrame:
    """Cast instants to ``timestamp_ntz``; the session zone is UTC."""
    names = columns or ("date",)
    return frame.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def rounded(frame: DataFrame, decimals: int, *columns: str) -> DataFrame:
    return frame.withColumns({n: F.round(n, decimals) for n in columns})


def rounded_summary(summary: DataFrame) -> DataFrame:
    means = rounded(summary, MEAN_DECIMALS, *AVERAGE_FIELDS)
    return rounded(means, DEVIATION_DECIMALS, "std_dev_close")


def message_folder(spark: SparkSession, messages: DataFrame) -> str:
    path = f"{run_dir(spark, 'messages')}/topic"
    write_message_files(messages, path)
    return path


# -- bars, statistics, windows -------------------------------------------------


@query
def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars from ticks."""
    return event_bars(spark, sf_dir)


@query
def basic_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-stock means, deviation and extremes."""
    return rounded_summary(stock_summary(event_bars(spark, sf_dir)))


@query
def bar_returns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with previous close and return."""
    return bar_returns(event_bars(spark, sf_dir)).drop("moving_avg_1d")


@query
def return_series_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reported projection of returns."""
    return return_series(bar_returns(event_bars(spark, sf_dir)))


@query
def moving_avg_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moving average over one row, as reported."""
    returns = bar_returns(event_bars(spark, sf_dir))
    return returns.select("stock", "date", "moving_avg_1d")


@query
def moving_avg_5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moving average over five rows, which may lie in several earlier days."""
    returns = bar_returns(event_bars(spark, sf_dir), 5, average_name="moving_avg")
    return rounded(returns.select("stock", "date", "moving_avg"), MEAN_DECIMALS, "moving_avg")


@query
def moving_avg_50(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moving average over fifty rows, more than a piece may hold of a stock."""
    returns = bar_returns(event_bars(spark, sf_dir), 50, average_name="moving_avg")
    return rounded(returns.select("stock", "date", "moving_avg"), MEAN_DECIMALS, "moving_avg")


@query
def daily_prices_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First open, last close and direction per stock and day."""
    return daily_prices(event_bars(spark, sf_dir))


@query
def market_breadth_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stocks up, down and unchanged per day."""
    return market_breadth(daily_prices(event_bars(spark, sf_dir)))


# -- duplicates, revisions, latest, ranges -------------------------------------


@query
def union_bars_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bag union: every bar twice."""
    once = event_bars(spark, sf_dir)
    return union_bars(once, once)


@query
def dedup_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies removed again."""
    once = event_bars(spark, sf_dir)
    return distinct_bars(union_bars(once, once))


@query
def revised_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each tick re-sends its hour's bar; the one ingested last stays."""
    return settle_revisions(resent_bars(spark, sf_dir))


def resent_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bar per tick: the tick's hour, sent again with the tick's values."""
    return events_table(spark, sf_dir).select(
        F.concat(F.lit("S"), F.col("user_id")).alias("stock"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("date"),
        *[F.col("value").alias(name) for name in VALUE_FIELDS[:-1]],
        F.col("event_id").cast("double").alias("volume"),
        F.col("ts").alias("ingest_ts"),
    )


@query
def point_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last write per point identity: event type and minute."""
    writes = events_table(spark, sf_dir).select(
        "event_type",
        F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("minute"),
        "event_id",
        "value",
    )
    return last_write_wins(writes, ["event_type", "minute"], ["event_id"])


@query
def latest_bar_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest bar of every stock."""
    return latest_bar(event_bars(spark, sf_dir))


def watch_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A comma-separated symbol list per event: an even-numbered stock, an unknown one."""
    mine, other = F.col("user_id") - F.col("user_id") % 2, F.col("user_id") + 1_000_000
    return events_table(spark, sf_dir).select(
        F.concat(F.lit("S"), mine, F.lit(",S"), other).alias("symbols")
    )


@query
def universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The symbols named in lists."""
    return explode_universe(watch_lists(spark, sf_dir), "symbols")


@query
def universe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest bar of every symbol named in lists."""
    symbols = explode_universe(watch_lists(spark, sf_dir), "symbols")
    return latest_in_universe(event_bars(spark, sf_dir), symbols)


def last_day_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks of the day before the hour of the newest tick, that hour excluded."""
    ticks = events_table(spark, sf_dir)
    start = newest_instant(ticks, "ts", "hour", back="1 day")
    return time_range(ticks, start, newest_instant(ticks, "ts", "hour"), "ts")


@query
def lookback_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of the trailing day. The range is cut on the ticks, in the scan."""
    return bars_of_events(last_day_events(spark, sf_dir))


@query
def ingest_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing day, universe, newest bar, keyed message, decoded again."""
    symbols = explode_universe(watch_lists(spark, sf_dir), "symbols")
    newest = latest_in_universe(bars_of_events(last_day_events(spark, sf_dir)), symbols)
    return zoneless(accepted(decode_bars(to_messages(newest))))


# -- encoders ------------------------------------------------------------------


@query
def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars as points, maps laid out as columns."""
    made = to_points(event_bars(spark, sf_dir))
    return made.select(
        "measurement",
        F.col("tags")["stock"].alias("tag_stock"),
        *[F.col("fields")[name].alias(f"field_{name}") for name in VALUE_FIELDS],
        "time",
    )


@query
def line_protocol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars as line protocol."""
    return bar_lines(event_bars(spark, sf_dir))


@query
def line_protocol_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines through points with arbitrary maps."""
    return point_lines(to_points(event_bars(spark, sf_dir)))


@query
def keyed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars as keyed JSON messages."""
    return to_messages(event_bars(spark, sf_dir))


@query
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode to messages, decode back."""
    return zoneless(accepted(decode_bars(to_messages(event_bars(spark, sf_dir)))))


# -- decode with dead letters --------------------------------------------------


def tick_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message per tick, damaged in a way that depends on the event type."""
    ticks = events_table(spark, sf_dir).select(
        "event_id",
        "event_type",
        F.concat(F.lit("S"), F.col("user_id")).alias("stock"),
        F.col("ts").alias("date"),
        *[F.col("value").alias(name) for name in VALUE_FIELDS],
        F.col("ts").alias("ingest_ts"),
    )
    whole = ticks.withColumn("value", bar_json(ticks))
    kind, text = F.col("event_type"), F.col("value")
    damaged = (
        F.when(kind == "error", F.rtrim(text, F.lit("}")))
        .when(kind == "purchase", F.regexp_replace(text, '"date":"[^"]*",', ""))
        .when(kind == "signup", F.regexp_replace(text, '"date":"[^"]*"', '"date":"junk"'))
        .when(kind == "view", F.regexp_replace(text, '"stock":"[^"]*",', ""))
        .otherwise(text)
    )
    return whole.select("event_id", damaged.alias("value"))


@query
def dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is refused, and why."""
    decoded = decode_bars(tick_messages(spark, sf_dir))
    return rejected(decoded, "value", "event_id").drop("value")


@query
def accepted_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left after refusals."""
    decoded = decode_bars(tick_messages(spark, sf_dir))
    return zoneless(accepted(decoded, "event_id"))


# -- archive, results, points on storage ---------------------------------------


@query
def archive_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the JSON archive by day, scan it back."""
    path = run_dir(spark, "archive")
    write_archive(event_bars(spark, sf_dir), path, spread=True)
    return zoneless(accepted(scan_archive(spark, path)))


@query
def raw_dump_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive as the text that is in it."""
    path = run_dir(spark, "archive")
    write_archive(event_bars(spark, sf_dir), path, spread=True)
    return raw_dump(spark, path).select("day", "value")


@query
def archive_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch archived under two ids, compacted to Parquet without copies."""
    path, target = run_dir(spark, "archive"), run_dir(spark, "compacted")
    once = event_bars(spark, sf_dir).withColumn("ingest_ts", F.col("date"))
    for batch_id in (0, 1):
        write_archive(once, path, batch_id, spread=True)
    compact_archive(spark, path, target)
    return zoneless(spark.read.parquet(target).select(*BAR_FIELDS))


@query
def points_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range read of stored points: the last hour, from day-filed Parquet."""
    path = run_dir(spark, "points")
    write_point_table(event_bars(spark, sf_dir), path, spread=True)
    start = newest_instant(spark.read.parquet(path), "time", back="1 hour")
    return zoneless(read_points(spark, path, start), "time")


@query
def results_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Breadth written twice under one run id and read once."""
    path = run_dir(spark, "results")
    breadth = market_breadth(daily_prices(event_bars(spark, sf_dir)))
    for _ in range(2):
        write_results({"market_breadth": breadth}, path, "run")
    return read_result(spark, path, "market_breadth", "run")


@query
def results_sink_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-stock summary as JSON documents."""
    path = run_dir(spark, "results")
    summary = stock_summary(event_bars(spark, sf_dir))
    write_results({"stock_summary": summary}, path, "run", "json")
    documents = spark.read.schema(summary.schema).json(f"{path}/stock_summary/run_id=run")
    return rounded_summary(documents)


@query
def batch_layer_breadth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch layer over an archive; its breadth."""
    archive, target = run_dir(spark, "archive"), run_dir(spark, "results")
    write_archive(event_bars(spark, sf_dir), archive, spread=True)
    run_batch_layer(spark, archive, target, "run")
    return read_result(spark, target, "market_breadth", "run")


def layer_result(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One result of the batch layer over an archive of bars that were sent again."""
    archive, target = run_dir(spark, "archive"), run_dir(spark, "results")
    write_archive(resent_bars(spark, sf_dir), archive, spread=True)
    run_batch_layer(spark, archive, target, "run")
    return read_result(spark, target, name, "run")


@query
def batch_layer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layer's summary, of every revision."""
    return rounded_summary(layer_result(spark, sf_dir, "stock_summary"))


@query
def batch_layer_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layer's return series, of settled bars."""
    return zoneless(layer_result(spark, sf_dir, "return_series"))


@query
def batch_layer_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layer's daily prices, of settled bars."""
    return layer_result(spark, sf_dir, "daily_prices")


@query
def batch_layer_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layer's dead letters by reason, over texts some of which are broken."""
    archive, target = run_dir(spark, "archive"), run_dir(spark, "results")
    tick_messages(spark, sf_dir).select("value").write.text(archive)
    run_batch_layer(spark, archive, target, "run")
    rejects = read_result(spark, target, "rejects", "run")
    return rejects.groupBy("reject_reason").agg(F.count("value").alias("texts"))


@query
def batch_layer_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch layer over a compacted archive; its breadth."""
    archive, small, target = (run_dir(spark, name) for name in ("archive", "compacted", "results"))
    write_archive(event_bars(spark, sf_dir).withColumn("ingest_ts", F.col("date")), archive, spread=True)
    compact_archive(spark, archive, small)
    run_batch_layer(spark, small, target, "run", compacted=True)
    return read_result(spark, target, "market_breadth", "run")


# -- order ---------------------------------------------------------------------


@query
def sorted_bars_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All bars in presentation order."""
    return sorted_bars(event_bars(spark, sf_dir))


@query
def sorted_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 rows a preview shows."""
    return preview(event_bars(spark, sf_dir))


# -- streams -------------------------------------------------------------------


@query
def topic_replay_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything in the topic, as text."""
    path = message_folder(spark, to_messages(event_bars(spark, sf_dir)))
    return message_file_replay(spark, path).select("key", "value")


@query
def stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages streamed, decoded, appended to files."""
    path = message_folder(spark, to_messages(event_bars(spark, sf_dir)))
    target = run_dir(spark, "decoded")
    stream = accepted(decode_bars(message_file_stream(spark, path)))
    start_files(stream, f"{target}/bars", f"{target}/checkpoint").awaitTermination()
    return zoneless(spark.read.schema(BAR_SCHEMA).parquet(f"{target}/bars"))


@query
def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The speed layer over damaged messages: every row of its three sinks."""
    damaged = tick_messages(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("key"), "value"
    )
    target = run_dir(spark, "live")
    stream = message_file_stream(spark, message_folder(spark, damaged))
    run_speed_layer(stream, target).awaitTermination()
    lines = spark.read.text(f"{target}/points").select(
        F.lit("points").alias("sink"), F.col("value").alias("text")
    )
    stored_bars = accepted(scan_archive(spark, f"{target}/archive")).select(
        F.lit("archive").alias("sink"), F.concat_ws("|", "stock", iso_utc("date"), "close").alias("text")
    )
    refused = spark.read.parquet(f"{target}/rejects").select(
        F.lit("rejects").alias("sink"), F.col("reject_reason").alias("text")
    )
    return lines.unionByName(stored_bars).unionByName(refused)


@query
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the batches of the speed layer acknowledged, summed up."""
    damaged = tick_messages(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("key"), "value"
    )
    stream = message_file_stream(spark, message_folder(spark, damaged))
    target = run_dir(spark, "live")
    run_speed_layer(stream, target).awaitTermination()
    progress = spark.read.parquet(f"{target}/progress")
    return progress.agg(*(F.sum(name).alias(name) for name in ("rows_read", "rows_rejected")))


@query
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three revisions of every bar, a micro-batch each: the points hold the last."""
    once = event_bars(spark, sf_dir)
    target = run_dir(spark, "points")
    deliver = fan_out(lambda batch, i: write_point_table(batch, f"{target}/points", i, run=run_of(batch)))
    for off in (2.0, 1.0, 0.0):
        revised = once.withColumn("close", F.col("close") + off)
        write_message_files(to_messages(revised), f"{target}/topic")
        stream = accepted(decode_bars(message_file_stream(spark, f"{target}/topic")))
        start_batches(stream, deliver, f"{target}/checkpoint").awaitTermination()
    return zoneless(read_points(spark, f"{target}/points"), "time")


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed bars streamed; the newest of each listed symbol published, read back."""
    target = run_dir(spark, "ingest")
    landed = stored(typed_bars(event_bars(spark, sf_dir)), f"{target}/landed")
    stream = spark.readStream.schema(landed.schema).parquet(f"{target}/landed")
    symbols = explode_universe(watch_lists(spark, sf_dir), "symbols")
    deliver = publish_to_files(f"{target}/topic")
    run_ingest(stream, symbols, deliver, f"{target}/checkpoint", None).awaitTermination()
    sent = decode_bars(spark.read.schema(MESSAGE_SCHEMA).parquet(f"{target}/topic"))
    return zoneless(latest_bar(accepted(sent)))


# -- groups of stocks ----------------------------------------------------------


@query
def cluster_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature vectors, laid out as columns."""
    vectors = assemble_features(stock_summary(event_bars(spark, sf_dir)))
    parts = vectors.withColumn("features", vector_to_array("features"))
    return parts.select(
        "stock",
        *[
            F.round(F.col("features")[i], MEAN_DECIMALS).alias(name)
            for i, name in enumerate(AVERAGE_FIELDS)
        ],
    )


@query
def cluster_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stocks labelled, groups used, and stocks that another group's centre is nearer to."""
    summary = stock_summary(event_bars(spark, sf_dir))
    groups = cluster_stocks(summary)
    apart = F.array(*(
        sum((F.col(name) - F.lit(x)) ** 2 for name, x in zip(AVERAGE_FIELDS, centre))
        for centre in groups.centres
    ))
    placed = groups.labels.join(summary, "stock").withColumn("apart", apart)
    astray = F.col("apart")[F.col("prediction")] > F.array_min("apart") * (1 + 1e-9)
    return placed.agg(
        F.count("*").alias("stocks"),
        F.count_distinct("prediction").alias("groups"),
        F.count_if(astray).alias("astray"),
    )


@query
def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stocks in three groups by k-means."""
    return cluster_stocks(stock_summary(event_bars(spark, sf_dir))).labels
