"""Run a layer as a job: ``spark-submit ... -m tickloom`` or ``python -m tickloom``.

Master, memory and connector packages come from the submit command or its defaults
file. The access token of a point endpoint is read from ``POINTS_TOKEN``.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from tickloom.operators.decode import accepted, decode_bars
from tickloom.operators.latest import parse_universe
from tickloom.plans.batch_layer import run_batch_layer
from tickloom.plans.ingest import publish_to_topic, run_ingest
from tickloom.plans.speed_layer import run_speed_layer, send_lines
from tickloom.schema import BAR_SCHEMA, TopicOptions
from tickloom.session import cluster_settings, pin_runtime
from tickloom.sinks.archive import compact_archive
from tickloom.sinks.console import console_stream, show_each
from tickloom.sinks.points import http_send, line_sink
from tickloom.sinks.results import append_documents, read_result
from tickloom.sources.archive import raw_dump
from tickloom.sources.topic import topic_replay, topic_stream
from tickloom.streaming.live import POLL_EVERY, ProgressLog


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tickloom", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str, *required: str, topic: bool = False) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=text)
        for option in (*required, *(("brokers", "topic") if topic else ())):
            sub.add_argument(f"--{option}", required=True)
        sub.add_argument("--input-gb", type=float, default=0.0, help="size of the input")
        sub.add_argument("--cores", type=int, help="executor cores; the context's own without")
        return sub

    batch = job("batch", "analyse an archive", "archive", "target", "run-id")
    batch.add_argument("--whole-files", action="store_true", help="one record per file")
    batch.add_argument("--compacted", action="store_true", help="what the compact job wrote")
    batch.add_argument("--groups", type=int, default=3)
    batch.add_argument("--documents", help="also append results as documents in this format")
    batch.add_argument("--documents-to", default="", help="where to: path or connection")
    live = job("live", "topic to points, archive and dead letters", "target", topic=True)
    live.add_argument("--every", default=POLL_EVERY)
    live.add_argument("--max-offsets", type=int, default=TopicOptions.max_offsets_per_trigger)
    live.add_argument("--points-url", help="also send lines to this endpoint")
    live.add_argument("--points-org", default="")
    live.add_argument("--points-bucket", default="")
    ingest = job("ingest", "landed bars to topic", "landed", "symbols", "checkpoint", topic=True)
    ingest.add_argument("--lookback", default="1 day", help="how old a bar may be to be news")
    ingest.add_argument("--max-files", type=int, default=1000, help="landed files per batch")
    job("compact", "archive to Parquet", "archive", "target")
    dump = job("dump", "archived records as text with their files", "archive", "target")
    dump.add_argument("--whole-files", action="store_true")
    tail = job("tail", "print what a topic holds", topic=True)
    tail.add_argument("--follow", metavar="CHECKPOINT", help="go on printing what arrives")
    return parser.parse_args(argv)


def sized(spark: SparkSession, args: argparse.Namespace) -> SparkSession:
    """Set what :func:`cluster_settings` gives for the stated input and cores."""
    cores = args.cores or spark.sparkContext.defaultParallelism
    for name, value in cluster_settings(int(args.input_gb * (1 << 30)), cores).items():
        spark.conf.set(name, value)
    return spark


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    sized(spark, args)
    if args.job == "batch":
        run_batch_layer(
            spark,
            args.archive,
            args.target,
            args.run_id,
            args.whole_files,
            args.groups,
            compacted=args.compacted,
        )
        names = ("stock_summary", "return_series", "market_breadth", "clusters")
        results = {n: read_result(spark, args.target, n, args.run_id) for n in names}
        if args.documents:
            for name, frame in results.items():
                append_documents(frame, args.documents, path=f"{args.documents_to}/{name}")
        show_each(**results)
    elif args.job == "live":
        spark.streams.addListener(ProgressLog(print))
        more = []
        if args.points_url:
            send = http_send(
                args.points_url, args.points_org, args.points_bucket, os.environ["POINTS_TOKEN"]
            )
            spark.dataSource.register(line_sink(send, "line_points"))
            more.append(send_lines("line_points"))
        options = TopicOptions(
            args.brokers, args.topic, max_offsets_per_trigger=args.max_offsets
        )
        messages = topic_stream(spark, options)
        run_speed_layer(messages, args.target, args.every, more).awaitTermination()
    elif args.job == "ingest":
        reader = spark.readStream.schema(BAR_SCHEMA).option("maxFilesPerTrigger", args.max_files)
        landed = reader.parquet(args.landed)
        deliver = publish_to_topic(TopicOptions(args.brokers, args.topic))
        symbols = parse_universe(args.symbols)
        query = run_ingest(landed, symbols, deliver, args.checkpoint, span=args.lookback)
        query.awaitTermination()
    elif args.job == "compact":
        compact_archive(spark, args.archive, args.target)
    elif args.job == "dump":
        records = raw_dump(spark, args.archive, args.whole_files).select("file_path", "value")
        records.write.mode("overwrite").json(args.target)
        show_each(records=records)
    elif args.job == "tail":
        messages = topic_replay(spark, TopicOptions(args.brokers, args.topic))
        show_each(messages=messages, bars=accepted(decode_bars(messages)))
        if args.follow:
            stream = topic_stream(spark, TopicOptions(args.brokers, args.topic))
            console_stream(stream, args.follow, POLL_EVERY).awaitTermination()


def main() -> None:
    args = arguments()
    spark = pin_runtime(SparkSession.builder.appName(f"tickloom-{args.job}").getOrCreate())
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
