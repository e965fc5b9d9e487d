import json
import time

import pytest
from pyspark.sql import functions as F

from tickloom.operators.clean import union_bars
from tickloom.operators.decode import accepted, decode_bars
from tickloom.operators.encode import to_messages
from tickloom.plans.ingest import latest_messages, publish_to_files, run_ingest
from tickloom.plans.speed_layer import run_speed_layer
from tickloom.schema import BAR_SCHEMA
from tickloom.session import ROCKSDB_PROVIDER
from tickloom.sinks.archive import write_archive
from tickloom.sinks.messages import write_message_files
from tickloom.sources.archive import scan_archive
from tickloom.sources.topic import as_messages, message_file_replay, message_file_stream
from tickloom.streaming.live import ProgressLog, distinct_stream, fan_out, start_batches, start_files
from tests.support import at, make_bars

ROWS = [(f"S{i % 7}", f"2024-01-01T{10 + i % 5}:{i:02d}:00", float(i)) for i in range(40)]
BAD = [("x", "{bad"), ("y", '{"stock":"y"}'), ("z", "")]


def feed(spark, path, bars, bad=()):
    messages = to_messages(bars)
    if bad:
        messages = messages.unionByName(spark.createDataFrame(list(bad), "key string, value string"))
    write_message_files(messages, path)


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def texts(spark, path):
    return sorted(r.value for r in spark.read.text(path).collect())


def test_stream_gives_what_batch_gives(spark, tmp_path):
    path = str(tmp_path / "topic")
    feed(spark, path, make_bars(spark, ROWS).repartition(6), BAD)
    batch = accepted(decode_bars(message_file_replay(spark, path)))
    stream = accepted(decode_bars(message_file_stream(spark, path, files_per_batch=2)))
    finish(start_files(stream, str(tmp_path / "out"), str(tmp_path / "ckpt")))
    got = spark.read.schema(BAR_SCHEMA).parquet(str(tmp_path / "out"))
    assert sorted(got.collect()) == sorted(batch.collect()) == sorted(make_bars(spark, ROWS).collect())


def test_speed_layer_fills_three_sinks_and_goes_on_after_a_restart(spark, tmp_path):
    topic, target = str(tmp_path / "topic"), str(tmp_path / "live")
    feed(spark, topic, make_bars(spark, ROWS[:25]), BAD)
    finish(run_speed_layer(message_file_stream(spark, topic), target))
    feed(spark, topic, make_bars(spark, ROWS[25:]))
    finish(run_speed_layer(message_file_stream(spark, topic), target))
    assert len(texts(spark, f"{target}/points")) == len(ROWS)
    assert sorted(accepted(scan_archive(spark, f"{target}/archive")).collect()) == sorted(make_bars(spark, ROWS).collect())
    assert spark.read.parquet(f"{target}/rejects").count() == len(BAD)
    assert accepted(scan_archive(spark, f"{target}/archive"), "ingest_ts").where("ingest_ts is null").count() == 0


def test_speed_layer_keeps_revisions_in_the_archive_and_the_last_as_point(spark, tmp_path):
    topic, target = str(tmp_path / "topic"), str(tmp_path / "live")
    sent = make_bars(spark, [("A", "2024-01-01T10:00:00", float(c)) for c in (3, 1, 2)])
    feed(spark, topic, sent.coalesce(1))
    finish(run_speed_layer(message_file_stream(spark, topic), target))
    assert spark.read.text(f"{target}/archive").count() == 3
    (line,) = texts(spark, f"{target}/points")
    assert "close=2.0" in line


def test_a_batch_that_fails_between_sinks_is_repeated_without_doubling(spark, tmp_path):
    topic, path, marker = str(tmp_path / "topic"), str(tmp_path / "archive"), tmp_path / "failed"
    feed(spark, topic, make_bars(spark, ROWS))
    second = []

    def breaks_once(batch, batch_id):
        if not marker.exists():
            marker.write_text("x")
            raise RuntimeError("sink is down")
        second.append(batch.count())

    deliver = fan_out(lambda b, i: write_archive(b, path, i), breaks_once)
    stream = accepted(decode_bars(message_file_stream(spark, topic)))
    with pytest.raises(Exception, match="sink is down"):
        start_batches(stream, deliver, str(tmp_path / "ckpt")).awaitTermination()
    finish(start_batches(stream, deliver, str(tmp_path / "ckpt")))
    assert second == [len(ROWS)] and scan_archive(spark, path).count() == len(ROWS)


PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@pytest.fixture
def state_on_disk(spark):
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB_PROVIDER)
    yield
    spark.conf.set(PROVIDER, before)


def test_redeliveries_with_state_on_disk(spark, tmp_path, state_on_disk):
    test_redeliveries_are_let_through_once(spark, tmp_path, True)


@pytest.mark.parametrize("salted", [False, True])
def test_redeliveries_are_let_through_once(spark, tmp_path, salted):
    topic = str(tmp_path / "topic")
    bars = make_bars(spark, ROWS)
    hot = make_bars(spark, ROWS[:1] * 200)
    feed(spark, topic, union_bars(bars, hot).repartition(5))
    feed(spark, topic, bars)
    stream = accepted(decode_bars(message_file_stream(spark, topic, files_per_batch=3)), "offset")
    passed = distinct_stream(stream, "1 day", spread_by=F.col("offset") if salted else None)
    passed = passed.drop("offset")
    finish(start_files(passed, str(tmp_path / "out"), str(tmp_path / "ckpt")))
    got = spark.read.schema(BAR_SCHEMA).parquet(str(tmp_path / "out"))
    assert sorted(got.collect()) == sorted(bars.collect())


def test_progress_is_reported_per_batch(spark, tmp_path):
    seen = []
    listener = ProgressLog(seen.append)
    spark.streams.addListener(listener)
    try:
        feed(spark, str(tmp_path / "topic"), make_bars(spark, ROWS), BAD)
        finish(run_speed_layer(message_file_stream(spark, str(tmp_path / "topic")), str(tmp_path / "live")))
        until = time.time() + 20
        while time.time() < until and not any("ended" in line for line in seen):
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    batches = [json.loads(line) for line in seen if '"batch"' in line]
    first = [b for b in batches if b.get("batch") == 0][0]
    assert first["rows"] >= 43 and first["late"] == 0
    assert first["observed"]["batch"] == {"read": 43, "rejected": 3}


def test_a_polling_query_runs_until_stopped(spark, tmp_path):
    topic = str(tmp_path / "topic")
    feed(spark, topic, make_bars(spark, ROWS))
    seen = []
    query = start_batches(
        accepted(decode_bars(message_file_stream(spark, topic))),
        lambda batch, i: seen.append(batch.count()),
        str(tmp_path / "ckpt"),
        every="1 second",
        name="polling",
    )
    query.processAllAvailable()
    assert query.isActive and query.name == "polling"
    query.stop()
    assert sum(seen) == len(ROWS)


def test_ingest_publishes_the_newest_bar_of_listed_symbols(spark, tmp_path):
    landed, topic = str(tmp_path / "landed"), str(tmp_path / "topic")
    make_bars(spark, ROWS).write.parquet(landed)
    stream = spark.readStream.schema(BAR_SCHEMA).parquet(landed)
    finish(run_ingest(stream, ["S1", "S2", "none"], publish_to_files(topic), str(tmp_path / "ckpt"), None))
    sent = accepted(decode_bars(spark.read.schema("key string, value string").parquet(topic)))
    want = {s: max(r[1] for r in ROWS if r[0] == s) for s in ("S1", "S2")}
    assert {r.stock: r.date for r in sent.collect()} == {s: at(d) for s, d in want.items()}


def test_latest_messages_of_a_range(spark):
    got = latest_messages(make_bars(spark, ROWS), ["S1", "S2"], F.lit(at("2024-01-01T12:00:00")), "2 hours")
    want = {s: max(r[1] for r in ROWS if r[0] == s and r[1] < "2024-01-01T12") for s in ("S1", "S2")}
    assert {r.key: json.loads(r.value)["date"] for r in got.collect()} == {s: f"{d}Z" for s, d in want.items()}


def test_topic_records_become_messages(spark):
    records = spark.createDataFrame(
        [(bytearray(b"A"), bytearray(b"{}"), at("2024-01-01T00:00:00"), 5), (bytearray(b"A"), None, None, 6)],
        "key binary, value binary, timestamp timestamp, offset long",
    )
    assert [tuple(r) for r in as_messages(records).collect()] == [("A", "{}", at("2024-01-01T00:00:00"), 5)]
