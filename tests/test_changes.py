"""Data that comes late, twice, revised or in parts, and writes that break off."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.support import at, make_bars
from tickloom.operators.asof import as_of, poll_instants
from tickloom.operators.clean import distinct_bars
from tickloom.operators.decode import accepted, decode_bars
from tickloom.operators.encode import bar_lines, to_messages
from tickloom.operators.moments import day_moments, merged_summary, update_summary
from tickloom.operators.returns import bar_returns
from tickloom.operators.stats import stock_summary
from tickloom.plans.audit import audit_deliveries
from tickloom.plans.changes import appended, change_log, fails_once, none_late
from tickloom.plans.ingest import publish_to_files, run_ingest
from tickloom.plans.speed_layer import run_speed_layer
from tickloom.schema import BAR_FIELDS, BAR_SCHEMA, MESSAGE_SCHEMA
from tickloom.sinks import archive as archives
from tickloom.sinks.archive import clean_archive, compact_tail, scan_with_tail, write_archive
from tickloom.sinks.staged import published_lines, staged_sink
from tickloom.sources.folders import Manifest, batch_folders
from tickloom.sources.topic import message_file_replay, message_file_stream, message_file_tombstones
from tickloom.streaming.index import pass_once
from tickloom.streaming.keyed import rocksdb_state, rolling_returns, superseding_bars
from tickloom.streaming.live import distinct_stream, start_batches, start_files


def finish(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def minute(k, day=1):
    return (dt.datetime(2024, 1, day) + dt.timedelta(minutes=k)).isoformat()


def days_of_bars(spark, days, stocks=("A", "B"), per_day=5):
    return make_bars(spark, [(s, minute(7 * k, d), float(d * 100 + k)) for d in days for s in stocks for k in range(per_day)])


# -- revisions -----------------------------------------------------------------

VERSION = "stock string, date timestamp, close double, ingest_ts timestamp, offset bigint, arrival timestamp"


def versions(spark, rows, arrived):
    made = [(s, at(minute(d)), c, at(minute(i, 2)), o, at(arrived)) for s, d, c, i, o in rows]
    return spark.createDataFrame(made, VERSION)


def test_bars_are_sent_again_only_when_superseded_and_state_goes(spark, tmp_path):
    topic, target = str(tmp_path / "topic"), str(tmp_path)
    batches = [
        ([("A", 0, 1.0, 10, 0), ("A", 0, 2.0, 12, 0), ("A", 0, 1.5, 11, 0), ("B", 0, 9.0, 5, 1), (None, 3, 4.0, 1, 0)], "2024-02-01T00:00:00"),
        ([("A", 0, 1.7, 11, 9), ("A", 0, 2.0, 12, 0), ("B", 0, 8.0, 5, 2), ("A", 1, 5.0, 1, 0)], "2024-02-01T06:00:00"),
        ([("A", 0, 3.0, 13, 0), ("B", 0, 8.5, 5, 0)], "2024-02-01T20:00:00"),
        ([("Z", 0, 0.0, 1, 0)], "2024-02-09T00:00:00"),
        ([("A", 0, 2.5, 12, 5)], "2024-02-09T01:00:00"),  # forgotten by now: sent, to be settled by order
    ]
    sent, kept = [], []
    for rows, arrived in batches:
        stream = appended(versions(spark, rows, arrived).repartition(3), topic)
        with rocksdb_state(spark):
            query = none_late(start_batches(superseding_bars(stream, "1 day"), change_log(f"{target}/sent"), f"{target}/checkpoint"))
    log = spark.read.parquet(f"{target}/sent")
    numbers = sorted({r.batch_id for r in log.collect()})
    sent = [sorted((r.stock or "", r.close) for r in log.where(F.col("batch_id") == n).collect()) for n in numbers]
    assert sent == [
        [("", 4.0), ("A", 2.0), ("B", 9.0)],
        [("A", 5.0), ("B", 8.0)],
        [("A", 3.0)],
        [("Z", 0.0)],
        [("A", 2.5)],
    ]


def state_rows(query):
    return query.recentProgress[-1].stateOperators[0].numRowsTotal


def test_state_of_revisions_shrinks_when_their_day_is_past(spark, tmp_path):
    topic, target = str(tmp_path / "topic"), str(tmp_path)
    sizes = []
    for k in range(5):
        rows = [(f"S{k}-{j}", 0, 1.0, 1, 0) for j in range(20)]
        stream = appended(versions(spark, rows, f"2024-02-{1 + 3 * k:02d}T00:00:00"), topic)
        with rocksdb_state(spark):
            query = finish(start_batches(superseding_bars(stream, "1 day"), change_log(f"{target}/sent"), f"{target}/checkpoint"))
        sizes.append(state_rows(query))
    assert spark.read.parquet(f"{target}/sent").count() == 100
    assert max(sizes) <= 2 * sizes[0] and sizes[-1] == sizes[1]


def test_stocks_of_a_day_share_entries_of_the_store_but_not_their_time(spark, tmp_path):
    topic, target = str(tmp_path / "topic"), str(tmp_path)
    batches = [
        ([(f"S{j}", j % 3, 1.0, 5, j) for j in range(200)] + [(None, 0, 1.0, 5, 0)], "2024-02-01T00:00:00"),
        ([("S1", 1, 2.0, 4, 0), ("S1", 1, 3.0, 6, 0), ("S2", 2, 0.0, 5, 2)], "2024-02-01T20:00:00"),
        ([("Z", 0, 0.0, 1, 0)], "2024-02-03T12:00:00"),  # takes the time of all but S1, S2 and itself
        ([("S1", 1, 4.0, 6, 0), ("S3", 0, 5.0, 1, 0), ("S2", 2, 6.0, 5, 1), (None, 0, 7.0, 1, 0)], "2024-02-03T13:00:00"),
    ]
    sizes = []
    for rows, arrived in batches:
        stream = appended(versions(spark, rows, arrived).repartition(3), topic)
        with rocksdb_state(spark):
            found = superseding_bars(stream, "1 day", places=1)
            sizes.append(state_rows(finish(start_batches(found, change_log(f"{target}/sent"), f"{target}/checkpoint"))))
    log = spark.read.parquet(f"{target}/sent").orderBy("batch_id").collect()
    assert max(sizes) <= 6  # an entry and its timers, not one for every stock
    assert len(log) == 201 + 1 + 1 + 2
    assert [(r.stock, r.close) for r in log[201:203]] == [("S1", 3.0), ("Z", 0.0)]
    assert {(r.stock, r.close) for r in log[203:]} == {("S3", 5.0), (None, 7.0)}


# -- returns over micro-batches ------------------------------------------------


def rolled(spark, folder, batches, n, lateness):
    topic, target = f"{folder}/topic", str(folder)
    for rows in batches:
        frame = make_bars(spark, [r[:3] for r in rows]).withColumn("ingest_ts", F.lit(at("2024-05-01")))
        if any(len(r) > 3 for r in rows):
            late = spark.createDataFrame([(r[0], at(r[1]), at(r[3])) for r in rows if len(r) > 3], "stock string, date timestamp, later timestamp")
            frame = frame.withColumn("row", F.monotonically_increasing_id()).join(late, ["stock", "date"], "left")
            frame = frame.withColumn("ingest_ts", F.when(F.col("close") < 0, F.col("later")).otherwise(F.col("ingest_ts"))).drop("row", "later")
        stream = appended(frame.repartition(3), topic)
        with rocksdb_state(spark):
            query = start_batches(rolling_returns(stream, n, lateness), change_log(f"{target}/told"), f"{target}/checkpoint")
        finish(query)
    return spark.read.parquet(f"{target}/told")


def last_told(log):
    rows = {}
    for r in sorted(log.collect(), key=lambda r: r.batch_id):
        rows[r.stock, r.date] = (r.close, r.prev_day_close, r.daily_return, r.moving_avg, r.late)
    return rows


def test_late_and_revised_bars_repair_the_rows_after_them(spark, tmp_path):
    source = random.Random(3)
    bars = [(s, minute(9 * k), None if k % 11 == 5 else float(source.randrange(1, 99))) for s in "ABC" for k in range(40)]
    source.shuffle(bars)
    bars.sort(key=lambda b: at(b[1]) + dt.timedelta(minutes=source.randrange(60)))
    cuts = [bars[k::1][: 24] for k in range(0, 120, 24)]
    revised = [(s, d, 500.0) for s, d, _ in cuts[3][:5]]
    got = last_told(rolled(spark, tmp_path, [*cuts, revised], 5, "3 hours"))
    final = {(s, d): c for s, d, c in bars} | {(s, d): c for s, d, c in revised}
    want = bar_returns(make_bars(spark, [(s, d, c) for (s, d), c in final.items()]), 5, average_name="moving_avg").collect()
    assert len(got) == len(want) == 120
    for r in want:
        close, previous, change, average, late = got[r.stock, r.date]
        assert (close, previous, late) == (r.close, r.prev_day_close, False)
        assert change == (pytest.approx(r.daily_return) if r.daily_return is not None else None)
        assert average == (pytest.approx(r.moving_avg) if r.moving_avg is not None else None)


def test_bars_beyond_the_lateness_are_told_as_late_and_change_nothing(spark, tmp_path):
    first = [("A", minute(10 * k), float(k)) for k in range(30)]
    batches = [first, [("A", minute(5), 77.0), ("A", minute(285), 100.0)], [("A", minute(300), 30.0), ("B", minute(0), 0.0)]]
    got = last_told(rolled(spark, tmp_path, batches, 3, "1 hour"))
    assert got["A", at(minute(5))] == (77.0, None, None, None, True)
    assert got["A", at(minute(10))][3] == 0.5 and got["A", at(minute(10))][4] is False
    assert got["A", at(minute(285))][:2] == (100.0, 28.0)
    assert got["A", at(minute(290))][1:4:2] == (100.0, (28 + 100 + 29) / 3)
    assert got["A", at(minute(300))][1] == 29.0
    assert got["B", at(minute(0))] == (0.0, None, None, 0.0, False)


# -- copies --------------------------------------------------------------------


def test_copies_weeks_apart_pass_once_over_any_batches(spark, tmp_path):
    topic, seen = str(tmp_path / "topic"), str(tmp_path / "seen")
    days = [days_of_bars(spark, [d]) for d in (1, 9, 25)]
    odd = spark.createDataFrame([("N", None, None, 1.0, None, None, None)] * 2, BAR_SCHEMA)
    for part in range(3):
        rows = odd.unionByName(odd)
        for d in days[: part + 1]:
            rows = rows.unionByName(d).unionByName(d)
        rows.repartition(8).write.mode("append").parquet(topic)
        stream = spark.readStream.schema(BAR_SCHEMA).option("maxFilesPerTrigger", 2).parquet(topic)
        finish(start_batches(stream, pass_once(seen), str(tmp_path / "checkpoint")))
    got = spark.read.parquet(f"{seen}/rows").select(*BAR_FIELDS)
    want = days[0].unionByName(days[1]).unionByName(days[2]).unionByName(odd.limit(1))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_batch_that_breaks_off_before_its_index_is_whole_when_repeated(spark, tmp_path, monkeypatch):
    from tickloom.streaming import index

    topic, seen = str(tmp_path / "topic"), str(tmp_path / "seen")
    stream = appended(days_of_bars(spark, [1, 2]), topic)
    real = index.replace_partitions

    def broken(rows, path, *rest):
        if path.endswith("/index"):
            raise RuntimeError("lost")
        real(rows, path, *rest)

    monkeypatch.setattr(index, "replace_partitions", broken)
    with pytest.raises(StreamingQueryException):
        start_batches(stream, pass_once(seen), str(tmp_path / "checkpoint")).awaitTermination()
    monkeypatch.setattr(index, "replace_partitions", real)
    for _ in range(2):
        finish(start_batches(appended(days_of_bars(spark, [1]), topic), pass_once(seen), str(tmp_path / "checkpoint")))
    assert spark.read.parquet(f"{seen}/rows").count() == 20
    assert spark.read.parquet(f"{seen}/index").count() == 20


def test_only_the_index_of_a_batchs_days_is_read(spark, tmp_path):
    topic, seen = str(tmp_path / "topic"), str(tmp_path / "seen")
    for part in ([1, 2, 3], [2]):
        finish(start_batches(appended(days_of_bars(spark, part), topic), pass_once(seen), str(tmp_path / "checkpoint")))
    index = spark.read.parquet(f"{seen}/index").where(F.col("day").isin([dt.date(2024, 1, 2)]))
    assert "PartitionFilters: [isnotnull(day" in index._jdf.queryExecution().toString() or "day#" in index._jdf.queryExecution().toString()
    assert spark.read.parquet(f"{seen}/rows").count() == 30


def test_a_range_split_over_many_batches_loses_rows_and_says_so(spark, tmp_path):
    topic, target = str(tmp_path / "topic"), str(tmp_path)
    rows = days_of_bars(spark, range(1, 9)).withColumn("offset", F.monotonically_increasing_id())
    for day in (8, 7, 1):  # out of order, beyond the delay; a watermark holds from the next but one batch on
        rows.where(F.dayofmonth("date") == day).coalesce(1).write.mode("append").parquet(topic)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(topic)
    with pytest.raises(AssertionError, match="behind the watermark"):
        none_late(start_files(distinct_stream(stream, "2 hours"), f"{target}/bars", f"{target}/checkpoint"))


# -- compaction ----------------------------------------------------------------


def ingested(bars):
    return bars.withColumn("ingest_ts", F.col("date"))


def bars_now(spark, archive, store, days=None):
    found = accepted(scan_with_tail(spark, archive, store, days))
    return sorted(distinct_bars(found).collect())


def test_compaction_takes_in_what_is_new_and_leaves_other_days_unread(spark, tmp_path, monkeypatch):
    archive, store = str(tmp_path / "archive"), str(tmp_path / "store")
    everything = sorted(days_of_bars(spark, [1, 2, 3]).collect())
    assert compact_tail(spark, archive, store) == Manifest()  # no archive yet
    write_archive(ingested(days_of_bars(spark, [1, 2])), archive, 0, run="r")
    assert bars_now(spark, archive, store) == sorted(days_of_bars(spark, [1, 2]).collect())
    first = compact_tail(spark, archive, store)
    assert sorted(first.days) == ["2024-01-01", "2024-01-02"]
    assert compact_tail(spark, archive, store) == first  # nothing new
    write_archive(ingested(days_of_bars(spark, [2, 3])), archive, 1, run="r")  # copies of day 2
    assert bars_now(spark, archive, store) == everything
    read = []
    scan = archives.scan_archive

    def watched(spark, path, **kept):
        read.extend(kept["folders"])
        return scan(spark, path, **kept)

    monkeypatch.setattr(archives, "scan_archive", watched)
    second = compact_tail(spark, archive, store)
    assert read and not any("2024-01-01" in name for name in read)
    monkeypatch.undo()
    assert second.days["2024-01-01"] == first.days["2024-01-01"] and second.days["2024-01-02"] != first.days["2024-01-02"]
    assert sorted(accepted(scan_with_tail(spark, archive, store)).collect()) == everything  # each once
    clean_archive(spark, archive, store)
    assert batch_folders(spark, archive) == {}
    write_archive(ingested(days_of_bars(spark, [4])), archive, 2, run="r")
    assert bars_now(spark, archive, store) == sorted(days_of_bars(spark, [1, 2, 3, 4]).collect())
    assert bars_now(spark, archive, store, ["2024-01-02", "2024-01-04"]) == sorted(days_of_bars(spark, [2, 4]).collect())
    compact_tail(spark, archive, store)
    clean_archive(spark, archive, store)
    assert sorted(accepted(scan_with_tail(spark, archive, store)).collect()) == sorted(days_of_bars(spark, [1, 2, 3, 4]).collect())


def test_a_broken_compaction_leaves_nothing_and_a_second_one_is_refused(spark, tmp_path, monkeypatch):
    archive, store = str(tmp_path / "archive"), str(tmp_path / "store")
    write_archive(ingested(days_of_bars(spark, [1])), archive, 0, run="r")
    monkeypatch.setattr(archives.Manifest, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        compact_tail(spark, archive, store)
    monkeypatch.undo()
    assert Manifest.newest(spark, store) == Manifest()
    assert len(bars_now(spark, archive, store)) == 10
    done = compact_tail(spark, archive, store)
    with pytest.raises(RuntimeError, match="another run"):
        Manifest(done.version, {}, {}).publish(spark, store)
    assert Manifest.newest(spark, store) == done
    assert len(accepted(scan_with_tail(spark, archive, store)).collect()) == 10


def test_batches_of_dead_letters_only_are_taken_in_without_data(spark, tmp_path):
    archive, store = str(tmp_path / "archive"), str(tmp_path / "store")
    write_archive(ingested(days_of_bars(spark, [1])), archive, 0, run="r")
    bad = spark.createDataFrame([("{bad",)], "value string")
    bad.write.text(f"{archive}/day=2024-01-07/run=r/batch_id=1")
    done = compact_tail(spark, archive, store)
    assert sorted(done.days) == ["2024-01-01"] and "2024-01-07" in done.taken
    assert compact_tail(spark, archive, store) == done


# -- incremental summary -------------------------------------------------------


def as_rows(summary):
    return {r["stock"]: tuple(r)[1:] for r in summary.collect()}


def test_merged_moments_equal_the_summary_far_from_zero(spark):
    source = np.random.default_rng(1)
    rows = [(f"S{k % 3}", minute(k, 1 + k % 20), float(1e9 + source.normal())) for k in range(600)]
    rows += [("one", minute(0), 5.0), ("none", minute(0), None), ("some", minute(0), None), ("some", minute(0, 3), 2.0), ("some", minute(0, 4), 4.0)]
    bars = make_bars(spark, rows)
    want, got = as_rows(stock_summary(bars)), as_rows(merged_summary(day_moments(bars)))
    assert set(want) == set(got)
    for stock, values in want.items():
        for a, b in zip(values, got[stock]):
            # Both are right to what doubles can tell apart a thousand million from zero.
            assert (a is None and b is None) or a == pytest.approx(b, rel=1e-7)
    far = [c for s, _, c in rows if s == "S1"]
    assert got["S1"][5] == pytest.approx(np.std(np.array(far) - 1e9, ddof=1), rel=1e-7)
    assert merged_summary(day_moments(bars.limit(0))).count() == 0


def test_a_summary_run_reads_changed_days_only(spark, tmp_path, monkeypatch):
    from tickloom.operators import moments

    archive, store, kept = (str(tmp_path / name) for name in ("archive", "store", "kept"))
    assert update_summary(spark, archive, store, kept).count() == 0
    asked = []
    scan = moments.scan_with_tail
    monkeypatch.setattr(moments, "scan_with_tail", lambda s, a, t, days, m: asked.append(days) or scan(s, a, t, days, m))
    write_archive(ingested(days_of_bars(spark, [1, 2, 3])), archive, 0, run="r")
    update_summary(spark, archive, store, kept)
    write_archive(ingested(days_of_bars(spark, [3, 4], per_day=9)), archive, 1, run="r")
    got = update_summary(spark, archive, store, kept)
    want = distinct_bars(days_of_bars(spark, [1, 2]).unionByName(days_of_bars(spark, [3, 4], per_day=9)))
    assert asked == [["2024-01-01", "2024-01-02", "2024-01-03"], ["2024-01-03", "2024-01-04"]]
    for stock, values in as_rows(stock_summary(want)).items():
        assert as_rows(got)[stock] == pytest.approx(values)
    update_summary(spark, archive, store, kept)
    assert len(asked) == 2
    compact_tail(spark, archive, store)
    clean_archive(spark, archive, store)
    again = update_summary(spark, archive, store, kept)  # days moved, values stay
    assert as_rows(again) == as_rows(got)


# -- two-step writes -----------------------------------------------------------


def test_a_failed_task_withdraws_its_batch_and_the_next_try_publishes_it(spark, tmp_path):
    landed, target = str(tmp_path / "landed"), str(tmp_path / "lines")
    lines = bar_lines(appended(days_of_bars(spark, [1, 2]).repartition(4), landed))
    spark.dataSource.register(staged_sink("staged_once", before_write=fails_once(str(tmp_path / "hook"))))

    def start():
        writer = lines.writeStream.format("staged_once").option("checkpointLocation", str(tmp_path / "checkpoint"))
        return writer.option("run", "r").trigger(availableNow=True).start(target)

    with pytest.raises(StreamingQueryException, match="fails once"):
        start().awaitTermination()
    finish(start())
    want = sorted(r.line for r in bar_lines(days_of_bars(spark, [1, 2])).collect())
    assert sorted(r.line for r in published_lines(spark, target).collect()) == want


def test_a_batch_published_again_replaces_its_first_try(spark, tmp_path):
    landed, target = str(tmp_path / "landed"), str(tmp_path / "lines")
    spark.dataSource.register(staged_sink("staged_again"))
    for attempt in range(2):  # another checkpoint numbers from 0 again, under the same run
        lines = bar_lines(appended(days_of_bars(spark, [1 + attempt]), landed))
        writer = lines.writeStream.format("staged_again").option("checkpointLocation", str(tmp_path / f"c{attempt}"))
        finish(writer.option("run", "r").trigger(availableNow=True).start(target))
    got = published_lines(spark, target)
    assert got.count() == 20 and got.select("batch").distinct().count() == 1
    bar_lines(days_of_bars(spark, [5])).write.format("staged_again").mode("append").save(target)
    assert published_lines(spark, target).count() == 30


# -- instants ------------------------------------------------------------------


@pytest.mark.parametrize("pieces", [1, 3, 17])
def test_polls_are_answered_by_the_newest_bar(spark, pieces):
    source = random.Random(pieces)
    rows = [("HOT", minute(k), float(k)) for k in range(0, 1400, 2)]
    rows += [(f"S{j}", minute(source.randrange(1400)), float(j)) for j in range(30)]
    bars = make_bars(spark, list({(s, d): (s, d, c) for s, d, c in rows}.values()))
    asked = [(s, at(minute(t))) for s in ("HOT", "S3", "S4", "S9", "none") for t in (0, 1, 2, 700, 700, 1399, 5000)]
    asked += [("HOT", at(minute(t))) for t in range(1, 1400, 9)]
    polls = spark.createDataFrame(asked, "stock string, polled_at timestamp")
    for span, oldest in ((None, dt.timedelta.max), ("100 minutes", dt.timedelta(minutes=100))):
        got = sorted((r.stock, r.polled_at, r.date, r.close) for r in as_of(bars, polls, pieces, span).collect())
        want = []
        for stock, instant in asked:
            known = [(b.date, b.close) for b in BARS_OF(bars, stock) if b.date <= instant]
            if known and instant - max(known)[0] <= oldest:
                want.append((stock, instant, *max(known)))
        assert got == sorted(want)


def BARS_OF(bars, stock, cache={}):
    if id(bars) not in cache:
        cache.clear()
        cache[id(bars)] = bars.collect()
    return [b for b in cache[id(bars)] if b.stock == stock]


def test_poll_instants_and_empty_sides(spark):
    bars = days_of_bars(spark, [1, 2])
    polls = poll_instants(bars, spark.createDataFrame([("A",), ("Q",)], "stock string"), "12 hours")
    assert polls.count() == 2 * 3
    assert as_of(bars, polls.limit(0)).count() == 0
    assert as_of(bars.limit(0), polls).count() == 0


# -- messages ------------------------------------------------------------------


def test_a_new_checkpoint_adds_to_what_an_earlier_run_published(spark, tmp_path):
    landed, topic = str(tmp_path / "landed"), str(tmp_path / "topic")
    for attempt, stocks in enumerate((["A", "B"], ["C"])):
        rows = days_of_bars(spark, [1], stocks).drop("ingest_ts")
        rows.write.parquet(f"{landed}/{attempt}")
        stream = spark.readStream.schema(BAR_SCHEMA).parquet(f"{landed}/{attempt}")
        finish(run_ingest(stream, stocks, publish_to_files(topic), str(tmp_path / f"c{attempt}"), None))
    sent = accepted(decode_bars(spark.read.schema(MESSAGE_SCHEMA).parquet(topic)))
    assert sorted(r.stock for r in sent.collect()) == ["A", "B", "C"]


def test_tombstones_are_counted_not_decoded(spark, tmp_path):
    path = str(tmp_path / "topic")
    bars = to_messages(days_of_bars(spark, [1]))
    bars.unionByName(spark.createDataFrame([("A", None), ("A", None), (None, None)], "key string, value string")).write.parquet(path)
    assert message_file_replay(spark, path).count() == 10
    assert sorted(str(r.key) for r in message_file_tombstones(spark, path).collect()) == ["A", "A", "None"]
    stream = accepted(decode_bars(message_file_stream(spark, path)))
    finish(start_files(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint")))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10


# -- audit ---------------------------------------------------------------------


def test_an_audit_is_empty_until_a_sink_loses_a_file_or_a_row_changes(spark, tmp_path):
    topic, target = str(tmp_path / "topic"), tmp_path / "live"
    for part in ([1, 2], [2, 3]):
        rows = to_messages(days_of_bars(spark, part))
        bad = spark.createDataFrame([("x", "{bad"), ("y", "")], "key string, value string")
        rows.unionByName(bad).write.mode("append").parquet(topic)
        finish(run_speed_layer(message_file_stream(spark, topic), str(target), audited=True))
    assert audit_deliveries(spark, str(target)).count() == 0
    (lost, *_) = sorted((target / "archive").rglob("batch_id=1/*.txt"))
    n = len(lost.read_text().splitlines())
    text = lost.read_text()
    lost.unlink()
    off = audit_deliveries(spark, str(target)).collect()
    assert [(r.batch_id, r.sink, r.rows_due - r.rows_held, r.contents) for r in off] == [(1, "archive", n, False)]
    lost.with_name("part-new.txt").write_text(text.replace('"stock":"', '"stock":"x'))
    (off,) = audit_deliveries(spark, str(target)).collect()
    assert (off.sink, off.rows_due, off.contents) == ("archive", off.rows_held, False)


def test_an_audit_of_a_run_without_rejects(spark, tmp_path):
    topic, target = str(tmp_path / "topic"), str(tmp_path / "live")
    to_messages(days_of_bars(spark, [1])).write.parquet(topic)
    finish(run_speed_layer(message_file_stream(spark, topic), target, audited=True))
    assert audit_deliveries(spark, target).count() == 0
