import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tickloom import session
from tickloom.operators.decode import accepted, rejected
from tickloom.plans.batch_layer import run_batch_layer
from tickloom.schema import BAR_FIELDS, TopicOptions, empty_bars
from tickloom.session import cluster_settings, run_dir, shared_dir
from tickloom.sinks.archive import compact_archive, write_archive
from tickloom.sinks.messages import publish
from tickloom.sinks.points import http_send, line_sink, write_point_lines, write_point_table
from tickloom.sinks.results import append_documents, read_result, write_results
from tickloom.sources.archive import raw_dump, scan_archive
from tickloom.sources.points import read_points, recent_points
from tickloom.sources.ticks import bars_from_ticks
from tickloom.sources.topic import topic_replay, topic_stream
from tests.support import at, make_bars

ROWS = [(s, f"2024-01-0{d}T{h}:00:00", float(d + h)) for s in "AB" for d in (1, 2) for h in (10, 11)]
GOOD = {"stock": "A", "date": "2024-01-02T09:30:00", "open": 1, "high": 2.0, "low": 0.5, "close": 1.5, "volume": 10.0}


def foreign_archive(path):
    """One record per file, as other writers leave it."""
    path.mkdir()
    texts = {"1": json.dumps(GOOD, indent=1), "2": json.dumps(GOOD), "3": "{bad", "4": json.dumps({"stock": "B"}),
             "5": json.dumps({**GOOD, "stock": "B", "close": 9.0})}
    for name, text in texts.items():
        (path / f"{name}.json").write_text(text)
    return str(path)


def test_one_record_per_file(spark, tmp_path):
    decoded = scan_archive(spark, foreign_archive(tmp_path / "in"), whole_files=True)
    assert sorted(r.close for r in accepted(decoded).collect()) == [1.5, 1.5, 9.0]
    refused = rejected(decoded, "value", "file_path").collect()
    assert sorted((r.reject_reason, r.file_path[-6:]) for r in refused) == [("malformed", "3.json"), ("no date", "4.json")]
    assert accepted(decoded, "ingest_ts").where("ingest_ts is null").count() == 0


def test_whole_file_dump(spark, tmp_path):
    dump = raw_dump(spark, foreign_archive(tmp_path / "in"), whole_files=True)
    got = {r.file_path[-6:]: r.value for r in dump.collect()}
    assert len(got) == 5 and got["3.json"] == "{bad" and json.loads(got["1.json"]) == GOOD


def test_an_empty_folder_gives_typed_empty_results(spark, tmp_path):
    (tmp_path / "in").mkdir()
    groups = run_batch_layer(spark, str(tmp_path / "in"), str(tmp_path / "out"), "r1", whole_files=True)
    assert groups.labels.count() == 0 and groups.centres == []
    breadth = read_result(spark, str(tmp_path / "out"), "market_breadth", "r1")
    assert breadth.count() == 0 and breadth.columns[0] == "date_only"


def test_archive_is_filed_by_day_and_batch(spark, tmp_path):
    path = str(tmp_path / "archive")
    bars = make_bars(spark, ROWS)
    write_archive(bars, path, 7)
    folders = {str(p.relative_to(path).parent) for p in tmp_path.rglob("part-*")}
    assert folders == {f"day=2024-01-0{d}/run=manual/batch_id=7" for d in (1, 2)}
    assert sorted(accepted(scan_archive(spark, path)).collect()) == sorted(bars.collect())


def test_writes_without_a_number_add_and_new_runs_replace_nothing(spark, tmp_path):
    path, points = str(tmp_path / "archive"), str(tmp_path / "points")
    other = make_bars(spark, [("C", "2024-01-01T10:00:00", 9.0)])
    for bars in (make_bars(spark, ROWS), other):
        write_archive(bars, path)
        write_point_table(bars, points)
    write_archive(other, path, 0, run="query-1")
    write_archive(other, path, 0, run="query-2")
    write_archive(other, path, 0, run="query-2")
    assert accepted(scan_archive(spark, path)).count() == len(ROWS) + 3
    assert read_points(spark, points).count() == len(ROWS) + 1


def test_a_compacted_archive_is_read_as_such_only(spark, tmp_path):
    path, small = str(tmp_path / "archive"), str(tmp_path / "small")
    write_archive(make_bars(spark, ROWS), path)
    compact_archive(spark, path, small)
    back = scan_archive(spark, small, compacted=True)
    assert sorted(accepted(back).collect()) == sorted(make_bars(spark, ROWS).collect())
    with pytest.raises(Exception, match="scan it as compacted"):
        scan_archive(spark, small).collect()


@pytest.mark.parametrize("spread", [False, True])
def test_a_batch_written_again_replaces_itself_only(spark, tmp_path, spread):
    path = str(tmp_path / "archive")
    bars = make_bars(spark, ROWS)
    for batch_id in (0, 1, 1):
        write_archive(bars, path, batch_id, spread)
    assert scan_archive(spark, path).count() == 2 * len(ROWS)


def test_scan_since_a_day_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "archive")
    write_archive(make_bars(spark, ROWS), path)
    recent = scan_archive(spark, path, since=dt.date(2024, 1, 2))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert recent.count() == 4 and "PartitionFilters: [isnotnull(day" in plan


def test_compaction_drops_copies_and_keeps_revisions(spark, tmp_path):
    path, target = str(tmp_path / "archive"), str(tmp_path / "compact")
    bars = make_bars(spark, ROWS).withColumn("ingest_ts", F.lit(at("2024-02-01T00:00:00")))
    later = bars.where("stock = 'A'").withColumn("close", F.lit(0.5))
    write_archive(bars, path, 0)
    write_archive(bars.unionByName(later), path, 1)
    compact_archive(spark, path, target)
    compact_archive(spark, path, target)
    got = spark.read.parquet(target)
    assert got.count() == len(ROWS) + 4
    assert set(got.columns) == {*BAR_FIELDS, "ingest_ts", "day"}


def test_points_last_write_wins_per_second(spark, tmp_path):
    path = str(tmp_path / "points")
    write_point_table(make_bars(spark, [("A", "2024-01-01T10:00:00.200", 1.0), ("A", "2024-01-01T10:00:00.900", 2.0)]), path, 0)
    write_point_table(make_bars(spark, [("B", "2024-01-01T10:00:00", 3.0), ("A", "2024-01-01T10:00:01", 4.0)]), path, 1)
    write_point_table(make_bars(spark, [("B", "2024-01-01T10:00:00", 5.0)]), path, 2)
    got = read_points(spark, path)
    assert sorted((r.stock, r.close) for r in got.collect()) == [("A", 2.0), ("A", 4.0), ("B", 5.0)]
    assert got.columns == ["measurement", "stock", "time", "open", "high", "low", "close", "volume"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_of_revisions_in_a_batch_the_last_arrived_is_the_point(spark, tmp_path):
    bars = make_bars(spark, [("A", "2024-01-01T10:00:00", float(c)) for c in range(9)])
    bars = bars.withColumn("offset", -F.col("close"))
    write_point_table(bars.repartition(3), f"{tmp_path}/points", 0, ["offset"])
    write_point_lines(bars.repartition(3), f"{tmp_path}/lines", 0, ["offset"])
    assert [r.close for r in read_points(spark, f"{tmp_path}/points").collect()] == [0.0]
    assert " open=0.0," in spark.read.text(f"{tmp_path}/lines").first().value


def test_recent_points_prune_days(spark, tmp_path):
    path = str(tmp_path / "points")
    write_point_table(make_bars(spark, ROWS), path)
    got = recent_points(spark, path, F.lit(at("2024-01-02T12:00:00")), "1 hour")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.close for r in got.collect()) == [13.0, 13.0]
    assert "PushedFilters: [IsNotNull(time), GreaterThanOrEqual(time" in plan
    assert "PartitionFilters: [isnotnull(day" in plan


def test_point_lines_by_batch(spark, tmp_path):
    path = str(tmp_path / "lines")
    for _ in range(2):
        write_point_lines(make_bars(spark, ROWS), path, 3)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert len(lines) == len(set(lines)) == len(ROWS)


def collector(folder):
    def send(body: bytes) -> None:
        import uuid

        with open(f"{folder}/{uuid.uuid4().hex}", "wb") as file:
            file.write(body)

    return send


def test_line_sink_sends_requests_of_limited_size(spark, tmp_path):
    lines = spark.range(95).selectExpr("concat('m v=', id, '.0 ', id) as line").repartition(3)
    lines = lines.unionByName(spark.createDataFrame([(None,)], "line string"))
    spark.dataSource.register(line_sink(collector(tmp_path), "lines_to_files", 10))
    lines.write.format("lines_to_files").mode("append").save()
    bodies = [p.read_text().split("\n") for p in tmp_path.iterdir()]
    assert max(map(len, bodies)) == 10
    assert sorted(sum(bodies, [])) == sorted(f"m v={i}.0 {i}" for i in range(95))


def test_http_send_builds_a_second_precision_request(monkeypatch):
    seen = []

    class Answer:
        def close(self):
            pass

    def urlopen(request, timeout):
        seen.append(request)
        return Answer()

    monkeypatch.setattr("urllib.request.urlopen", urlopen)
    http_send("http://host:1/", "my org", "b", "secret")(b"m v=1.0 1")
    (request,) = seen
    assert request.full_url == "http://host:1/api/v2/write?org=my+org&bucket=b&precision=s"
    assert request.data == b"m v=1.0 1" and request.get_header("Authorization") == "Token secret"


def test_results_of_a_run_are_replaced_and_runs_kept_apart(spark, tmp_path):
    for run_id, n in (("r1", 3), ("r1", 2), ("r2", 5)):
        write_results({"numbers": spark.range(n)}, str(tmp_path), run_id, "json")
    assert read_result(spark, str(tmp_path), "numbers", "r1", "json").count() == 2
    assert read_result(spark, str(tmp_path), "numbers", "r2", "json").count() == 5


def test_documents_are_appended_through_any_format(spark, tmp_path):
    for _ in range(2):
        append_documents(spark.range(3), "json", path=str(tmp_path / "docs"))
    assert spark.read.json(str(tmp_path / "docs")).count() == 6


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_batch_layer_writes_every_result(spark, tmp_path, fmt):
    source, target = foreign_archive(tmp_path / "in"), str(tmp_path / "out")
    for _ in range(2):
        groups = run_batch_layer(spark, source, target, "r1", whole_files=True, fmt=fmt)
    count = {p.name: read_result(spark, target, p.name, "r1", fmt).count() for p in (tmp_path / "out").iterdir()}
    assert count == {"stock_summary": 2, "return_series": 2, "daily_prices": 2, "market_breadth": 1, "clusters": 2, "rejects": 2}
    assert len(groups.centres) == 2


def test_a_revised_bar_counts_in_the_summary_but_once_in_the_day(spark, tmp_path):
    path = str(tmp_path / "archive")
    for i, close in enumerate((1.0, 3.0)):
        bar = make_bars(spark, [("A", "2024-01-01T10:00:00", 2.0, 9.0, 0.0, close, 1.0)])
        write_archive(bar.withColumn("ingest_ts", F.lit(at(f"2024-02-0{i + 1}T00:00:00"))), path, i)
    run_batch_layer(spark, path, str(tmp_path / "out"), "r")
    assert read_result(spark, str(tmp_path / "out"), "stock_summary", "r").first().avg_close == 2.0
    day = read_result(spark, str(tmp_path / "out"), "daily_prices", "r").first()
    assert (day.daily_close, day.daily_change) == (3.0, 1)


def test_bars_from_ticks_of_any_table(spark):
    ticks = spark.createDataFrame(
        [("x", at(f"2024-01-01T10:0{i}:00"), float(v)) for i, v in enumerate([3, 9, 1, 4])] , "k string, t timestamp, v double")
    assert tuple(bars_from_ticks(ticks, "k", "t", "v").first()) == ("x", at("2024-01-01T10:00:00"), 3.0, 9.0, 1.0, 4.0, 4.0)
    assert bars_from_ticks(ticks, "k", "t", "v", "minute").count() == 4


def test_tied_ticks_with_a_tie_break(spark):
    when = at("2024-01-01T10:00:00")
    ticks = spark.createDataFrame([("x", when, float(v), v) for v in (2, 3, 1)], "k string, t timestamp, v double, n int")
    row = bars_from_ticks(ticks, "k", "t", "v", ties=["n"]).first()
    assert (row.open, row.close) == (1.0, 3.0)


def test_topic_batch_calls_pass_options(spark, tmp_path):
    """Without a broker: a missing connector must be reported, not passed over."""
    options = TopicOptions("host:1", "bars")
    with pytest.raises(Exception, match="[Kk]afka"):
        topic_replay(spark, options)
    with pytest.raises(Exception, match="[Kk]afka"):
        publish(spark.createDataFrame([("a", "b")], "key string, value string"), options)


class FakeReader:
    """Takes the calls of a reader and gives ready records."""

    def __init__(self, records):
        self.records, self.seen = records, {}

    def format(self, fmt):
        self.seen["format"] = fmt
        return self

    def options(self, **options):
        self.seen.update(options)
        return self

    def option(self, name, value):
        return self.options(**{name: value})

    def load(self):
        return self.records


def test_topic_readers_ask_for_the_right_offsets(spark):
    records = spark.createDataFrame(
        [(bytearray(b"A"), bytearray(b"{}"), at("2024-01-01T00:00:00"), 1)],
        "key binary, value binary, timestamp timestamp, offset long",
    )
    options = TopicOptions("h:1,h:2", "bars", extra=(("kafka.security.protocol", "SSL"),))
    session = FakeSession("local")
    session.read = session.readStream = FakeReader(records)
    assert topic_stream(session, options).first().value == "{}"
    common = {"format": "kafka", "kafka.bootstrap.servers": "h:1,h:2", "subscribe": "bars", "kafka.security.protocol": "SSL"}
    assert session.readStream.seen == {**common, "startingOffsets": "latest", "maxOffsetsPerTrigger": 50_000_000}
    session.read = FakeReader(records)
    assert topic_replay(session, options).count() == 1
    assert session.read.seen == {**common, "startingOffsets": "earliest", "endingOffsets": "latest"}


def test_empty_bars_are_typed(spark):
    assert dict(empty_bars(spark).dtypes) == {"stock": "string", "date": "timestamp", **dict.fromkeys(BAR_FIELDS[2:], "double")}


def test_shared_dir_is_the_named_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert run_dir(spark, "x") != run_dir(spark, "x")


class FakeSession:
    """Stands for a session without the checkpoint setting."""

    def __init__(self, master):
        self.settings = {"spark.master": master}
        self.conf = self
        self.sparkContext = self
        self.folder = None

    def get(self, name, default=None):
        return self.settings.get(name, default)

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_a_cluster_must_name_its_shared_folder():
    cluster = FakeSession("spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(cluster)
    cluster.folder = "hdfs://shared/folder"
    assert shared_dir(cluster) == "hdfs://shared/folder"


def test_a_local_session_gets_a_folder_once():
    local = FakeSession("local[2]")
    assert shared_dir(local) == shared_dir(local) == local.folder


def test_settings_grow_with_the_input():
    small, large = cluster_settings(1 << 30, 16), cluster_settings(100 << 40, 4000)
    assert small["spark.sql.shuffle.partitions"] == "16" and small.keys() == large.keys()
    assert large["spark.sql.shuffle.partitions"] == str((100 << 40) // (256 << 20))
    assert large["spark.sql.streaming.stateStore.providerClass"] == session.ROCKSDB_PROVIDER
