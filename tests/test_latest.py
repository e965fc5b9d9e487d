import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.operators import latest
from tickloom.operators.latest import (
    explode_universe,
    in_universe,
    latest_bar,
    latest_in_universe,
    lookback,
    newest_instant,
    parse_universe,
    time_range,
)
from tickloom.operators.order import preview, sorted_bars
from tests.support import make_bars

ROWS = [(s, f"2024-01-0{d}T10:00:00", float(d)) for s in ("A", "B", "C") for d in (1, 3, 2)]


def test_latest_bar_of_each_stock(spark):
    got = latest_bar(make_bars(spark, ROWS).repartition(4)).collect()
    assert sorted((r.stock, r.close) for r in got) == [("A", 3.0), ("B", 3.0), ("C", 3.0)]


def test_latest_needs_no_sort(spark):
    plan = latest_bar(make_bars(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and plan.count("Exchange") == 1


def test_universe_text(spark):
    assert parse_universe("A,B") == ["A", "B"]
    for nothing in (None, ""):
        with pytest.raises(ValueError):
            parse_universe(nothing)
    lists = spark.createDataFrame([("A,B",), ("B,X",), ("",), (None,)], "symbols string")
    assert sorted(r.stock for r in explode_universe(lists, "symbols").collect()) == ["A", "B", "X"]


def test_universe_as_list_frame_and_long_list_agree(spark, monkeypatch):
    bars = make_bars(spark, ROWS)
    symbols = ["A", "C", "X"]
    frame = spark.createDataFrame([(s,) for s in symbols], "stock string")
    want = sorted(latest_in_universe(bars, symbols).collect())
    assert [r.stock for r in want] == ["A", "C"]
    assert sorted(latest_in_universe(bars, frame).collect()) == want
    monkeypatch.setattr(latest, "LITERAL_SYMBOLS", 1)
    assert sorted(latest_in_universe(bars, symbols).collect()) == want


def test_a_universe_frame_is_joined_after_the_aggregate(spark):
    symbols = spark.range(1000).selectExpr("concat('A', id % 7) as stock")
    joined = latest_in_universe(make_bars(spark, ROWS), symbols)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    join, bars = plan.index("Join Inner"), plan.index("max_by")
    assert join < bars and "LeftSemi" not in plan


def test_a_short_universe_reaches_the_scan(spark, tmp_path):
    make_bars(spark, ROWS).write.parquet(str(tmp_path / "bars"))
    kept = in_universe(spark.read.parquet(str(tmp_path / "bars")), ["A", "B"])
    assert "PushedFilters: [In(stock, [A,B])]" in kept._jdf.queryExecution().executedPlan().toString()


def test_lookback_is_half_open(spark):
    bars = make_bars(spark, ROWS)
    as_of = F.lit(dt.datetime(2024, 1, 3, 10))
    assert {r.close for r in lookback(bars, as_of).collect()} == {2.0}
    assert {r.close for r in lookback(bars, as_of, "2 days").collect()} == {1.0, 2.0}


def test_newest_instant_and_open_end(spark):
    bars = make_bars(spark, ROWS)
    start = newest_instant(bars, back="1 day")
    assert {r.close for r in time_range(bars, start).collect()} == {2.0, 3.0}


def test_ranges_prune_day_folders(spark, tmp_path):
    path = str(tmp_path / "bars")
    filed = make_bars(spark, ROWS).withColumn("day", F.to_date("date"))
    filed.write.partitionBy("day").parquet(path)
    kept = lookback(spark.read.parquet(path), F.lit(dt.datetime(2024, 1, 3, 10)), "1 hour")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    (pruning,) = [line for line in plan.splitlines() if "PartitionFilters: [isnotnull(day" in line]
    assert "(day#" in pruning and ">= 2024-01-03" in pruning
    assert kept.count() == 0


def test_preview_is_a_top_k(spark):
    bars = make_bars(spark, ROWS)
    first = preview(bars, 4)
    assert "TakeOrderedAndProject" in first._jdf.queryExecution().executedPlan().toString()
    assert [(r.stock, r.close) for r in first.collect()] == [("A", 1.0), ("A", 2.0), ("A", 3.0), ("B", 1.0)]
    assert [r.stock for r in sorted_bars(bars).collect()] == list("AAABBBCCC")
