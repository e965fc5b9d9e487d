"""The seamed windows against a plain per-stock loop."""

import datetime as dt
import math
import random

import pytest

from pyspark.sql import functions as F

from tickloom.operators.returns import PIECE, _borders, bar_returns, in_pieces, return_series, with_seams
from tickloom.schema import empty_bars
from tests.support import make_bars

NAN = float("nan")


def sample(seed, stocks=6, bars=120, days=9):
    """Random bars, half of them of one stock, with gaps of whole days, 0, null, NaN."""
    pick = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    seen, rows = set(), []
    for i in range(bars):
        stock = "HOT" if i % 2 else f"S{pick.randrange(stocks)}"
        when = start + dt.timedelta(days=pick.randrange(days), minutes=pick.randrange(1440))
        if (stock, when) not in seen:
            seen.add((stock, when))
            close = pick.choice([0.0, None, NAN] + [round(pick.uniform(1, 9), 2)] * 12)
            rows.append((stock, when.isoformat(), close))
    return rows


def expected(rows, n):
    out = {}
    for stock in {r[0] for r in rows}:
        history = sorted((r[1], r[2]) for r in rows if r[0] == stock)
        for i, (when, close) in enumerate(history):
            before = history[i - 1][1] if i else None
            change = None if before in (None, 0.0) or close is None else (close - before) / before
            frame = [c for _, c in history[max(0, i - n + 1) : i + 1] if c is not None]
            out[stock, when] = (before, change, sum(frame) / len(frame) if frame else None)
    return out


def same(a, b):
    if a is None or b is None:
        return a is b
    return (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-12)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 40])
@pytest.mark.parametrize("pieces", [None, 4, 40])
def test_same_as_one_window_per_stock(spark, n, pieces):
    rows = sample(n)
    bars = make_bars(spark, rows).repartition(5)
    got = bar_returns(bars, n, average_name="avg", pieces=pieces).collect()
    want = expected(rows, n)
    assert len(got) == len(rows)
    for row in got:
        values = (row.prev_day_close, row.daily_return, row.avg)
        assert all(map(same, values, want[row.stock, row.date.isoformat()])), row


def test_all_bar_columns_survive(spark):
    bars = make_bars(spark, [("A", "2024-01-01T10:00:00", 1.0, 2.0, 3.0, 4.0, 5.0)])
    assert tuple(bar_returns(bars).first())[2:] == (1.0, 2.0, 3.0, 4.0, 5.0, None, None, 4.0)


def test_previous_row_may_be_days_before(spark):
    bars = make_bars(spark, [("A", "2024-01-01T10:00:00", 2.0), ("A", "2024-03-01T10:00:00", 3.0)])
    got = {r.date.month: r.daily_return for r in bar_returns(bars).collect()}
    assert got == {1: None, 3: 0.5}


def test_missing_dates_and_stocks_form_their_own_groups(spark):
    bars = make_bars(spark, [("A", None, 2.0), ("A", "2024-01-01T10:00:00", 3.0), (None, "2024-01-01T10:00:00", 4.0)])
    for n, pieces in ((1, None), (3, None), (1, 3), (3, 3)):
        got = bar_returns(bars, n, average_name="avg", pieces=pieces).collect()
        assert sorted((str(r.date), r.close, r.prev_day_close) for r in got) == [
            ("2024-01-01 10:00:00", 3.0, 2.0), ("2024-01-01 10:00:00", 4.0, None), ("None", 2.0, None)]


def test_tied_bars_with_a_tie_break(spark):
    rows = [("A", "2024-01-01T10:00:00", 1.0), ("A", "2024-01-01T10:00:00", 2.0), ("A", "2024-01-02T10:00:00", 8.0)]
    got = bar_returns(make_bars(spark, rows), order=("date", "close")).collect()
    assert sorted((r.close, r.prev_day_close) for r in got) == sorted([(1.0, None), (2.0, 1.0), (8.0, 2.0)], key=str)


def test_report_columns_and_empty_input(spark):
    report = return_series(bar_returns(empty_bars(spark)))
    assert report.columns == ["stock", "date", "daily_return", "moving_avg_1d"] and report.count() == 0


def test_a_window_needs_a_row(spark):
    with pytest.raises(ValueError):
        bar_returns(empty_bars(spark), 0)


def test_bars_are_worked_out_once(spark):
    frame = bar_returns(make_bars(spark, sample(1)), 5, pieces=4)
    folders = {name.rsplit("/", 2)[-2] for name in frame.inputFiles()}
    assert folders == {"pieces", "borders"}
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" not in plan and "Scan ExistingRDD" not in plan and "Cartesian" not in plan


def test_a_hot_stock_takes_several_pieces(spark):
    bars = make_bars(spark, [("HOT", f"2024-01-01T{i // 60:02d}:{i % 60:02d}:00", 1.0) for i in range(900)])
    sizes = [r["count"] for r in in_pieces(bars, pieces=6).groupBy(PIECE).count().collect()]
    assert len(sizes) == 6 and max(sizes) < 400


@pytest.mark.parametrize("n", [5, 50, 200])
def test_window_input_stays_below_twice_the_bars(spark, tmp_path, n):
    rows = [(f"S{i % 7}" if i % 3 else "HOT", f"2024-01-{1 + i // 1440:02d}T{i // 60 % 24:02d}:{i % 60:02d}:00", 1.0) for i in range(6000)]
    in_pieces(make_bars(spark, rows), pieces=8).write.parquet(f"{tmp_path}/cut")
    cut = spark.read.parquet(f"{tmp_path}/cut")
    back = n - 1
    seamed = with_seams(cut, _borders(cut, back), back, ["date"])
    assert 6000 < seamed.count() <= 6000 + 7 * back


def test_short_pieces_take_rows_from_several_before_them(spark):
    rows = [("A", f"2024-01-01T00:{i:02d}:00", float(i)) for i in range(20)]
    bars = make_bars(spark, rows)
    got = bar_returns(bars, 6, average_name="avg", pieces=20).orderBy("date").collect()
    assert [r.avg for r in got] == [sum(range(max(0, i - 5), i + 1)) / (i + 1 - max(0, i - 5)) for i in range(20)]
    givers = _borders(bars.withColumn(PIECE, F.minute("date")), 5).groupBy("taker").count().collect()
    assert {r.taker: r["count"] for r in givers} == {i: min(i, 5) for i in range(1, 20)}
