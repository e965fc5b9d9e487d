import math

from tickloom.operators.stats import daily_prices, market_breadth, stock_summary
from tickloom.schema import empty_bars
from tests.support import make_bars

NAN = float("nan")


def test_summary_of_one_bar_has_no_deviation(spark):
    row = stock_summary(make_bars(spark, [("A", "2024-01-01T10:00:00", 1.0, 4.0, 0.5, 2.0, 9.0)])).first()
    assert tuple(row) == ("A", 1.0, 4.0, 0.5, 2.0, 9.0, None, 4.0, 0.5)


def test_summary_is_over_all_bars_with_sample_deviation(spark):
    rows = [("A", f"2024-01-01T1{i}:00:00", float(c)) for i, c in enumerate([1, 2, 3, 6])]
    row = stock_summary(make_bars(spark, rows)).first()
    assert row.avg_close == 3.0 and math.isclose(row.std_dev_close, math.sqrt(14 / 3))


def test_nan_goes_through_means_and_is_the_largest(spark):
    rows = [("A", "2024-01-01T10:00:00", 1.0), ("A", "2024-01-01T11:00:00", NAN)]
    row = stock_summary(make_bars(spark, rows)).first()
    assert math.isnan(row.avg_low) and math.isnan(row.historical_high) and row.historical_low == 1.0


def test_nulls_are_left_out_of_means(spark):
    rows = [("A", "2024-01-01T10:00:00", None), ("A", "2024-01-01T11:00:00", 4.0)]
    assert stock_summary(make_bars(spark, rows)).first().avg_close == 4.0


def day(spark, *bars):
    """Direction code of one day given ``(open, close)`` pairs in time order."""
    rows = [("A", f"2024-01-01T{10 + i}:00:00", o, 9.0, 0.0, c, 1.0) for i, (o, c) in enumerate(bars)]
    return daily_prices(make_bars(spark, rows).repartition(3)).first()


def test_daily_open_is_the_first_and_close_the_last_in_time(spark):
    row = day(spark, (5.0, 1.0), (2.0, 8.0), (3.0, 7.0))
    assert (row.daily_open, row.daily_close, row.daily_change) == (5.0, 7.0, 1)


def test_direction_codes(spark):
    assert day(spark, (2.0, 1.0)).daily_change == -1
    assert day(spark, (2.0, 2.0)).daily_change == 0
    assert day(spark, (None, 2.0)).daily_change == 0
    assert day(spark, (2.0, None)).daily_change == 0
    assert day(spark, (2.0, NAN)).daily_change == 1
    assert day(spark, (NAN, NAN)).daily_change == 0


def test_breadth_counts_every_stock_of_the_day_once(spark):
    rows = []
    for i in range(30):
        for d in (1, 2, 3):
            rows.append((f"S{i}", f"2024-01-0{d}T10:00:00", 5.0, 9.0, 0.0, 5.0 + (i + d) % 3 - 1, 1.0))
    got = market_breadth(daily_prices(make_bars(spark, rows))).collect()
    assert len(got) == 3
    for row in got:
        assert (row.num_stocks_increased, row.num_stocks_decreased, row.num_stocks_unchanged) == (10, 10, 10)


def test_days_follow_the_utc_calendar(spark):
    rows = [("A", "2024-01-01T23:59:59", 1.0), ("A", "2024-01-02T00:00:00", 2.0)]
    assert daily_prices(make_bars(spark, rows)).count() == 2


def test_empty_in_empty_out(spark):
    none = empty_bars(spark)
    assert stock_summary(none).count() == 0
    assert market_breadth(daily_prices(none)).count() == 0


def test_no_sort_and_one_exchange_each(spark):
    bars = make_bars(spark, [("A", "2024-01-01T10:00:00", 1.0)])
    for frame, exchanges in [(stock_summary(bars), 1), (daily_prices(bars), 1),
                             (market_breadth(daily_prices(bars)), 2)]:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan and plan.count("Exchange") == exchanges
