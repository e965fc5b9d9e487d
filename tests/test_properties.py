"""What must hold for any bars: order of rows, copies and partitions do not matter."""

import random

import pytest

from tickloom.operators.clean import distinct_bars
from tickloom.operators.latest import latest_bar
from tickloom.operators.returns import bar_returns
from tickloom.operators.stats import daily_prices, market_breadth, stock_summary
from tickloom.sources.ticks import event_bars
from tests.support import make_bars
from tests.test_oracle import SF_DIR


def random_bars(seed):
    pick = random.Random(seed)
    rows = {}
    for _ in range(150):
        stock, day = f"S{pick.randrange(5)}", pick.randrange(1, 6)
        when = f"2024-01-0{day}T{pick.randrange(24):02d}:{pick.randrange(0, 60, 5):02d}:00"
        rows[stock, when] = (stock, when, *[pick.randrange(64) / 4 for _ in range(5)])
    return list(rows.values())


def outcomes(bars):
    daily = daily_prices(bars)
    frames = [stock_summary(bars), daily, market_breadth(daily), latest_bar(bars),
              bar_returns(bars), bar_returns(bars, 4, average_name="avg")]
    # Quarters are exact in binary, but not their deviations.
    return [
        sorted(tuple(round(v, 9) if isinstance(v, float) else str(v) for v in row) for row in frame.collect())
        for frame in frames
    ]


@pytest.mark.parametrize("seed", range(3))
def test_order_partitions_and_copies_do_not_matter(spark, seed):
    rows = random_bars(seed)
    want = outcomes(make_bars(spark, rows).coalesce(1))
    pick = random.Random(seed)
    copied = rows + pick.choices(rows, k=60) + rows[:1] * 80
    pick.shuffle(copied)
    assert outcomes(distinct_bars(make_bars(spark, copied).repartition(seed + 2))) == want


def test_counts_add_up(spark):
    bars = event_bars(spark, SF_DIR)
    stocks = bars.select("stock").distinct().count()
    returns = bar_returns(bars)
    assert returns.count() == bars.count()
    assert returns.where("prev_day_close is null").count() == stocks
    daily = daily_prices(bars)
    counted = "num_stocks_increased + num_stocks_decreased + num_stocks_unchanged"
    per_day = {r.date_only: r.n for r in market_breadth(daily).selectExpr("date_only", f"{counted} as n").collect()}
    assert per_day == {r.date_only: r["count"] for r in daily.groupBy("date_only").count().collect()}
    assert bars.where("open < low or close < low or open > high or close > high").count() == 0
