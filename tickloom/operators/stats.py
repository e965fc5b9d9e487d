"""Per-stock summary, daily prices and market breadth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalar import calendar_day, direction
from tickloom.schema import VALUE_FIELDS

AVERAGE_FIELDS = [f"avg_{name}" for name in VALUE_FIELDS]


def stock_summary(bars: DataFrame) -> DataFrame:
    """Means of the five values, deviation of the close, extremes, per stock."""
    means = [F.avg(name).alias(f"avg_{name}") for name in VALUE_FIELDS]
    return bars.groupBy("stock").agg(
        *means,
        F.stddev_samp("close").alias("std_dev_close"),
        F.max("high").alias("historical_high"),
        F.min("low").alias("historical_low"),
    )


def daily_prices(bars: DataFrame) -> DataFrame:
    """First open and last close of each stock and calendar day, and the direction.

    ``min_by``/``max_by`` over time give the same answer for any row order, need no
    sort and combine on the map side. Expects one bar per stock and instant.
    """
    per_day = bars.groupBy("stock", calendar_day("date").alias("date_only")).agg(
        F.min_by("open", "date").alias("daily_open"),
        F.max_by("close", "date").alias("daily_close"),
    )
    return per_day.withColumn("daily_change", direction("daily_open", "daily_close"))


def market_breadth(daily: DataFrame) -> DataFrame:
    """How many stocks rose, fell and stood still on each day."""
    # The names of the results.
    names = {1: "num_stocks_increased", -1: "num_stocks_decreased", 0: "num_stocks_unchanged"}
    change = F.col("daily_change")
    counts = [F.count_if(change == code).alias(name) for code, name in names.items()]
    return daily.groupBy("date_only").agg(*counts)
