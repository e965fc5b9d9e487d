"""Bars out of a table of ticks, the landed form of a market feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.clean import ordering
from tickloom.schema import BAR_FIELDS


def bars_from_ticks(
    ticks: DataFrame,
    key: str,
    time: str,
    value: str,
    grain: str = "hour",
    name: Column | None = None,
    ties: Sequence[str] = (),
) -> DataFrame:
    """One bar per key and time bucket; the volume is the number of ticks.

    ``name`` turns the key into the symbol. It is applied after the aggregate, once
    per bar, so ticks are grouped on the raw key. A single hash aggregate: a hot key
    reaches the shuffle as at most one row per bucket and map task. Where a key has
    several ticks at one instant, the columns ``ties`` say which is first and last.
    """
    by = ordering([time, *ties], ticks.schema)
    bucket = F.date_trunc(grain, F.col(time)).cast(ticks.schema[time].dataType)
    bars = ticks.groupBy(F.col(key).alias("_key"), bucket.alias("date")).agg(
        F.min_by(value, by).alias("open"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
        F.max_by(value, by).alias("close"),
        F.count(F.lit(1)).cast("double").alias("volume"),
    )
    symbol = F.col("_key").cast("string") if name is None else name
    return bars.withColumn("stock", symbol).select(*BAR_FIELDS)


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars of the ``events`` table, one stock per user."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return bars_of_events(events)


def bars_of_events(events: DataFrame) -> DataFrame:
    """:func:`event_bars` over an already restricted ``events`` frame."""
    name = F.concat(F.lit("S"), F.col("_key"))
    return bars_from_ticks(events, "user_id", "ts", "value", "hour", name)
