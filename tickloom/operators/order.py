"""Presentation order. Nothing else in the engine depends on a sort."""

from __future__ import annotations

from pyspark.sql import DataFrame


def sorted_bars(bars: DataFrame) -> DataFrame:
    """Bars in total order by stock and time.

    Range-partitioned on both columns, so a hot stock spreads over many ranges.
    """
    return bars.orderBy("stock", "date")


def preview(bars: DataFrame, rows: int = 20) -> DataFrame:
    """The first rows in that order; planned as a top-k, not as a sort."""
    return sorted_bars(bars).limit(rows)
