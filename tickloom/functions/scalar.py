"""Row-level expressions over bars. All of them are built-in column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_instant(text: Column | str) -> Column:
    """ISO text to timestamp: with or without offset or fraction; null if neither fits."""
    return F.try_to_timestamp(column(text))


def calendar_day(date: Column | str) -> Column:
    """The calendar day of an instant in the session time zone."""
    return F.to_date(column(date))


def epoch_seconds(date: Column | str) -> Column:
    """Whole seconds since 1970, the precision of the point store."""
    return F.unix_seconds(column(date).cast("timestamp"))


def simple_return(price: Column | str, previous: Column | str) -> Column:
    """``(price - previous) / previous``; null when the previous price is 0 or missing."""
    return F.try_divide(column(price) - column(previous), column(previous))


def direction(opening: Column | str, closing: Column | str) -> Column:
    """1 for a rise, -1 for a fall, 0 otherwise, a missing price included."""
    opening, closing = column(opening), column(closing)
    return F.when(closing > opening, 1).when(closing < opening, -1).otherwise(0)
