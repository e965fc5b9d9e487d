"""Latest bar per stock, symbol universe, time ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.clean import last_write_wins

# Symbol lists up to this length become a literal IN filter, which reaches the scan.
LITERAL_SYMBOLS = 1000


def latest_bar(bars: DataFrame, order: Sequence[str] = ("date",)) -> DataFrame:
    """The newest bar of every stock; a stock without bars gives no row."""
    return last_write_wins(bars, ["stock"], order)


def parse_universe(symbols: str | None) -> list[str]:
    """Split a comma-separated symbol setting; a missing or empty one is an error."""
    if not symbols:
        raise ValueError("no stock symbols given")
    return symbols.split(",")


def explode_universe(lists: DataFrame, text: str) -> DataFrame:
    """The distinct symbols in a column of comma-separated lists, as ``stock``."""
    listed = lists.where(F.length(text) > 0)
    return listed.select(F.explode(F.split(text, ",")).alias("stock")).distinct()


def in_universe(bars: DataFrame, universe: Sequence[str] | DataFrame) -> DataFrame:
    """Restrict bars to a universe of symbols.

    A short list becomes an ``IN`` filter. A frame, or a long list turned into one,
    is a left-semi join without hint: Spark broadcasts it if its measured size
    allows and shuffles otherwise.
    """
    if isinstance(universe, DataFrame):
        return bars.join(universe, "stock", "left_semi")
    if len(universe) <= LITERAL_SYMBOLS:
        return bars.where(F.col("stock").isin(list(universe)))
    frame = bars.sparkSession.createDataFrame([(s,) for s in universe], "stock string")
    return bars.join(frame, "stock", "left_semi")


def latest_in_universe(
    bars: DataFrame, universe: Sequence[str] | DataFrame
) -> DataFrame:
    """Latest bar of each stock of the universe.

    A literal list filters the scan. A frame is joined after the aggregate, when
    both sides have one row per stock and no key can be hot. That join is an inner
    one: Catalyst would move a semi-join below the aggregate, onto all the bars.
    """
    if isinstance(universe, DataFrame):
        return latest_bar(bars).join(universe.select("stock").distinct(), "stock")
    return latest_bar(in_universe(bars, universe))


def newest_instant(
    rows: DataFrame, time: str = "date", grain: str | None = None, back: str | None = None
) -> Column:
    """The largest time in ``rows``, cut to ``grain`` and moved ``back``, as a subquery.

    The arithmetic sits inside the subquery so that a filter comparing a column with
    it stays of a form the scan can take over once the value is known.
    """
    newest = F.max(time)
    if grain:
        newest = F.date_trunc(grain, newest).cast(rows.schema[time].dataType)
    if back:
        newest = newest - F.expr(f"interval {back}")
    return rows.agg(newest).scalar()


def time_range(
    rows: DataFrame, start: Column, end: Column | None = None, time: str = "date"
) -> DataFrame:
    """Rows with ``start <= time < end``; without ``end`` everything from ``start`` on.

    A frame filed by ``day`` is cut on that column too, which prunes partitions.
    """
    kept = rows.where(F.col(time) >= start)
    if end is not None:
        kept = kept.where(F.col(time) < end)
    if "day" in rows.columns:
        kept = kept.where(F.col("day") >= F.to_date(start))
        if end is not None:
            kept = kept.where(F.col("day") <= F.to_date(end))
    return kept


def lookback(
    rows: DataFrame, as_of: Column, span: str = "1 day", time: str = "date"
) -> DataFrame:
    """Rows of the ``span`` that ends at ``as_of``, which is excluded.

    ``as_of`` is a parameter and never the clock, so runs repeat.
    """
    return time_range(rows, as_of - F.expr(f"interval {span}"), as_of, time)
