"""Duplicates and revisions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.schema import BAR_FIELDS


def union_bars(*frames: DataFrame) -> DataFrame:
    """Bag union by column name. For many files use one scan, not one frame each."""
    return reduce(DataFrame.unionByName, frames)


def distinct_bars(bars: DataFrame) -> DataFrame:
    """Drop exact copies over all columns.

    A hash aggregate on every column: copies meet inside each map task first, so a
    record that makes up a third of the input is one row per task in the shuffle.
    """
    return bars.dropDuplicates()


_INSTANTS = (T.TimestampType, T.TimestampNTZType)
_WHOLE = (*_INSTANTS, T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def ordering(columns: Sequence[str], schema: T.StructType) -> Column:
    """One comparable value for ``columns``.

    A single column is used as it is. An instant followed by another instant or a whole
    number is packed into one decimal. Both have a fixed width, which keeps ``max_by`` a
    hash aggregate. Anything else becomes a struct, which Spark aggregates by sorting.
    """
    if len(columns) == 1:
        return F.col(columns[0])
    kinds = [schema[name].dataType for name in columns]
    if len(columns) == 2 and isinstance(kinds[0], _INSTANTS) and isinstance(kinds[1], _WHOLE):
        return _packed(*columns, isinstance(kinds[1], _INSTANTS))
    return F.struct(*columns)


def _packed(first: str, second: str, second_is_instant: bool) -> Column:
    """``first`` in microseconds times 2e19, plus ``second`` raised above zero.

    Instants of the years 1 to 9999 stay below 3e17 microseconds and 64-bit numbers below
    1e19, so neither part reaches into the other and 38 digits hold both. A null comes
    before every value, as it does in a struct.
    """

    def micros(name: str) -> Column:
        return F.unix_micros(F.col(name).cast("timestamp"))

    def digits(value: Column) -> Column:
        return value.cast("decimal(19,0)")

    high = F.coalesce(digits(micros(first)), F.lit(-(10**18)).cast("decimal(19,0)"))
    low = digits(micros(second) if second_is_instant else F.col(second).cast("bigint"))
    raised = F.coalesce(low + F.expr("10000000000000000000BD"), F.expr("0BD"))
    return (high * F.expr("20000000000000000000BD")).cast("decimal(38,0)") + raised


def of_last(names: Sequence[str], order: Sequence[str], schema: T.StructType) -> list[Column]:
    """Aggregates that give, for each of ``names``, its value in the last row.

    ``max_by`` passes over rows whose order is null. Where a group has no others,
    one of those rows is taken. The order of several columns is itself never null.
    """
    by = ordering(order, schema)
    last = {name: F.max_by(name, by) for name in names}
    if len(order) == 1:
        unordered = F.max(by).isNull()
        last = {
            name: F.when(unordered, F.any_value(name)).otherwise(value)
            for name, value in last.items()
        }
        if order[0] in last:
            last[order[0]] = F.max(by)
    return [value.alias(name) for name, value in last.items()]


def last_write_wins(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Keep, for every key, the values of the row that comes last in ``order``.

    Ties within a key are settled arbitrarily; add columns to ``order`` to break
    them. One aggregate with map-side combine, whatever the group size.
    """
    values = [name for name in rows.columns if name not in keys]
    settled = rows.groupBy(*keys).agg(*of_last(values, order, rows.schema))
    return settled.select(*rows.columns)


def settle_revisions(
    bars: DataFrame, order: Sequence[str] = ("ingest_ts",)
) -> DataFrame:
    """One bar per stock and instant: the last one ingested.

    The feed re-sends the current bar with changing values, so copies of one
    ``(stock, date)`` differ and survive :func:`distinct_bars`.
    """
    return last_write_wins(bars, ["stock", "date"], order).select(*BAR_FIELDS)
