"""Keyed state: bars sent again when they are superseded, returns over micro-batches.

Both operators keep little per key and hand on nothing that has not changed. Their
output is a log of changes; :func:`tickloom.operators.clean.last_write_wins` over it, or
an upserting sink, gives the table as it stands.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tickloom.functions.scalar import calendar_day
from tickloom.session import ROCKSDB_PROVIDER

# The processors travel with the job: executors need numpy and pandas, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Columns that go along with the rows. Names must not begin with an underscore: those
# reach the processors renumbered.
_DAY, _FIRST, _SECOND = "keyed_day", "keyed_first", "keyed_second"
_PLACE = "keyed_place"
_INSTANT, _ARRIVED = "keyed_instant", "keyed_arrived"


#: The stocks of a day are kept in so many entries of a store: each costs some calls.
DAY_PLACES = 1024

# What keyed state asks for: a store on disk, whose commits write what has changed.
_STORE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, which keyed state asks for.

    A query takes its store with it when it starts; the session's settings are put back.
    """
    before = {name: spark.conf.get(name, None) for name in _STORE}
    for name, value in _STORE.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _micros(spark: SparkSession, span: str) -> int:
    """The length of an interval such as ``2 hours`` in microseconds."""
    end = F.timestamp_seconds(F.lit(0)) + F.expr(f"interval {span}")
    return spark.range(1).select(F.unix_micros(end)).first()[0]


class _Supersede(StatefulProcessor):
    """Per day, for some of its stocks: the order in which the last version of each instant came."""

    def __init__(self, delay_ms: int, columns: list[str]) -> None:
        self.delay_ms, self.columns = delay_ms, columns

    def init(self, handle) -> None:
        # ``until`` goes with ``stocks``; ``of`` is the place of an instant's stock there.
        self.handle = handle
        self.seen = handle.getValueState(
            "seen",
            "stocks array<string>, until array<bigint>, of array<int>, instants array<bigint>, "
            "first array<bigint>, second array<bigint>, timer bigint",
        )

    def keep(self, until: dict, last: dict, timer: int) -> None:
        """Write what is known, and see to it that a timer rings when the first stock's time is up."""
        place = {stock: n for n, stock in enumerate(until)}
        rings = min(until.values())
        if rings < timer or timer < 0:
            self.handle.registerTimer(rings)
            timer = rings
        of, instants = [place[stock] for stock, _ in last], [instant for _, instant in last]
        first, second = [a for a, _ in last.values()], [b for _, b in last.values()]
        self.seen.update((list(until), list(until.values()), of, instants, first, second, timer))

    def known(self) -> tuple[dict, dict, int]:
        kept = self.seen.get()
        if kept is None:
            return {}, {}, -1
        stocks, until, of, instants, first, second, timer = kept
        last = {(stocks[n], i): (a, b) for n, i, a, b in zip(of, instants, first, second)}
        return dict(zip(stocks, until)), last, timer

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new, arrived, at = {}, {}, None
        for row in rows:  # the last version of each instant in this batch
            if at is None:
                names = list(row.__fields__)
                at = [names.index(n) for n in ("stock", _INSTANT, _FIRST, _SECOND, _ARRIVED)]
                places = [names.index(n) for n in self.columns]
            stock, instant, first, second, time = (row[k] for k in at)
            order, bar = (first, second), (stock, instant)
            if time > arrived.get(stock, 0):
                arrived[stock] = time
            if bar not in new or order >= new[bar][0]:
                new[bar] = order, row
        until, last, timer = self.known()
        passes = [bar for bar, (order, _) in new.items() if bar not in last or order > last[bar]]
        raised = {s: t + self.delay_ms for s, t in arrived.items() if t + self.delay_ms > until.get(s, 0)}
        for stock, _ in passes:
            raised.setdefault(stock, until.get(stock, self.delay_ms))
        if raised:
            last.update({bar: new[bar][0] for bar in passes})
            until.update(raised)
            self.keep(until, last, timer)
        made = Row(*self.columns)
        for bar in passes:
            row = new[bar][1]
            yield made(*(row[k] for k in places))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # Stocks that have heard more since stay, and so does a timer for them.
        until, last, _ = self.known()
        now = timerValues.getCurrentWatermarkInMs()
        until = {stock: time for stock, time in until.items() if time > now}
        if until:
            self.keep(until, {bar: order for bar, order in last.items() if bar[0] in until}, -1)
        else:
            self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def superseding_bars(
    bars: DataFrame,
    delay: str,
    order: Sequence[str] = ("ingest_ts", "offset"),
    arrival: str = "arrival",
    places: int = DAY_PLACES,
) -> DataFrame:
    """Each bar when it first comes, and again whenever a later version of it does.

    Versions of a bar share ``stock`` and ``date``; the one last in ``order``, an
    instant and a whole number, stands. A version that is not later than one already
    sent, a redelivery or a straggler, is held back, in a batch and across batches.

    State is kept per stock and day, a few numbers per instant, until nothing has come
    for that day for ``delay`` of arrival time; ``arrival`` is when a record reached the
    topic. Stocks of a day are filed together in ``places`` entries of the store, so that
    a batch asks it once for many of them. A running query keeps its ``places``. After that a version counts as new again: it is sent, never lost, and
    ``order``, which is passed on, lets the reader settle it. Records whose arrival
    lies further back than ``delay`` behind the newest one are dropped by the watermark,
    and counted by the progress log: arrival is the topic's clock, not the sender's.

    Start the query inside :func:`rocksdb_state`.
    """
    first, second = order
    kept = [name for name in bars.columns if name != arrival]
    marked = bars.withWatermark(arrival, delay).withColumns(
        {
            _DAY: calendar_day("date"),
            _PLACE: F.crc32(F.col("stock").cast("binary")) % places,
            _INSTANT: F.unix_micros(F.col("date").cast("timestamp")),
            _FIRST: F.coalesce(F.unix_micros(F.col(first).cast("timestamp")), F.lit(-(2**63) + 1)),
            _SECOND: F.coalesce(F.col(second).cast("bigint"), F.lit(-(2**63) + 1)),
            _ARRIVED: F.unix_millis(F.col(arrival).cast("timestamp")),
        }
    )
    out = T.StructType([bars.schema[name] for name in kept])
    return marked.groupBy(_PLACE, _DAY).transformWithState(
        _Supersede(_micros(bars.sparkSession, delay) // 1000, kept), out, "Append", "eventTime"
    )


class _Rolling(StatefulProcessor):
    """Per stock: its latest closes in time order, as far back as late bars may change."""

    def __init__(self, moving_rows: int, lateness_us: int) -> None:
        self.rows, self.back, self.lateness = moving_rows, max(1, moving_rows - 1), lateness_us

    def init(self, handle) -> None:
        # ``whole`` says that no bar of the stock has been let go of yet.
        self.kept = handle.getValueState("kept", "dates array<bigint>, closes array<double>, whole boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        # By instant, the last in order; an instant seen before is replaced.
        new = new.sort_values([_INSTANT, _FIRST], kind="stable").drop_duplicates(_INSTANT, keep="last")
        dates, closes, whole = self.kept.get() if self.kept.exists() else ([], [], True)
        dates = np.array(dates, np.int64)
        # Spark hands a null close over as not-a-number; state keeps it that way.
        closes = np.array([np.nan if c is None else c for c in closes], float)
        coming, values = new[_INSTANT].to_numpy(np.int64), new["close"].to_numpy(float)
        # What comes before the rows that are needed to compute it cannot be placed.
        border = dates[self.back - 1] if not whole and len(dates) >= self.back else np.iinfo(np.int64).min
        late = coming <= border if not whole else np.zeros(len(coming), bool)
        stay = ~np.isin(dates, coming[~late])
        all_dates = np.concatenate((dates[stay], coming[~late]))
        all_closes = np.concatenate((closes[stay], values[~late]))
        order = np.argsort(all_dates, kind="stable")
        all_dates, all_closes = all_dates[order], all_closes[order]
        # A changed bar changes itself and those that look back on it.
        at = np.searchsorted(all_dates, coming[~late])
        touched = np.zeros(len(all_dates) + self.back + 1, np.int64)
        np.add.at(touched, at, 1)
        np.add.at(touched, at + self.back + 1, -1)
        changed = np.flatnonzero(np.cumsum(touched[: len(all_dates)]) > 0)
        previous = np.where(changed > 0, all_closes[np.maximum(changed - 1, 0)], np.nan)
        averages = [all_closes[max(0, k - self.rows + 1) : k + 1] for k in changed]
        averages = [np.mean(a[~np.isnan(a)]) if (~np.isnan(a)).any() else np.nan for a in averages]
        told = pd.DataFrame(
            {
                "stock": key[0],
                "at": np.concatenate((all_dates[changed], coming[late])),
                "close": np.concatenate((all_closes[changed], values[late])),
                "prev_day_close": np.concatenate((previous, np.full(late.sum(), np.nan))),
                "moving_avg": np.concatenate((averages, np.full(late.sum(), np.nan))),
                "late": np.concatenate((np.zeros(len(changed), bool), np.ones(late.sum(), bool))),
            }
        )
        if len(all_dates):
            needed = np.searchsorted(all_dates, all_dates[-1] - self.lateness)
            first = max(0, needed - self.back)
            self.kept.update((all_dates[first:].tolist(), all_closes[first:].tolist(), bool(whole and first == 0)))
        yield told

    def close(self) -> None:
        pass


def rolling_returns(
    bars: DataFrame, moving_rows: int = 1, lateness: str = "1 day", order: str = "ingest_ts"
) -> DataFrame:
    """Previous close, return and moving average of a stream of bars, kept up to date.

    A bar is told when it comes; when a late or revised bar takes a place before others,
    it and the rows that look back on it, ``moving_rows`` at most, are told again. Of
    versions of a bar in one batch the last in ``order`` counts, over batches the one
    that came last. Rows told by a later batch replace those of an earlier one.

    State per stock: its bars of the last ``lateness`` before the newest one and as many
    before these as an average looks back. A bar older than that is not lost: it is told
    with ``late`` set and without return or average, for a batch run to repair. One stock
    is one key, and its bars of a batch meet in one task. A close that is null counts as
    missing in averages, as it does in a batch.

    Start the query inside :func:`rocksdb_state`.
    """
    if moving_rows < 1:
        raise ValueError("a moving average needs at least one row")
    marked = bars.select(
        "stock",
        "close",
        F.unix_micros(F.col("date").cast("timestamp")).alias(_INSTANT),
        F.coalesce(F.unix_micros(F.col(order).cast("timestamp")), F.lit(-(2**63) + 1)).alias(_FIRST),
    )
    told = marked.groupBy("stock").transformWithStateInPandas(
        _Rolling(moving_rows, _micros(bars.sparkSession, lateness)),
        "stock string, at bigint, close double, prev_day_close double, moving_avg double, late boolean",
        "Append",
        "none",
    )
    told = told.select(
        "stock",
        F.timestamp_micros("at").alias("date"),
        *(F.when(~F.isnan(name), F.col(name)).alias(name) for name in ("close", "prev_day_close", "moving_avg")),
        "late",
    )
    previous = F.col("prev_day_close")
    return told.withColumn("daily_return", F.try_divide(F.col("close") - previous, previous))
