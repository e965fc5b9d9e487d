"""The newest bar at or before given instants, without one task per stock."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.returns import PIECE, in_pieces
from tickloom.session import run_dir

_IS_POLL, _BAR = "_is_poll", "_bar"


def as_of(bars: DataFrame, polls: DataFrame, pieces: int | None = None, span: str | None = None) -> DataFrame:
    """For every poll, ``stock`` and ``polled_at``, the newest bar with ``date <= polled_at``.

    Polls and bars are put in one order, cut into pieces, ranges of stock and instant of
    like size, and written; within a piece the last bar is carried forward. What a piece
    needs from before it is one bar of the stock that its border cuts: the last bar of
    every stock and piece is an aggregate, carried over the pieces, and joins the piece
    as one more row. So a stock that makes up most of the rows takes many tasks.

    A poll before a stock's first bar has no row, and with ``span`` (such as ``1 day``)
    neither has one whose newest bar is older than that. Of several bars of an instant
    any one is taken; settle them first. Polls that repeat are answered as often.
    """
    spark = bars.sparkSession
    values = [name for name in bars.columns if name != "stock"]
    rows = bars.select("stock", F.col("date").alias("_at"), F.lit(0).alias(_IS_POLL), F.struct(*values).alias(_BAR))
    asked = polls.select(
        "stock",
        F.col("polled_at").cast(bars.schema["date"].dataType).alias("_at"),
        F.lit(1).alias(_IS_POLL),
        F.lit(None).cast(rows.schema[_BAR].dataType).alias(_BAR),
    )
    folder = run_dir(spark, "as-of")
    cut = in_pieces(rows.unionByName(asked), ["_at", _IS_POLL], pieces)
    cut.write.parquet(folder)
    cut = spark.read.schema(cut.schema).parquet(folder)

    # One row per stock and piece: as pieces are ranges, hardly more than there are stocks.
    ends = cut.groupBy("stock", PIECE).agg(
        F.max_by(F.when(F.col(_IS_POLL) == 0, F.col(_BAR)), F.when(F.col(_IS_POLL) == 0, F.col("_at"))).alias(_BAR)
    )
    earlier = Window.partitionBy("stock").orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    seams = ends.withColumn(_BAR, F.last(_BAR, ignorenulls=True).over(earlier)).where(F.col(_BAR).isNotNull())
    seams = seams.select("stock", F.col(f"{_BAR}.date").alias("_at"), F.lit(0).alias(_IS_POLL), _BAR, PIECE)

    order = Window.partitionBy(PIECE, "stock").orderBy("_at", _IS_POLL)
    carried = F.last(_BAR, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    answered = cut.unionByName(seams).withColumn(_BAR, carried).where(F.col(_IS_POLL) == 1)
    found = answered.where(F.col(_BAR).isNotNull()).select("stock", F.col("_at").alias("polled_at"), f"{_BAR}.*")
    if span is not None:
        found = found.where(F.col("date") >= F.col("polled_at") - F.expr(f"interval {span}"))
    return found


def poll_instants(bars: DataFrame, stocks: DataFrame, every: str) -> DataFrame:
    """A poll of each of ``stocks`` every so often, from the first bar's time to the last's.

    The instants are worked out per stock from the two ends: no join of all with all.
    """
    ends = bars.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    first, last = ends.select("first").scalar(), ends.select("last").scalar()
    instants = F.sequence(first, last, F.expr(f"interval {every}"))
    return stocks.select("stock", F.explode(instants).alias("polled_at"))
