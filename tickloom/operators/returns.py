"""Row-over-row returns and moving averages without one task per stock.

A window over ``stock`` puts the whole history of a stock into one task, and one
stock may hold a third of all rows. Here the bars are first cut into *pieces*, ranges of
``(stock, date)`` of like size, and written: a long history takes several pieces, short
ones share one. The window then runs per piece and stock. What a piece needs from before
it is small: the last few closes of a stock that began in an earlier piece. They join
it as extra *seam* rows through a union. As pieces are ranges, a border between two of
them cuts at most one stock, so a run has at most ``rows averaged * pieces`` seam rows,
however dense the bars are and whatever calendar they keep.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalar import simple_return
from tickloom.session import run_dir

PIECE = "_piece"
_SEAM = "_seam"


def bar_returns(
    bars: DataFrame,
    moving_rows: int = 1,
    order: Sequence[str] = ("date",),
    average_name: str | None = None,
    pieces: int | None = None,
) -> DataFrame:
    """Add ``prev_day_close``, ``daily_return`` and a moving average of the close.

    All three are per bar: the previous row of the stock, whatever day it is from.
    ``moving_rows`` is the number of rows averaged, the current one included; 1
    gives the close itself. The average is called ``moving_avg_<n>d`` unless named.

    Settle revisions first, so that a stock has one bar per instant; otherwise pass
    further columns in ``order`` to break ties. The bars are worked out once and
    written to the shared folder, in ``pieces`` or as many as their size calls for.
    """
    folder = run_dir(bars.sparkSession, "returns")
    cut = _written(in_pieces(bars, order, pieces), f"{folder}/pieces")
    return returns_of_pieces(cut, f"{folder}/borders", moving_rows, order, average_name)


def in_pieces(bars: DataFrame, order: Sequence[str] = ("date",), pieces: int | None = None) -> DataFrame:
    """Bars with the number of their piece; to be written before they are used."""
    ranges = ["stock", *order]
    cut = bars.repartitionByRange(pieces, *ranges) if pieces else bars.repartitionByRange(*ranges)
    return cut.withColumn(PIECE, F.spark_partition_id())


def returns_of_pieces(
    cut: DataFrame,
    borders_path: str,
    moving_rows: int = 1,
    order: Sequence[str] = ("date",),
    average_name: str | None = None,
) -> DataFrame:
    """:func:`bar_returns` over a written table of :func:`in_pieces`.

    ``borders_path`` is a new folder for the list of borders that cut a stock.
    """
    if moving_rows < 1:
        raise ValueError("a moving average needs at least one row")
    average_name = average_name or f"moving_avg_{moving_rows}d"
    back = max(1, moving_rows - 1)
    borders = _written(_borders(cut, back), borders_path)
    window = Window.partitionBy(PIECE, "stock").orderBy(*order)
    if moving_rows == 1:
        average = F.col("close").cast("double")
    else:
        average = F.avg("close").over(window.rowsBetween(1 - moving_rows, 0))
    kept = [name for name in cut.columns if name != PIECE]
    return (
        with_seams(cut, borders, back, order)
        .withColumns(
            {"prev_day_close": F.lag("close").over(window), average_name: average}
        )
        .where(~F.col(_SEAM))
        .withColumn("daily_return", simple_return("close", "prev_day_close"))
        .select(*kept, "prev_day_close", "daily_return", average_name)
    )


def return_series(returns: DataFrame) -> DataFrame:
    """The projection of :func:`bar_returns` that is reported."""
    return returns.select("stock", "date", "daily_return", "moving_avg_1d")


def with_seams(cut: DataFrame, borders: DataFrame, back: int, order: Sequence[str]) -> DataFrame:
    """Bars and, ahead of each cut stock's rows in a piece, the ``back`` rows before them.

    Only the last rows of a piece are shuffled: the rank limit is applied before the
    exchange as well as after it.
    """
    slim = cut.select(*dict.fromkeys(["stock", PIECE, *order, "close"]))
    giving = F.col("b.stock").eqNullSafe(F.col("s.stock")) & (F.col("giver") == F.col(f"s.{PIECE}"))
    newest_first = Window.partitionBy("stock", PIECE).orderBy(
        *[F.col(name).desc() for name in order]
    )
    givers = borders.select("stock", "giver").distinct().alias("b")
    ends = (
        slim.alias("s")
        .join(givers, giving, "left_semi")
        .withColumn("_from_end", F.row_number().over(newest_first))
        .where(F.col("_from_end") <= back)
    )
    seams = (
        ends.alias("s")
        .join(borders.alias("b"), giving & (F.col("_from_end") + F.col("gap") <= back))
        .select(
            "s.stock",
            F.col("taker").alias(PIECE),
            *[f"s.{name}" for name in slim.columns if name not in ("stock", PIECE)],
        )
    )
    return cut.withColumn(_SEAM, F.lit(False)).unionByName(
        seams.withColumn(_SEAM, F.lit(True)), allowMissingColumns=True
    )


def _borders(cut: DataFrame, back: int) -> DataFrame:
    """For each cut of a stock, the pieces that hold the ``back`` rows before it.

    ``taker`` is the piece after the cut, ``giver`` one before it, and ``gap`` the rows
    of the stock between them: none for neighbours. A giver further off is named only
    where the pieces between hold fewer than ``back`` rows of the stock.
    """
    sizes = cut.groupBy("stock", PIECE).count()
    history = Window.partitionBy("stock").orderBy(PIECE)
    ends = sizes.select(
        "stock",
        PIECE,
        F.lead(PIECE).over(history).alias("taker"),
        F.sum("count").over(history).alias("end"),
    ).where("taker is not null")
    near = Window.partitionBy("stock").orderBy("end").rangeBetween(1 - back, 0)
    given = F.collect_list(F.struct(F.col(PIECE).alias("giver"), F.col("end").alias("giver_end")))
    return (
        ends.select("stock", "taker", "end", given.over(near).alias("givers"))
        .select("stock", "taker", "end", F.inline("givers"))
        .select("stock", "taker", "giver", (F.col("end") - F.col("giver_end")).alias("gap"))
    )


def _written(frame: DataFrame, path: str) -> DataFrame:
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
