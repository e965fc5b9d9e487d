"""Range reads of the stored point table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.clean import last_write_wins
from tickloom.operators.latest import time_range

# Fixed value: what identifies a point.
POINT_IDENTITY = ["measurement", "stock", "time"]


def write_order() -> Column:
    """When a stored point was written: file time, then batch, in one number.

    Runs number their batches on their own, so the time comes first. As a decimal both
    fit one value, which keeps the aggregate that settles points a hash aggregate.
    """
    written = F.unix_micros("_metadata.file_modification_time").cast("decimal(18,0)")
    return (written * F.lit(10**18).cast("decimal(19,0)") + F.col("batch_id")).cast("decimal(38,0)")


def read_points(
    spark: SparkSession, path: str, start: Column | None = None, end: Column | None = None
) -> DataFrame:
    """Points with ``start <= time < end``, the last write of each.

    The range prunes day folders and reaches the Parquet scan before revisions are
    settled, so a short range over a long history touches little data.
    """
    stored = spark.read.parquet(path)
    stored = stored.withColumn("write_order", write_order()).drop("run", "batch_id")
    if start is not None:
        stored = time_range(stored, start, end, "time")
    settled = last_write_wins(stored, POINT_IDENTITY, ["write_order"])
    return settled.drop("day", "write_order")


def recent_points(spark: SparkSession, path: str, as_of: Column, span: str) -> DataFrame:
    """Points from ``as_of - span`` on."""
    return read_points(spark, path, as_of - F.expr(f"interval {span}"))
