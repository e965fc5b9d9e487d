"""The bar data model: one declaration shared by the stream and batch sides."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The field names of a bar, in wire order.
PRICE_FIELDS = ["open", "high", "low", "close"]
VALUE_FIELDS = PRICE_FIELDS + ["volume"]
BAR_FIELDS = ["stock", "date"] + VALUE_FIELDS

BAR_SCHEMA = T.StructType(
    [T.StructField("stock", T.StringType()), T.StructField("date", T.TimestampType())]
    + [T.StructField(name, T.DoubleType()) for name in VALUE_FIELDS]
)

# A bar as it arrives: the date is still text, so that a record whose date cannot
# be parsed is told apart from one that has none. Our own archive also notes when a
# bar was ingested; other writers leave that key out.
WIRE_SCHEMA = T.StructType(
    [T.StructField("stock", T.StringType()), T.StructField("date", T.StringType())]
    + [T.StructField(name, T.DoubleType()) for name in VALUE_FIELDS]
    + [T.StructField("ingest_ts", T.StringType())]
)

# A keyed message, the part of a topic record that is used.
MESSAGE_SCHEMA = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]
)


@dataclass(frozen=True)
class TopicOptions:
    """Where keyed bar messages live. Credentials go into ``extra`` at run time.

    A backlog is worked off in batches of at most ``max_offsets_per_trigger`` records.
    """

    brokers: str
    topic: str
    starting_offsets: str = "latest"
    max_offsets_per_trigger: int = 50_000_000
    extra: tuple[tuple[str, str], ...] = ()


def empty_bars(spark: SparkSession) -> DataFrame:
    """A typed relation without rows, the identity of ``unionByName`` over bars."""
    return spark.createDataFrame([], BAR_SCHEMA)
