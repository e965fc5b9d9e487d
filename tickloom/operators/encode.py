"""Bars to what leaves the engine: points, line protocol, messages, archive text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalar import calendar_day, epoch_seconds
from tickloom.functions.text import (
    escape_measurement,
    escape_name,
    is_finite,
    iso_utc,
    number_text,
    without_exponent,
)
from tickloom.schema import BAR_FIELDS, VALUE_FIELDS

# Fixed value: the measurement live bars are written under.
MEASUREMENT = "stock-price-v1"


def to_points(bars: DataFrame, measurement: str = MEASUREMENT) -> DataFrame:
    """Bars as points: measurement, tag map, field map, time in seconds."""
    fields = [part for name in VALUE_FIELDS for part in (F.lit(name), F.col(name))]
    return bars.select(
        F.lit(measurement).alias("measurement"),
        F.create_map(F.lit("stock"), F.col("stock")).alias("tags"),
        F.create_map(*fields).alias("fields"),
        epoch_seconds("date").alias("time"),
    )


def bar_lines(
    bars: DataFrame,
    measurement: str = MEASUREMENT,
    tags: Sequence[str] = ("stock",),
    fields: Sequence[str] = tuple(VALUE_FIELDS),
    time: str = "date",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Bars as line protocol, ``measurement[,tag=value...] field=value[,...] time``.

    Missing tags and unwritable fields are left out, and so is the tag part when
    there is none. Rows without a time or without a single field are dropped: such
    points cannot exist.

    Numbers become text in a projection of their own, so that each is converted
    once although the final text looks at it several times; one lambda over their
    array keeps the generated code small enough to be compiled. Rows are dropped
    ahead of that, on the raw numbers, or the filter would repeat the encoding.
    """
    names = {name: F.concat(escape_name(F.lit(name)), F.lit("=")) for name in (*tags, *fields)}
    tag_parts = [
        F.when(F.length(name) > 0, F.concat(names[name], escape_name(name))) for name in tags
    ]
    texts = [F.when(is_finite(name), F.col(name)).cast("string") for name in fields]
    field_parts = [F.concat(names[n], F.col("_texts")[i]) for i, n in enumerate(fields)]
    line = F.concat_ws(
        " ",
        F.concat_ws(",", escape_measurement(F.lit(measurement)), *tag_parts),
        F.concat_ws(",", *field_parts),
        epoch_seconds(time).cast("string"),
    )
    return (
        bars.where(F.col(time).isNotNull() & reduce(or_, map(is_finite, fields)))
        .withColumn("_texts", F.array(*texts))
        .withColumn("_texts", F.transform("_texts", without_exponent))
        .select(*keep, line.alias("line"))
    )


def point_lines(points: DataFrame) -> DataFrame:
    """Points with arbitrary tag and field maps as a column ``line``."""
    tags = F.filter(F.map_entries("tags"), lambda e: F.length(e["value"]) > 0)
    tag_parts = F.transform(
        tags, lambda e: F.concat(escape_name(e["key"]), F.lit("="), escape_name(e["value"]))
    )
    writable = F.filter(F.map_entries("fields"), lambda e: is_finite(e["value"]))
    field_parts = F.transform(
        writable, lambda e: F.concat(escape_name(e["key"]), F.lit("="), number_text(e["value"]))
    )
    line = F.concat_ws(
        " ",
        F.concat_ws(",", escape_measurement("measurement"), tag_parts),
        F.concat_ws(",", field_parts),
        F.col("time").cast("string"),
    )
    any_field = F.exists(F.map_values("fields"), is_finite)
    return points.where(F.col("time").isNotNull() & any_field).select(line.alias("line"))


def bar_json(bars: DataFrame) -> Column:
    """A bar as a JSON object with its seven fields, the date as ISO text in UTC.

    Bars that know when they were ingested say so in an eighth field.
    """
    parts = [F.col("stock"), iso_utc("date").alias("date")]
    parts += [F.col(name).cast("double").alias(name) for name in VALUE_FIELDS]
    if "ingest_ts" in bars.columns:
        parts.append(iso_utc("ingest_ts").alias("ingest_ts"))
    return F.to_json(F.struct(*parts))


def to_messages(bars: DataFrame) -> DataFrame:
    """Bars as keyed messages: the symbol as key, the JSON text as value.

    The key alone places a record, so one stock stays in order on one topic
    partition; readers order by event time anyway.
    """
    bars = bars.select(*BAR_FIELDS)
    return bars.select(F.col("stock").alias("key"), bar_json(bars).alias("value"))


def to_archive(bars: DataFrame) -> DataFrame:
    """Bars as archive rows: the day they are filed under and their JSON text."""
    return bars.select(calendar_day("date").alias("day"), bar_json(bars).alias("value"))
