"""Scans of the JSON bar archive."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.decode import decode_bars
from tickloom.schema import BAR_FIELDS, BAR_SCHEMA

BAR_SCHEMA_TEXT = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in BAR_SCHEMA.fields)


def raw_dump(
    spark: SparkSession, path: str, whole_files: bool = False
) -> DataFrame:
    """The archive as text: ``file_path``, ``file_time`` and ``value``.

    ``whole_files`` is for archives of one record per small file. Otherwise a row is
    a line and large files are split over tasks. A file that vanishes or cannot be read
    fails the dump: it never leaves records out unsaid. Archives filed by ``day`` (and
    ``run`` and ``batch_id``) keep those columns, and filters on them prune folders.
    """
    text = spark.read.text(path, wholetext=whole_files)
    return text.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("file_time"),
        "*",
    )


def scan_archive(
    spark: SparkSession,
    path: str,
    whole_files: bool = False,
    since: dt.date | None = None,
    compacted: bool = False,
    folders: Sequence[str] | None = None,
) -> DataFrame:
    """Every archived record, decoded by ``decode_bars``, in one distributed scan.

    ``folders`` restricts the scan to some folders below ``path``, by their names.

    ``compacted`` reads the Parquet form that ``compact_archive`` writes; its records
    were decoded then, and come back without text or reject reason. The text forms
    refuse Parquet files by an error rather than take their bytes for bad records.

    An empty folder gives an empty typed frame. ``since`` reads only the folders of
    that day and later, where the archive is filed by day. Unlike the dump this
    fails on unreadable files: analysis must not lose records silently.
    """
    if compacted:
        reader = spark.read.schema(f"{BAR_SCHEMA_TEXT}, ingest_ts timestamp, day date")
        bars = reader.parquet(*_below(path, folders))
        bars = bars if since is None else bars.where(F.col("day") >= F.lit(since))
        none = F.lit(None).cast("string")
        return bars.select(
            *BAR_FIELDS,
            "ingest_ts",
            none.alias("value"),
            none.alias("reject_reason"),
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_modification_time").alias("file_time"),
        )
    reader = spark.read.option("basePath", path) if folders is not None else spark.read
    text = reader.text(_below(path, folders), wholetext=whole_files)
    refused = F.raise_error(F.lit("the archive holds Parquet files: scan it as compacted"))
    value = F.when(F.col("value").startswith("PAR1"), refused.cast("string")).otherwise(F.col("value"))
    records = text.withColumn("value", value).select(
        "*",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("file_time"),
    )
    if since is not None and "day" in text.columns:
        records = records.where(F.col("day") >= F.lit(since))
    return decode_bars(records, "value", arrival="file_time")


def empty_scan(spark: SparkSession) -> DataFrame:
    """What :func:`scan_archive` gives of an archive without records."""
    none = "ingest_ts timestamp, value string, reject_reason string, file_path string, file_time timestamp"
    return spark.createDataFrame([], f"{BAR_SCHEMA_TEXT}, {none}")


def _below(path: str, folders: Sequence[str] | None) -> list[str]:
    return [path] if folders is None else [f"{path}/{name}" for name in folders]
