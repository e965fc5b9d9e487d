"""The batch layer: archive in; summary, returns, daily prices, breadth, groups out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.clean import settle_revisions
from tickloom.operators.cluster import Clustering, cluster_stocks
from tickloom.operators.decode import accepted, rejected
from tickloom.operators.returns import in_pieces, return_series, returns_of_pieces
from tickloom.operators.stats import daily_prices, market_breadth, stock_summary
from tickloom.schema import BAR_FIELDS, VALUE_FIELDS
from tickloom.session import remove_dir, run_dir
from tickloom.sinks.results import result_path
from tickloom.sources.archive import scan_archive


def run_batch_layer(
    spark: SparkSession,
    archive: str,
    target: str,
    run_id: str,
    whole_files: bool = False,
    k: int = 3,
    fmt: str = "parquet",
    compacted: bool = False,
) -> Clustering:
    """Read the archive, analyse it and write every result below ``target``.

    Decoded records, distinct bars and settled bars are each written once to the
    shared folder, as Parquet, and later steps read only the columns they need from
    there: the JSON is parsed a single time, and a written table outlives executors.
    Breadth and groups likewise start from the written daily prices and summary. At the
    end these tables go; after a failure they stay for inspection.

    The summary takes every distinct bar, re-sent revisions among them; what depends
    on the order of bars takes settled ones, one per instant, stored in ranges of stock and date.
    """
    kept = run_dir(spark, "batch")
    decoded = stored(without_good_text(scan_archive(spark, archive, whole_files, compacted=compacted)), f"{kept}/decoded")
    # A bar's copies count as ingested when the last of them was.
    ingested = F.max("ingest_ts").alias("ingest_ts")
    distinct = accepted(decoded, "ingest_ts").groupBy(*BAR_FIELDS).agg(ingested)
    bars = stored(distinct, f"{kept}/bars")
    # Bars ingested at one instant come in an arbitrary order, but the same in every run.
    ranked = bars.withColumn("tie", F.xxhash64(*VALUE_FIELDS))
    settled = stored(in_pieces(settle_revisions(ranked, ["ingest_ts", "tie"])), f"{kept}/settled")

    def result(name: str, frame: DataFrame) -> DataFrame:
        return stored(frame, result_path(target, name, run_id), fmt)

    summary = result("stock_summary", stock_summary(bars))
    result("return_series", return_series(returns_of_pieces(settled, f"{kept}/borders")))
    daily = result("daily_prices", daily_prices(settled))
    result("market_breadth", market_breadth(daily))
    groups = cluster_stocks(summary, k=k)
    result("clusters", groups.labels)
    result("rejects", rejected(decoded, "value", "file_path"))
    remove_dir(spark, kept)
    return groups


def without_good_text(decoded: DataFrame) -> DataFrame:
    """Decoded records, the raw text kept only where it could not be read."""
    refused = F.when(F.col("reject_reason").isNotNull(), F.col("value"))
    return decoded.withColumn("value", refused).select(
        *BAR_FIELDS, "ingest_ts", "value", "reject_reason", "file_path"
    )


def stored(frame: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write a frame, replacing an earlier run's, and go on from the written copy."""
    frame.write.format(fmt).mode("overwrite").save(path)
    return frame.sparkSession.read.schema(frame.schema).format(fmt).load(path)
