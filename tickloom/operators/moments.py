"""Per-stock summaries from mergeable moments of stock and day."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.scalar import calendar_day
from tickloom.operators.clean import distinct_bars
from tickloom.operators.decode import accepted
from tickloom.schema import VALUE_FIELDS
from tickloom.sinks.archive import batch_days, replace_partitions, scan_with_tail, spread_by_day
from tickloom.sources.folders import Manifest, batch_folders


def day_moments(bars: DataFrame) -> DataFrame:
    """Per stock and day: counts and sums, mean and squared deviations of the close, extremes."""
    sums = [F.sum(name).alias(f"sum_{name}") for name in VALUE_FIELDS]
    counts = [F.count(name).alias(f"n_{name}") for name in VALUE_FIELDS]
    return bars.groupBy("stock", calendar_day("date").alias("day")).agg(
        *counts,
        *sums,
        F.avg("close").alias("mean_close"),
        (F.var_pop("close") * F.count("close")).alias("off_close"),
        F.max("high").alias("historical_high"),
        F.min("low").alias("historical_low"),
    )


def _joined(left: Column, right: Column) -> Column:
    """Two sets of values as one, by their number, mean and sum of squared deviations.

    The deviation of the means enters by itself (Chan et al.): nothing large is
    subtracted from anything large.
    """
    n = left["n"] + right["n"]
    apart = right["mean"] - left["mean"]
    share = right["n"] / F.when(n > 0, n)
    both = F.struct(
        n.alias("n"),
        (left["mean"] + apart * share).alias("mean"),
        (left["off"] + right["off"] + apart * apart * left["n"] * share).alias("off"),
    )
    return F.when(right["n"] == 0, left).when(left["n"] == 0, right).otherwise(both)


def merged_summary(moments: DataFrame) -> DataFrame:
    """What :func:`tickloom.operators.stats.stock_summary` gives, from moments of days.

    A stock has one row a day, so what is gathered per stock is short whatever the
    number of bars; days are joined in their order, so reruns agree to the last bit.
    """
    close = F.struct(
        "day", F.col("n_close").cast("double").alias("n"), F.coalesce("mean_close", F.lit(0.0)).alias("mean"), F.coalesce("off_close", F.lit(0.0)).alias("off")
    )
    nothing = F.struct(*(F.lit(0.0).alias(name) for name in ("n", "mean", "off")))
    days = F.transform(F.array_sort(F.collect_list(close)), lambda d: F.struct(d["n"].alias("n"), d["mean"].alias("mean"), d["off"].alias("off")))
    together = moments.groupBy("stock").agg(
        *(F.try_divide(F.sum(f"sum_{name}"), F.sum(f"n_{name}")).alias(f"avg_{name}") for name in VALUE_FIELDS),
        F.reduce(days, nothing, _joined).alias("close"),
        F.max("historical_high").alias("historical_high"),
        F.min("historical_low").alias("historical_low"),
    )
    spread = F.when(F.col("close.n") > 1, F.sqrt(F.col("close.off") / (F.col("close.n") - 1)))
    return together.select(
        "stock", *(f"avg_{name}" for name in VALUE_FIELDS), spread.alias("std_dev_close"), "historical_high", "historical_low"
    )


def update_summary(spark: SparkSession, archive: str, store: str, kept: str) -> DataFrame:
    """The summary of an archive's distinct bars, reading only days that have changed.

    ``archive`` and ``store`` are those of :func:`tickloom.sinks.archive.compact_tail`;
    the store may be empty. Moments are kept below ``kept``, by day, under a manifest
    that notes what each day was computed from: its compacted version and the batches
    beside it. A day of which these have changed is read whole and computed again.
    """
    compacted, manifest = Manifest.newest(spark, store), Manifest.newest(spark, kept)
    present = batch_folders(spark, archive)
    made_from = {}
    for day in sorted({*compacted.days, *present}):
        taken = set(compacted.taken.get(day, []))
        parts = [compacted.days.get(day, ""), *(f for f in present.get(day, []) if f not in taken)]
        made_from[day] = [hashlib.sha256(json.dumps(parts).encode()).hexdigest()]
    changed = [day for day, parts in made_from.items() if manifest.taken.get(day) != parts]
    if changed:
        bars = accepted(scan_with_tail(spark, archive, store, changed, compacted))
        version = f"data-{manifest.version + 1:012d}-{uuid.uuid4().hex[:8]}"
        replace_partitions(spread_by_day(day_moments(distinct_bars(bars))), f"{kept}/{version}", "parquet", None)
        found = batch_days(spark, f"{kept}/{version}")
        days = {day: at for day, at in manifest.days.items() if day in made_from and day not in changed}
        manifest = Manifest(manifest.version + 1, days | {day: version for day in changed if day in found}, made_from)
        manifest.publish(spark, kept)
    schema = day_moments(spark.createDataFrame([], "stock string, date timestamp, open double, high double, low double, close double, volume double")).schema
    folders = manifest.folders(kept)
    if not folders:
        return merged_summary(spark.createDataFrame([], schema))
    return merged_summary(spark.read.schema(schema).option("recursiveFileLookup", "false").parquet(*folders))
