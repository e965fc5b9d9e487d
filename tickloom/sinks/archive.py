"""The bar archive: JSON text filed by day and batch, and its compacted form."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.scalar import calendar_day
from tickloom.operators.clean import distinct_bars
from tickloom.operators.decode import accepted
from tickloom.operators.encode import to_archive
from tickloom.schema import BAR_FIELDS
from tickloom.sources.archive import empty_scan, scan_archive
from tickloom.sources.folders import Manifest, batch_folders, remove


#: The run of batches that are numbered by hand.
MANUAL = "manual"


def filed_under(batch_id: int | None, run: str | None) -> tuple[int, str]:
    """Batch number and run of a write; without a number the write is a run of its own."""
    if batch_id is None:
        return 0, run or f"once-{uuid.uuid4().hex}"
    return batch_id, run or MANUAL


def replace_partitions(
    rows: DataFrame, path: str, fmt: str, batch: tuple[int, str] | None, by: tuple[str, ...] = ("day",)
) -> None:
    """Write ``rows`` below folders ``by`` (and run and batch), replacing those folders.

    A batch that is run again after a failure writes the same folders and so leaves
    one copy. Batch numbers start anew with every checkpoint; the run tells them apart,
    so nothing but a batch's own earlier try is replaced. Only folders that get rows
    are touched.
    """
    if batch is not None:
        batch_id, run = batch
        rows = rows.withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id).cast("bigint")})
        by = (*by, "run", "batch_id")
    (
        rows.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .save(path)
    )


def spread_by_day(rows: DataFrame) -> DataFrame:
    """Bring rows of a day together ahead of a write, in pieces of even size.

    A rebalance, not a repartition: adaptive execution cuts a day that is too large
    for one task and joins small ones. Without it every task writes a file per day.
    """
    return rows.hint("rebalance", "day")


def write_archive(
    bars: DataFrame,
    path: str,
    batch_id: int | None = None,
    spread: bool = False,
    run: str | None = None,
) -> None:
    """Append bars to the archive, a JSON line each; numbered batches idempotently.

    Without ``batch_id`` every call adds its bars. With one, a repeated call replaces
    what the same batch of the same ``run`` wrote.

    ``spread`` is for large batch jobs that cover many days. A micro-batch covers
    one or two and should write straight from its tasks.
    """
    rows = to_archive(bars)
    replace_partitions(spread_by_day(rows) if spread else rows, path, "text", filed_under(batch_id, run))


def compact_archive(spark: SparkSession, path: str, target: str) -> None:
    """Rewrite the readable records of an archive as Parquet, filed by day.

    Exact copies are dropped; revisions stay, with their ingest time. Run it from
    time to time: streaming leaves many small files behind. Files are ordered by
    stock and time, so their statistics let later scans skip most of them.
    """
    bars = accepted(scan_archive(spark, path), "ingest_ts")
    rows = distinct_bars(bars).withColumn("day", calendar_day("date"))
    ordered = spread_by_day(rows).sortWithinPartitions("day", "stock", "date")
    replace_partitions(ordered, target, "parquet", None)


def compact_tail(spark: SparkSession, archive: str, store: str) -> Manifest:
    """Take the batches that came since the last time into the compacted ``store``.

    Only days with new batches are read and written again, as Parquet in a version of
    their own, ordered by stock and time; of copies of a bar one stays, with the latest
    ingest time. A manifest, published by one rename when the data are there, names for
    every day its version and the batch folders it holds: a run that breaks off leaves
    nothing that readers see. One run at a time; a second one is refused. Batch folders
    stay until :func:`clean_archive`; a batch that is repeated after it was taken in
    writes what it wrote before.
    """
    manifest = Manifest.newest(spark, store)
    present = batch_folders(spark, archive)
    fresh = {day: [f for f in names if f not in set(manifest.taken.get(day, []))] for day, names in present.items()}
    fresh = {day: names for day, names in fresh.items() if names}
    if not fresh:
        return manifest
    tail = scan_archive(spark, archive, folders=[f for names in fresh.values() for f in names])
    bars = accepted(tail, "ingest_ts").unionByName(accepted(_compacted(spark, manifest, store, list(fresh)), "ingest_ts"))
    rows = bars.groupBy(*BAR_FIELDS).agg(F.max("ingest_ts").alias("ingest_ts")).withColumn("day", calendar_day("date"))
    version = f"data-{manifest.version + 1:012d}-{uuid.uuid4().hex[:8]}"
    ordered = spread_by_day(rows).sortWithinPartitions("day", "stock", "date")
    replace_partitions(ordered, f"{store}/{version}", "parquet", None)
    # Batches are filed by their bars' day; one with dead letters only leaves no data.
    written = batch_days(spark, f"{store}/{version}")
    days = manifest.days | {day: version for day in fresh if day in written}
    taken = {day: names for day, names in present.items()}
    new = Manifest(manifest.version + 1, days, taken)
    new.publish(spark, store)
    return new


def batch_days(spark: SparkSession, path: str) -> set[str]:
    """The days that ``path`` has folders for."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = (status.getPath().getName() for status in listed)
    return {name.removeprefix("day=") for name in names if name.startswith("day=")}


def _compacted(spark: SparkSession, manifest: Manifest, store: str, days: list[str] | None) -> DataFrame:
    folders = manifest.folders(store, days)
    if not folders:
        return empty_scan(spark)
    return scan_archive(spark, store, compacted=True, folders=[f.removeprefix(f"{store}/") for f in folders])


def scan_with_tail(
    spark: SparkSession, archive: str, store: str, days: list[str] | None = None, manifest: Manifest | None = None
) -> DataFrame:
    """What :func:`scan_archive` gives, from ``store`` and the batches it does not hold yet.

    ``days`` (ISO dates) restricts the scan to their folders. A bar that was compacted
    and sent again since is in both parts: take distinct bars, as of any archive.
    """
    manifest = manifest or Manifest.newest(spark, store)
    rest = []
    for day, names in batch_folders(spark, archive).items():
        if days is None or day in days:
            rest += [f for f in names if f not in set(manifest.taken.get(day, []))]
    found = _compacted(spark, manifest, store, days)
    if not rest:
        return found
    tail = scan_archive(spark, archive, folders=rest)
    return found.unionByName(tail.select(*found.columns))


def clean_archive(spark: SparkSession, archive: str, store: str) -> None:
    """Delete the batch folders that ``store`` holds, and its superseded versions.

    To be called when no reader is left that began before the last compaction.
    """
    manifest = Manifest.newest(spark, store)
    for names in manifest.taken.values():
        for name in names:
            remove(spark, f"{archive}/{name}")
    manifest.clean(spark, store)
