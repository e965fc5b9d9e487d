"""What the sinks of the speed layer were handed, against what they hold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.decode import accepted, rejected
from tickloom.operators.encode import bar_lines, to_archive
from tickloom.sinks.archive import replace_partitions
from tickloom.sinks.points import settle_points
from tickloom.streaming.live import run_of

# The sinks, and the columns whose values tell their rows apart.
SINKS = {"points": ["value"], "archive": ["value"], "rejects": ["value", "reject_reason"]}
_DELIVERIES = "sink string, rows bigint, checksum decimal(38,0), run string, batch_id bigint"


def tally(columns: list[str]) -> list[Column]:
    """Count and checksum of rows. A sum of hashes: no order, no partitioning enters it."""
    checksum = F.sum(F.xxhash64(*columns).cast("decimal(20,0)")).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(checksum, F.lit(0).cast("decimal(38,0)")).alias("checksum")]


def write_deliveries(batch: DataFrame, path: str, batch_id: int, order: list[str]) -> None:
    """File, per batch, what every sink is due to hold of it, and what it has read.

    Worked out from the batch itself, apart from the writers it is to check.
    """
    good = accepted(batch, *order)
    due = {
        "points": bar_lines(settle_points(good, order)).withColumnRenamed("line", "value"),
        "archive": to_archive(good.drop("offset")).select("value"),
        "rejects": rejected(batch),
    }
    counted = [due[sink].agg(*tally(columns)).withColumn("sink", F.lit(sink)) for sink, columns in SINKS.items()]
    read = batch.agg(F.count(F.lit(1)).alias("rows"), F.lit(0).cast("decimal(38,0)").alias("checksum"))
    rows = reduce(DataFrame.unionByName, [*counted, read.withColumn("sink", F.lit("read"))])
    replace_partitions(rows.coalesce(1), path, "parquet", (batch_id, run_of(batch)), by=())


def audit_deliveries(spark: SparkSession, target: str) -> DataFrame:
    """The batches below ``target`` of which a sink does not hold what it was handed.

    Returns run, batch_id, sink, rows_due, rows_held and whether their ``contents`` agree;
    a batch that read more or less than it accepted and refused is listed under the sink
    ``read``. No row means that everything read was delivered once.
    """
    due = spark.read.schema(_DELIVERIES).parquet(f"{target}/deliveries")
    held = []
    for sink, columns in SINKS.items():
        if sink == "rejects":
            kind = "value string, reject_reason string, run string, batch_id bigint"
            rows = _or_empty(spark, f"{target}/{sink}", "parquet", kind)
        else:
            rows = _or_empty(spark, f"{target}/{sink}", "text", "value string, day date, run string, batch_id bigint")
        held.append(rows.groupBy("run", "batch_id").agg(*tally(columns)).withColumn("sink", F.lit(sink)))
    held = reduce(DataFrame.unionByName, held)
    kept = F.when(F.col("sink").isin("archive", "rejects"), F.col("rows")).otherwise(0)
    whole = due.where("sink != 'read'").groupBy("run", "batch_id").agg(F.sum(kept).alias("rows"))
    whole = whole.withColumns({"checksum": F.lit(0).cast("decimal(38,0)"), "sink": F.lit("read")})
    both = due.alias("d").join(held.unionByName(whole).alias("h"), ["run", "batch_id", "sink"], "full_outer")
    zero = F.lit(0)
    due_rows, held_rows = (F.coalesce(F.col(f"{side}.rows"), zero) for side in "dh")
    contents = F.coalesce(F.col("d.checksum"), zero) == F.coalesce(F.col("h.checksum"), zero)
    return both.where((due_rows != held_rows) | ~contents).select(
        "run", "batch_id", "sink", due_rows.alias("rows_due"), held_rows.alias("rows_held"), contents.alias("contents")
    )


def _or_empty(spark: SparkSession, path: str, fmt: str, schema: str) -> DataFrame:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(path)
