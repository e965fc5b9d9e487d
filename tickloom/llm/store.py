"""Intermediate tables of a run: written below the shared folder, read by all executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.session import run_dir


def written(spark: SparkSession, frame: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """``frame`` as a written table: its rows survive lost executors, its plan ends here.

    With ``by`` rows are filed by that column, and a filter on it picks whole files.
    """
    path = run_dir(spark, label)
    writer = frame.write.partitionBy(by) if by else frame.write
    writer.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def removed(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables made by :func:`written` that nothing reads any more."""
    for table in tables:
        for file in table.inputFiles()[:1]:
            folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def small_batches(spark: SparkSession, rows: int = 1000) -> SparkSession:
    """Hand tasks so many rows at a time: texts are long, and a batch is held in memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return spark
