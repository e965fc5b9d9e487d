"""Where batch results go: one dataset per result and run, or a document store."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def result_path(path: str, name: str, run_id: str) -> str:
    return f"{path.rstrip('/')}/{name}/run_id={run_id}"


def write_results(
    results: Mapping[str, DataFrame], path: str, run_id: str, fmt: str = "parquet"
) -> None:
    """Write each result to its own dataset. A repeated run replaces its own rows."""
    for name, frame in results.items():
        frame.write.format(fmt).mode("overwrite").save(result_path(path, name, run_id))


def read_result(
    spark: SparkSession, path: str, name: str, run_id: str, fmt: str = "parquet"
) -> DataFrame:
    return spark.read.format(fmt).load(result_path(path, name, run_id))


def append_documents(frame: DataFrame, fmt: str, **options: str) -> None:
    """Append rows as documents through any installed connector.

    Connection and credentials are options. An append repeats rows when repeated;
    give the connector a key of the result, if it takes one, to make it an upsert.
    """
    frame.write.format(fmt).options(**options).mode("append").save()
