"""Shared helpers of the tests: session options, oracle comparison, bar literals."""

from __future__ import annotations

import datetime as dt
import os

import duckdb
from pyspark.sql import DataFrame, SparkSession

from tickloom.schema import BAR_SCHEMA

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def make_session(scratch: str, cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tickloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.isdir(path):
            path += "/*.parquet"
        if os.path.exists(f"{sf_dir}/{table}.parquet"):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return db


def key(row: tuple) -> tuple:
    return tuple((value is None, "" if value is None else repr(value)) for value in row)


def compare(frame: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both have the same columns and the same bag of rows, else why not."""
    expected = db.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    want = sorted(expected.fetchall(), key=key)
    got = sorted((tuple(r) for r in frame.select(*names).collect()), key=key)
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for g, w in zip(got, want):
        if key(g) != key(w):
            return f"row {g} != {w}"
    return None


def compare_files(frame: DataFrame, db: duckdb.DuckDBPyConnection, sql: str, path: str) -> str | None:
    """Like :func:`compare` for results too large to collect: through Parquet files."""
    frame.write.parquet(path)
    names = ", ".join(f'"{name}"' for name in sorted(frame.columns))
    got = f"SELECT {names} FROM read_parquet('{path}/**/*.parquet', hive_partitioning = false)"
    db.execute(f"CREATE OR REPLACE TEMP TABLE want AS SELECT {names} FROM ({sql})")
    db.execute(f"CREATE OR REPLACE TEMP TABLE got AS {got}")
    counts = db.execute("SELECT (SELECT count(*) FROM got), (SELECT count(*) FROM want)").fetchone()
    extra = db.execute("SELECT * FROM got EXCEPT ALL SELECT * FROM want LIMIT 1").fetchall()
    if counts[0] != counts[1] or extra:
        return f"{counts[0]} rows, expected {counts[1]}; not expected: {extra}"
    return None


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def make_bars(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Bars from ``(stock, iso date, close)`` or from all seven values."""
    full = []
    for stock, date, *values in rows:
        values = values if len(values) == 5 else [values[0]] * 4 + [1.0]
        full.append((stock, None if date is None else at(date), *values))
    return spark.createDataFrame(full, BAR_SCHEMA)
