"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def pin_runtime(spark: SparkSession) -> SparkSession:
    """Set the run-time options results depend on: a UTC calendar, adaptive plans."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def cluster_settings(input_bytes: int, cores: int, waves: int = 1) -> dict[str, str]:
    """Options for a job over ``input_bytes`` on ``cores`` executor cores.

    Shuffle partitions aim at 256 MB of input each and at no less than ``waves`` of
    tasks; adaptive execution merges small ones. State of streams is in RocksDB, where
    executor disk bounds it, whatever the input: a stream keeps its store for good.
    """
    piece = 128 << 20
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(piece),
        "spark.sql.files.maxPartitionBytes": str(2 * piece),
    }
    by_size = -(-input_bytes // (2 * piece))
    return {
        **settings,
        "spark.sql.shuffle.partitions": str(max(waves * cores, by_size)),
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    A checkpoint folder set by other means counts too. Only a local session may go
    without either; it then gets a folder of its own. On a cluster a machine-local
    folder would lose data with its machine, so having none is an error there.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="tickloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`shared_dir` for one run's tables."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`run_dir` that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
