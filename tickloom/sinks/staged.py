"""Lines written by tasks, published by the driver: a two-step commit of batches.

Tasks stage their rows under names nobody reads and hand the names back; the driver
publishes a batch by one file that lists them. A task that fails and runs again stages
anew, a batch that is repeated is published again in place of its first try, and what
no list names does not exist for readers.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)

# Writers travel with the job: executors need pyarrow, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Staged(WriterCommitMessage):
    """What a task has staged: the name of its file, and how many lines are in it."""

    name: str
    lines: int


def _files(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of ``folder``, any that Arrow knows, and the path in it."""
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def staged_sink(
    name: str = "staged_lines", lines_per_write: int = 5000, before_write: Callable[[int], None] | None = None
) -> type[DataSource]:
    """A Spark data source that writes a frame with a ``line`` column, all of it or nothing.

    Register it with ``spark.dataSource.register(staged_sink())``, write to
    ``format(name)`` with an option ``path``, a folder all executors share, in batch or
    as a stream; read with :func:`published_lines`. A batch write counts as a batch
    under a name of its own and adds to what is there; a stream's batches go by their
    number under the option ``run``. ``before_write`` is called with the task's
    partition ahead of its first write, for tests that make a task fail.
    """

    def stage(folder: str, batches: Iterator[pa.RecordBatch]) -> Staged:
        files, root = _files(folder)
        files.create_dir(f"{root}/staged", recursive=True)
        task, lines = TaskContext.get().partitionId(), 0
        made = f"{task:06d}-{uuid.uuid4().hex}.lines"
        with files.open_output_stream(f"{root}/staged/{made}") as out:
            for batch in batches:
                column = batch.column(batch.schema.get_field_index("line")).drop_null()
                for start in range(0, len(column), lines_per_write):
                    part = column.slice(start, lines_per_write).to_pylist()
                    out.write(("\n".join(part) + "\n").encode())
                    lines += len(part)
                if before_write is not None:
                    before_write(task)
        return Staged(made, lines)

    def publish(folder: str, batch: str, messages: list) -> None:
        files, root = _files(folder)
        files.create_dir(f"{root}/batches", recursive=True)
        target = f"{root}/batches/{batch}.json"
        earlier = _listed(files, target)
        found = [{"file": m.name, "lines": m.lines} for m in messages if m is not None]
        draft = f"{root}/batches/.{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as out:
            out.write("".join(json.dumps(x) + "\n" for x in found).encode())
        files.move(draft, target)  # replaces the list of an earlier try
        _drop(files, root, [x["file"] for x in earlier])

    def withdraw(folder: str, messages: list) -> None:
        files, root = _files(folder)
        _drop(files, root, [m.name for m in messages if m is not None])

    class Options:
        def __init__(self, options: dict[str, str]) -> None:
            self.folder = options["path"].rstrip("/")
            self.run = options.get("run") or "stream"

        def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
            return stage(self.folder, iterator)

    class BatchWriter(Options, DataSourceArrowWriter):
        def commit(self, messages: list) -> None:
            publish(self.folder, f"once-{uuid.uuid4().hex}", messages)

        def abort(self, messages: list) -> None:
            withdraw(self.folder, messages)

    class StreamWriter(Options, DataSourceStreamArrowWriter):
        def commit(self, messages: list, batchId: int) -> None:
            publish(self.folder, f"{self.run}-{batchId:012d}", messages)

        def abort(self, messages: list, batchId: int) -> None:
            withdraw(self.folder, messages)

    class StagedSink(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite: bool) -> BatchWriter:
            return BatchWriter(self.options)

        def streamWriter(self, schema, overwrite: bool) -> StreamWriter:
            return StreamWriter(self.options)

    return StagedSink


def _listed(files: pafs.FileSystem, path: str) -> list[dict]:
    if files.get_file_info(path).type == pafs.FileType.NotFound:
        return []
    with files.open_input_stream(path) as lines:
        return [json.loads(line) for line in lines.read().decode().splitlines()]


def _drop(files: pafs.FileSystem, root: str, names: list[str]) -> None:
    for staged in names:
        path = f"{root}/staged/{staged}"
        if files.get_file_info(path).type != pafs.FileType.NotFound:
            files.delete_file(path)


def published_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of all published batches below ``folder``, as ``batch`` and ``line``.

    The lists are read as a table and joined with the staged files by name: nothing of
    a try that was not published comes through.
    """
    schema = "file string, lines bigint"
    lists = spark.read.schema(schema).json(f"{folder}/batches")
    batch = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1)
    lists = lists.select("file", batch.alias("batch"))
    staged = spark.read.text(f"{folder}/staged").select(
        F.col("_metadata.file_name").alias("file"), F.col("value").alias("line")
    )
    return staged.join(lists, "file").select("batch", "line")
