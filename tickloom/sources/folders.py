"""Folders of an archive, and manifests that say in one rename what holds what."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

#: Where a day without a value is filed.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def batch_folders(spark: SparkSession, archive: str) -> dict[str, list[str]]:
    """Per day the folders of batches, ``day=../run=../batch_id=..``, below ``archive``.

    One listing on the driver: names only, of what has not been cleaned away.
    """
    root, files = _path(spark, archive)
    if not files.exists(root):
        return {}
    base = files.makeQualified(root).toString().rstrip("/")
    found: dict[str, list[str]] = {}
    for status in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{base}/day=*/run=*/batch_id=*")) or []:
        name = status.getPath().toString()[len(base) + 1 :]
        found.setdefault(name.split("/")[0].removeprefix("day="), []).append(name)
    return {day: sorted(names) for day, names in sorted(found.items())}


def remove(spark: SparkSession, path: str) -> None:
    folder, files = _path(spark, path)
    files.delete(folder, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder; on a file system that moves names this shows all of it at once."""
    folder, files = _path(spark, path)
    if not files.rename(folder, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} could not be moved to {to}")


@dataclass
class Manifest:
    """For every day the version that holds it and the folders it was made from."""

    version: int = 0
    days: dict[str, str] = field(default_factory=dict)
    taken: dict[str, list[str]] = field(default_factory=dict)

    @classmethod
    def newest(cls, spark: SparkSession, store: str) -> Manifest:
        """The manifest published last below ``store``, an empty one if there is none."""
        folder, files = _path(spark, f"{store}/manifest")
        if not files.exists(folder):
            return cls()
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        names = sorted(n for n in names if n.startswith("v-"))
        if not names:
            return cls()
        stream = files.open(spark._jvm.org.apache.hadoop.fs.Path(folder, names[-1]))
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return cls(**json.loads(text))

    def publish(self, spark: SparkSession, store: str) -> None:
        """Make this the newest manifest, in one rename; a second one of its version is refused."""
        name, files = _path(spark, f"{store}/manifest/v-{self.version:012d}")
        draft = spark._jvm.org.apache.hadoop.fs.Path(f"{store}/manifest/.draft-{uuid.uuid4().hex}")
        stream = files.create(draft, False)
        try:
            stream.write(json.dumps({"version": self.version, "days": self.days, "taken": self.taken}).encode())
        finally:
            stream.close()
        if files.exists(name) or not files.rename(draft, name):
            files.delete(draft, False)
            raise RuntimeError(f"version {self.version} of {store} was published by another run")

    def folders(self, store: str, days: list[str] | None = None) -> list[str]:
        """The folders of data of the given days, or of all."""
        wanted = self.days if days is None else {d: self.days[d] for d in days if d in self.days}
        return [f"{store}/{version}/day={day}" for day, version in sorted(wanted.items())]

    def clean(self, spark: SparkSession, store: str) -> None:
        """Delete versions that no day refers to and manifests before this one.

        To be called when nobody reads an older version any more.
        """
        root, files = _path(spark, store)
        live = set(self.days.values())
        for status in files.listStatus(root):
            name = status.getPath().getName()
            if name.startswith("data-"):
                if name not in live:
                    files.delete(status.getPath(), True)
                    continue
                for part in files.listStatus(status.getPath()):
                    day = part.getPath().getName()
                    if day.startswith("day=") and self.days.get(day.removeprefix("day=")) != name:
                        files.delete(part.getPath(), True)
        for status in files.listStatus(_path(spark, f"{store}/manifest")[0]):
            if status.getPath().getName() < f"v-{self.version:012d}":
                files.delete(status.getPath(), False)
