"""Tables whose replacements become visible whole: a folder for each write, and a list of folders switched last.

``<table>/data/version=<id>`` has the rows of one write, below it one folder for each day of a table partitioned by date.
``<table>/published`` has one small file for each publication, named by its number: for each day the version that holds
it. A reader takes the file of the highest number. Files are never changed after they are written, so a reader that has
started goes on with one whole version, and a write that fails, or is not published, changes nothing.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlight.operators.sinks import file_system, laid_out

NO_DAY = "__HIVE_DEFAULT_PARTITION__"


class Conflict(RuntimeError):
    """Another publication took the same number."""


@dataclass(frozen=True)
class Entry:
    """A day of a table (None: the null day, or all of a table without days), the version that holds it, and the last
    batch of a stream that went into it."""

    version: str
    day: str | None
    upto: int | None = None


@dataclass(frozen=True)
class Version:
    """The days of a table, published (``number`` is set) or not yet."""

    path: str
    entries: tuple[Entry, ...]
    schema: str
    partition: str | None
    number: int | None = None

    def folders(self) -> list[str]:
        def folder(e: Entry) -> str:
            day = "" if self.partition is None else f"/{self.partition}={NO_DAY if e.day is None else e.day}"
            return f"{self.path}/data/version={e.version}{day}"

        return [folder(e) for e in self.entries]

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows of the version; the list of folders has one for each day."""
        folders = self.folders()
        if not folders:
            return spark.createDataFrame([], self.schema)
        frame = spark.read.schema(f"{self.schema}, version string").option("basePath", f"{self.path}/data").parquet(*folders)
        return frame.drop("version")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _file(path: str, number: int) -> str:
    return f"{path}/published/{number:012d}.json"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    folder, system = file_system(spark, f"{path}/published")
    if not system.exists(folder):
        return []
    names = [s.getPath().getName() for s in system.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def published(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The version a reader sees: the one published last, or an earlier one by its number."""
    if number is None:
        number = max(_numbers(spark, path), default=0)
    target, system = file_system(spark, _file(path, number))
    if not system.exists(target):
        return None
    stream = system.open(target)
    try:
        found = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Version(path, tuple(Entry(*e) for e in found["entries"]), found["schema"], found["partition"], number)


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    version = published(spark, path, number)
    if version is None:
        raise ValueError(f"nothing is published at {path}")
    return version.read(spark)


def write(
    df: DataFrame, path: str, partition: str | None = None, cluster: tuple[str, ...] = (), since: date | None = None, upto: int | None = None
) -> Version:
    """Write rows aside, as a version that nobody sees until ``publish``.

    With ``since``, ``df`` replaces the days from there on, and the older days of the published version are kept
    without being copied; so are, with ``upto``, all days that ``df`` doesn't have.
    """
    spark, name = df.sparkSession, uuid.uuid4().hex[:16]
    folder, schema = f"{path}/data/version={name}", _ddl(df)
    if partition is None:
        df.write.parquet(folder)
        return Version(path, (Entry(name, None),), schema, None)
    if since is not None:
        df = df.where(F.col(partition) >= F.lit(since))
    laid_out(df, partition, cluster).write.partitionBy(partition).parquet(folder)
    target, system = file_system(spark, folder)
    days = [s.getPath().getName().partition("=")[2] for s in system.listStatus(target) if s.isDirectory()]
    entries = [Entry(name, None if d == NO_DAY else d, upto) for d in sorted(days)]
    if since is not None or upto is not None:
        before = published(spark, path)
        new = {e.day for e in entries}
        kept = [e for e in (before.entries if before else ()) if e.day not in new]
        if since is not None:
            kept = [e for e in kept if e.day is None or e.day < since.isoformat()]
        entries = kept + entries
    return Version(path, tuple(entries), schema, partition)


def publish(spark: SparkSession, version: Version) -> Version:
    """Make a version the one that readers see: one small file, written aside and renamed.

    Of two publications at once one gets the number; the other is told and may try again on top of it.
    """
    number = max(_numbers(spark, version.path), default=0) + 1
    content = {"partition": version.partition, "schema": version.schema, "entries": [[e.version, e.day, e.upto] for e in version.entries]}
    aside, system = file_system(spark, f"{version.path}/published/.{uuid.uuid4().hex}")
    stream = system.create(aside, False)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    target, _ = file_system(spark, _file(version.path, number))
    if system.exists(target) or not system.rename(aside, target):
        system.delete(aside, False)
        raise Conflict(f"another publication of {version.path} has number {number}")
    return Version(version.path, version.entries, version.schema, version.partition, number)


def replace(df: DataFrame, path: str, partition: str | None = None, cluster: tuple[str, ...] = (), since: date | None = None) -> Version:
    """Write and publish at once."""
    return publish(df.sparkSession, write(df, path, partition, cluster, since))


def delete(spark: SparkSession, folder: str) -> None:
    """Remove a folder of the table's own file system."""
    target, system = file_system(spark, folder)
    system.delete(target, True)


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove the versions that none of the last ``keep`` publications uses, those never published among them.

    To be run when nothing is being written; a reader needs its version to be among the kept ones.
    """
    numbers = _numbers(spark, path)
    if not numbers:
        return []
    used = {e.version for n in numbers[-keep:] for e in published(spark, path, n).entries}
    data, system = file_system(spark, f"{path}/data")
    names = [s.getPath().getName().partition("=")[2] for s in system.listStatus(data) if s.isDirectory()]
    unused = sorted(n for n in names if n not in used)
    for n in unused:
        delete(spark, f"{path}/data/version={n}")
    return unused
