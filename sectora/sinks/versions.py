"""Sets of tables that change together.

A set lives in one folder: ``data/<id>/<table>`` holds Parquet, ``log/<version>.json`` says which data folder each table has in a
version. A commit writes new data first and then moves one small file into the log under the next number. That move is
the only step that readers see, and it fails if the number is taken, so

* readers find the old version whole until the new one is whole, whatever fails between two tables;
* of two writers that read the same version only one can commit; the other gets a :class:`Conflict`;
* the table never ceases to exist, unlike with two renames.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


class Conflict(RuntimeError):
    """Another writer committed the version after the one that was read."""


@dataclass(frozen=True)
class Version:
    number: int
    paths: dict[str, str]


class Files:
    """The few file operations of the session's Hadoop file systems that the engine needs."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.gateway, self.conf = spark._jvm, spark.sparkContext._gateway, spark._jsc.hadoopConfiguration()

    def path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def system(self, path: str):
        return self.path(path).getFileSystem(self.conf)

    def exists(self, path: str) -> bool:
        return self.system(path).exists(self.path(path))

    def names(self, folder: str) -> list[str]:
        return [s.getPath().getName() for s in self.system(folder).listStatus(self.path(folder))] if self.exists(folder) else []

    def delete(self, path: str) -> None:
        self.system(path).delete(self.path(path), True)

    def read(self, path: str) -> str:
        stream = self.system(path).open(self.path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write a small file so that it appears whole or not at all; False if the name is taken."""
        folder, name = path.rsplit("/", 1)
        staged = f"{folder}/.{name}-{uuid.uuid4().hex}"
        stream = self.system(path).create(self.path(staged), False)
        stream.write(text.encode())
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.system(path).getUri(), self.conf)
        try:
            context.rename(self.path(staged), self.path(path), self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
            return True
        except Exception as exc:
            if "FileAlreadyExists" not in str(exc):
                raise
            self.delete(staged)
            return False


def _entry(base: str, number: int) -> str:
    return f"{base}/log/{number:010d}.json"


def numbers(spark: SparkSession, base: str) -> list[int]:
    """The versions of a set, oldest first."""
    return sorted(int(n[:-5]) for n in Files(spark).names(f"{base.rstrip('/')}/log") if n.endswith(".json") and n[:-5].isdigit())


def current(spark: SparkSession, base: str) -> Version:
    """The newest version; number 0 without tables if there is none."""
    base = base.rstrip("/")
    found = numbers(spark, base)
    return Version(found[-1], json.loads(Files(spark).read(_entry(base, found[-1])))["tables"]) if found else Version(0, {})


def read(spark: SparkSession, base: str, version: Version | None = None) -> dict[str, DataFrame]:
    """The tables of a version, the newest by default."""
    version = version or current(spark, base)
    return {name: spark.read.parquet(path) for name, path in version.paths.items()}


def stage(df: DataFrame, base: str, name: str) -> str:
    """Write one table's data for a commit to come; nobody reads it before."""
    path = f"{base.rstrip('/')}/data/{uuid.uuid4().hex}/{name}"
    df.write.mode("errorifexists").option("compression", "snappy").parquet(path)
    return path


def commit(spark: SparkSession, base: str, read_version: Version, staged: dict[str, str]) -> Version:
    """Make staged tables the next version; tables that aren't staged keep their data. Raises :class:`Conflict` if another
    writer committed after ``read_version``."""
    base = base.rstrip("/")
    new = Version(read_version.number + 1, read_version.paths | staged)
    if not Files(spark).create(_entry(base, new.number), json.dumps({"tables": new.paths})):
        raise Conflict(f"{base}: version {new.number} was committed by another writer")
    return new


def expire(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Delete the data that only versions older than the newest ``keep`` use; returns the folders."""
    base, files = base.rstrip("/"), Files(spark)
    found = numbers(spark, base)
    kept = {p for n in found[-keep:] for p in json.loads(files.read(_entry(base, n)))["tables"].values()}
    gone = []
    for n in found[:-keep]:
        gone += [p for p in json.loads(files.read(_entry(base, n)))["tables"].values() if p not in kept and p not in gone]
        files.delete(_entry(base, n))
    for path in gone:
        files.delete(path)
    return gone
