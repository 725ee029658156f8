"""Versions of stored tables: which files make up a table now.

A table's folder holds a folder of files for each version, and ``_versions`` with small
numbered files, each describing one version. A write makes new files first and then adds
the next number; readers take the greatest. So a table is replaced in one step, a write
that fails or is killed leaves the old version in place, and who has begun to read a
version goes on reading it while the next one is written. The last ``KEEP`` versions stay.
A version may take over files of the one before: one that adds rows has them all, one that
replaces partitions those of the others.

One writer at a time may replace a table; two tables, or a writer and any number of
readers, do not disturb each other. The files are handled by Hadoop's file systems, as
Spark's own are, so a base path may be on any of them.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from subtide.operators.rows import stack

KEEP = 2
PREFIX = "v-"


@dataclass(frozen=True)
class Part:
    """Files of one write, in a folder relative to the base: all of them, or those of some
    of its partitions' folders."""

    path: str
    partitions: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Version:
    """Parts of one or more writes, with their columns. Of them the table has the rows for
    which ``where`` holds, ``rows`` of them, and the listed columns. ``buckets`` is the column
    whose hash says in which of how many files a row lies; ``origin`` the parts of the tables
    that the rows were made from."""

    parts: tuple[Part, ...]
    rows: int
    schema: T.StructType
    where: str | None = None
    columns: tuple[str, ...] | None = None
    buckets: tuple[str, int] | None = None
    origin: tuple[str, ...] = ()

    def to_json(self) -> str:
        return json.dumps({
            "parts": [[p.path, p.partitions] for p in self.parts], "rows": self.rows,
            "schema": self.schema.jsonValue(), "where": self.where, "columns": self.columns,
            "buckets": self.buckets, "origin": self.origin,
        })

    @staticmethod
    def from_json(text: str) -> Version:
        held = json.loads(text)
        parts = tuple(Part(path, some if some is None else tuple(some)) for path, some in held["parts"])
        columns = held["columns"] and tuple(held["columns"])
        buckets = tuple(held["buckets"]) if held.get("buckets") else None
        return Version(
            parts, held["rows"], T.StructType.fromJson(held["schema"]), held["where"], columns,
            buckets, tuple(held.get("origin", ())),
        )


def table_path(base: str, layer: str, name: str) -> str:
    return f"{base.rstrip('/')}/{layer}/{name}"


def new_folder(layer: str, name: str) -> str:
    """A folder for the files of a new version, relative to the base."""
    return f"{layer}/{name}/{PREFIX}{uuid.uuid4().hex}"


class _Files:
    """The few file operations needed, by Hadoop's FileSystem of the path."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return [status.getPath().getName() for status in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_whole(self, path: str, text: str) -> None:
        """The file appears with all its text or not at all; it must not exist."""
        hidden = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
        stream = self._fs.create(self._path(hidden), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self._fs.exists(self._path(path)) or not self._fs.rename(self._path(hidden), self._path(path)):
            self._fs.delete(self._path(hidden), False)
            raise RuntimeError(f"{path} was written by someone else")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def age(self, path: str) -> float:
        """Seconds since the folder was last changed."""
        return time.time() - self._fs.getFileStatus(self._path(path)).getModificationTime() / 1000


def _numbers(files: _Files, folder: str) -> list[str]:
    return sorted(n for n in files.names(f"{folder}/_versions") if n.endswith(".json") and not n.startswith("."))


def _history(files: _Files, folder: str) -> list[Version]:
    return [Version.from_json(files.read(f"{folder}/_versions/{n}")) for n in _numbers(files, folder)]


def current_version(spark: SparkSession, base: str, layer: str, name: str) -> Version | None:
    """The table's version now; None if it has never been written."""
    folder = table_path(base, layer, name)
    files = _Files(spark, folder)
    numbers = _numbers(files, folder)
    return Version.from_json(files.read(f"{folder}/_versions/{numbers[-1]}")) if numbers else None


def partitions_of(spark: SparkSession, base: str, path: str) -> tuple[str, ...]:
    """The names of the partitions' folders that a write has made."""
    folder = f"{base.rstrip('/')}/{path}"
    return tuple(sorted(n for n in _Files(spark, folder).names(folder) if "=" in n))


def publish(spark: SparkSession, base: str, layer: str, name: str, version: Version) -> None:
    """Makes the version the table, and forgets those older than the last ``KEEP``. Their
    files in the table's own folder are deleted, but for parts that a newer one has too."""
    folder = table_path(base, layer, name)
    files = _Files(spark, folder)
    numbers = _numbers(files, folder)
    following = int(numbers[-1].removesuffix(".json")) + 1 if numbers else 0
    files.write_whole(f"{folder}/_versions/{following:09d}.json", version.to_json())
    held = [Version.from_json(files.read(f"{folder}/_versions/{n}")) for n in numbers]
    old = max(0, len(numbers) + 1 - KEEP)
    wanted = {part.path for kept in [*held[old:], version] for part in kept.parts}
    for number, forgotten in zip(numbers[:old], held):
        files.delete(f"{folder}/_versions/{number}")
        for path in {part.path for part in forgotten.parts} - wanted:
            if path.startswith(f"{layer}/{name}/"):
                files.delete(f"{base.rstrip('/')}/{path}")


def catalog_name() -> str:
    """A name in the catalog for the moment in which bucketed files are written or opened."""
    return f"spark_catalog.default.subtide_{uuid.uuid4().hex}"


def _read_buckets(spark: SparkSession, folder: str, version: Version) -> DataFrame:
    """Only a table of the catalog can say that its files are bucketed. The DataFrame keeps
    that, so the table, which does not own the files, goes at once."""
    name, (key, n) = catalog_name(), version.buckets
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in version.schema)
    quoted = folder.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) INTO {n} BUCKETS LOCATION '{quoted}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def read_version(spark: SparkSession, base: str, version: Version) -> DataFrame:
    base = base.rstrip("/")
    if version.buckets:
        return _read_buckets(spark, f"{base}/{version.parts[0].path}", version)

    def read(part: Part) -> DataFrame:
        reader = spark.read.schema(version.schema)
        if part.partitions is None:
            return reader.parquet(f"{base}/{part.path}")
        return reader.option("basePath", f"{base}/{part.path}").parquet(*(f"{base}/{part.path}/{p}" for p in part.partitions))

    parts = [part for part in version.parts if part.partitions != ()]
    df = stack(list(map(read, parts))) if parts else spark.createDataFrame([], version.schema)
    if version.where:
        df = df.filter(version.where)
    return df.select(*version.columns) if version.columns else df


def remove_unpublished(spark: SparkSession, base: str, layer: str, name: str, older_than_hours: float = 24) -> list[str]:
    """Deletes the files of writes that never finished, if nothing changed in their folder
    for so long; returns their folders."""
    folder = table_path(base, layer, name)
    files = _Files(spark, folder)
    published = {part.path.rpartition("/")[2] for v in _history(files, folder) for part in v.parts}
    left = [
        n for n in files.names(folder)
        if n.startswith(PREFIX) and n not in published and files.age(f"{folder}/{n}") > older_than_hours * 3600
    ]
    for n in left:
        files.delete(f"{folder}/{n}")
    return [f"{layer}/{name}/{n}" for n in left]
