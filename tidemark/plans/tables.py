"""Versioned tables on plain Parquet: a publication writes new versions, then adds one numbered commit that names them.

Readers take the highest commit, so they see the old versions or the new ones of all tables, never a mix, and nothing is
ever deleted or replaced under them. A commit's file is created only if it isn't there: of two publications that start from
the same one, the second fails and may try again. A crash before the commit leaves files that none names.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable, Mapping
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A commit without content that is older than this belongs to a publication that died.
DEAD_AFTER = 60.0


class ConflictError(RuntimeError):
    """Another publication came in between."""


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """A relation of a schema without rows, as a table is before its first publication."""
    return spark.createDataFrame([], schema)


class Files:
    """The few file operations that tables need, on any file system of Hadoop."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def at(self, path: str):
        hadoop = self.jvm.org.apache.hadoop.fs.Path(path)
        return hadoop, hadoop.getFileSystem(self.conf)

    def create(self, path: str, text: str) -> bool:
        """False if the file is there. Local files are made by the operating system, as Hadoop's local one may overwrite."""
        hadoop, fs = self.at(path)
        fs.mkdirs(hadoop.getParent())
        if fs.getScheme() == "file":
            try:
                with open(unquote(urlparse(hadoop.toUri().toString()).path), "x", encoding="utf-8") as f:
                    f.write(text)
                    f.flush()
                    os.fsync(f.fileno())
            except FileExistsError:
                return False
            return True
        try:
            out = fs.create(hadoop, False)
        except Exception as e:  # noqa: BLE001 - each file system has an exception of its own
            if fs.exists(hadoop):
                return False
            raise e
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()
        return True

    def read(self, path: str) -> str:
        hadoop, fs = self.at(path)
        stream = fs.open(hadoop)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def names(self, path: str) -> dict[str, float]:
        """Name and age in seconds of each file in a folder."""
        hadoop, fs = self.at(path)
        if not fs.exists(hadoop):
            return {}
        now = time.time()
        return {s.getPath().getName(): now - s.getModificationTime() / 1000 for s in fs.listStatus(hadoop)}

    def delete(self, path: str) -> None:
        hadoop, fs = self.at(path)
        fs.delete(hadoop, True)


class VersionedTables:
    """Several tables, name to schema, that are published together."""

    def __init__(self, spark: SparkSession, path: str, schemas: Mapping[str, str]):
        self.spark, self.path, self.schemas, self.files = spark, path.rstrip("/"), dict(schemas), Files(spark)

    def _commits(self) -> tuple[int, dict[str, str], int]:
        """The highest commit with content, its versions, and the number that the next one takes."""
        known = self.files.names(f"{self.path}/_commits")
        top = max((int(n) for n in known if n.isdigit()), default=0)
        for number in sorted((int(n) for n in known if n.isdigit()), reverse=True):
            name = f"{number:012d}"
            text = self.files.read(f"{self.path}/_commits/{name}")
            if text.endswith("\n"):
                return number, json.loads(text), top + 1
            if known[name] < DEAD_AFTER:
                top = number - 1  # being written: the number is taken
        return 0, {}, top + 1

    def current(self, name: str) -> str | None:
        return self._commits()[1].get(name)

    def _read(self, versions: Mapping[str, str], name: str) -> DataFrame:
        if name not in versions:
            return empty(self.spark, self.schemas[name])
        return self.spark.read.schema(self.schemas[name]).parquet(f"{self.path}/{versions[name]}")

    def read(self, name: str) -> DataFrame:
        return self._read(self._commits()[1], name)

    def publish(self, make: Callable[[dict[str, DataFrame]], Mapping[str, DataFrame]]) -> int:
        """Commits what make(current tables) gives, the tables that change, and returns the commit's number; nothing if none do."""
        before, versions, number = self._commits()
        changed = make({n: self._read(versions, n) for n in self.schemas})
        if not changed:
            return before
        new = dict(versions)
        for name, table in changed.items():
            new[name] = f"{name}-{uuid.uuid4().hex}"
            table.select(*self.spark.createDataFrame([], self.schemas[name]).columns).write.parquet(f"{self.path}/{new[name]}")
        began = time.monotonic()
        if not self.files.create(f"{self.path}/_commits/{number:012d}", json.dumps(new) + "\n"):
            for name in changed:
                self.files.delete(f"{self.path}/{new[name]}")
            raise ConflictError(f"{self.path} was published by another run meanwhile")
        if time.monotonic() - began > DEAD_AFTER:
            raise RuntimeError(f"{self.path}: commit {number} took too long; others may have taken it for dead")
        return number


class VersionedTable:
    """One table."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.tables = VersionedTables(spark, path, {"table": schema})

    def current(self) -> str | None:
        return self.tables.current("table")

    def read(self) -> DataFrame:
        return self.tables.read("table")

    def publish(self, make: Callable[[DataFrame], DataFrame]) -> str:
        """Writes make(current) as the next version, which readers see from then on."""
        self.tables.publish(lambda now: {"table": make(now["table"])})
        return self.current()


class BronzeTable:
    """Append-only, one folder per run, so that a run tried again replaces its own rows only, with none if it has none."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema, self.files = spark, path.rstrip("/"), schema, Files(spark)

    def stage(self, rows: DataFrame, run_id: int) -> DataFrame:
        """The rows of one run, all text, in a folder that append() takes and clears; a new try starts from nothing."""
        path = f"{self.path}/_staging/{run_id}"
        names = [f.strip().split()[0] for f in self.schema.split(",")]
        rows.select(*(F.col(c).cast("string").alias(c) for c in names)).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(", ".join(f"{c} string" for c in names)).parquet(path)

    def append(self, rows: DataFrame, run_id: int) -> None:
        at = f"{self.path}/_run_id={run_id}"
        fresh = f"{self.path}/_writing/{run_id}-{uuid.uuid4().hex}"
        rows.drop("_run_id").write.parquet(fresh)  # may read what it replaces, so that goes afterwards
        (source, fs), (target, _) = self.files.at(fresh), self.files.at(at)
        fs.delete(target, True)
        fs.mkdirs(target.getParent())
        if not fs.rename(source, target):
            raise RuntimeError(f"{at} could not be put in place")
        self.files.delete(f"{self.path}/_staging/{run_id}")

    def read(self) -> DataFrame:
        hadoop, fs = self.files.at(self.path)
        runs = [s.getPath().toString() for s in fs.globStatus(self.files.at(f"{self.path}/_run_id=*")[0]) or []] if fs.exists(hadoop) else []
        if not runs:
            return empty(self.spark, f"{self.schema}, _run_id int")
        return self.spark.read.schema(f"{self.schema}, _run_id int").option("basePath", self.path).parquet(*runs)
