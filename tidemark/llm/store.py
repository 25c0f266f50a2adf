"""Tables written to the folder that driver and executors share, to cut lineage."""

from __future__ import annotations

import atexit
import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir

def delete(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


_left: dict[str, SparkSession] = {}


@atexit.register
def _clean() -> None:
    """Tables that a result may still be read from go when the driver ends, if Spark is still there."""
    for path, spark in _left.items():
        try:
            delete(spark, path)
        except Exception:  # noqa: BLE001 - the session may have been stopped
            continue


def fresh(df: DataFrame, name: str) -> str:
    """name, after as many underscores as it takes to be no column of df, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


class Scratch:
    """Tables of one operator run; drop() deletes those no later step reads.

    Parquet in a shared folder survives the loss of any executor, and later steps don't compute again what led to it.
    """

    def __init__(self, spark: SparkSession, what: str):
        self.spark, self.at, self.n = spark, f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}", 0
        self.kept: list[tuple[DataFrame, str]] = []
        _left[self.at] = spark

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.at}/{self.n}"
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.kept.append((table, path))
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            for path in [p for t, p in self.kept if t is table]:
                delete(self.spark, path)

    def release(self) -> None:
        """Lets Spark's cleaner, which follows garbage collection on the driver, remove shuffle files of jobs that are over now, not in half an hour."""
        gc.collect()
        self.spark._jvm.System.gc()
