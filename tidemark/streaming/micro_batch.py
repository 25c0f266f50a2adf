"""Incremental runs: a file stream that takes what is there, batch by batch, through the same functions as a full run.

State lives in the target table, not in the stream, so rows are never too late: each batch merges by event time. A batch
that is tried again replaces its own result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.history import merge_incremental, newest_first
from ..plans.tables import VersionedTables


def run_available(spark: SparkSession, stream: DataFrame, path: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The target table under path, after everything the stream has now; keys and order choose the row that stays.

    The number of the last batch is committed together with the rows; batches up to it were merged before a crash and are
    skipped.
    """
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stream.schema.fields) + ", _run_id long"
    target = VersionedTables(spark, f"{path}/table", {"rows": schema, "progress": "batch long"})
    best = newest_first(order[0], *order[1:])

    def merge(batch: DataFrame, number: int) -> None:
        def make(now: dict[str, DataFrame]) -> dict[str, DataFrame]:
            if number <= (now["progress"].agg(F.max("batch")).first()[0] or -1):
                return {}
            rows = merge_incremental(now["rows"], batch.withColumn("_run_id", F.lit(number).cast("long")), keys, best, number - 1)
            return {"rows": rows, "progress": spark.range(number, number + 1).toDF("batch")}

        target.publish(make)

    run = stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    return target.read("rows").drop("_run_id")
