"""Runs and their stages: who may work on one, for how long, and what a finished publication leaves.

The transitions are functions from tables to tables. RunLedger commits them to versioned tables, where of two claims made at
once one wins and the other looks again. Leases end by themselves, so a run whose worker died can be claimed anew.

runs: run_id, idempotency_key, file_id, batch_id, status, lease_expires_at and more; stages: run_id, stage_name, status,
lease_expires_at and more. Rows with null keys are never claimed.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.tables import ConflictError, VersionedTables
from .history import winners

LEASE_SECONDS = 300
SCHEMAS = {
    "runs": "run_id long, idempotency_key string, file_id long, batch_id long, status string, lease_expires_at timestamp, try_number int, worker string, started_at timestamp, finished_at timestamp, rows_read long, rows_parsed long, rows_loaded long, duration_ms long, report_uri string",
    "stages": "run_id long, stage_name string, status string, lease_expires_at timestamp, try_number int, worker string, started_at timestamp, finished_at timestamp",
    "files": "file_id long, object_uri string, content_sha256 string, status string, duplicate_of_file_id long",
    "batches": "batch_id long, batch_key string, status string",
    "findings": "run_id long, rule_id string, rule_type string, severity string, outcome string, evaluated_count long, failed_count long, threshold string, observed string",
    "rejects": "run_id long, source_row_number long, raw_line string, error_type string, error_column string, error_message string, business_key string, resolution_type string, resolved_by_run_id long",
    "gaps": "dataset string, dag_run string, backfill_id string",
}


def claimable(status: Column, lease_expires_at: Column, now: Column) -> Column:
    """Waiting or failed, or running on a lease that is over."""
    return F.coalesce(status.isin("PENDING", "FAILED") | (status == "RUNNING") & (lease_expires_at < now), F.lit(False))


def _lease(now: Column, seconds: int) -> Column:
    return now + F.make_dt_interval(secs=F.lit(seconds))


def claim_runs(runs: DataFrame, wanted: DataFrame, now: Column, seconds: int = LEASE_SECONDS) -> DataFrame:
    """runs with those of wanted (idempotency_key, try_number, worker) that may be claimed now RUNNING, and `_claimed`.

    A key in wanted twice counts once, with the higher try number. The first claim sets started_at.
    """
    asked = wanted.groupBy("idempotency_key").agg(F.max(F.struct("try_number", "worker")).alias("_ask")).withColumnRenamed("idempotency_key", "_key")
    joined = runs.join(asked, runs["idempotency_key"] == F.col("_key"), "left")
    claimed = F.col("_ask").isNotNull() & claimable(F.col("status"), F.col("lease_expires_at"), now)
    new = {"status": F.lit("RUNNING"), "try_number": F.col("_ask.try_number"), "worker": F.col("_ask.worker"), "started_at": F.coalesce("started_at", now), "lease_expires_at": _lease(now, seconds)}
    return joined.select(*(F.when(claimed, new[c]).otherwise(F.col(c)).alias(c) if c in new else c for c in runs.columns), claimed.alias("_claimed"))


def heartbeats(runs: DataFrame, beats: DataFrame) -> DataFrame:
    """runs after beats (run_id, lease_expires_at, rows_read, rows_parsed), the latest of each run; only running ones listen."""
    last = beats.groupBy(F.col("run_id").alias("_run")).agg(F.max(F.struct("lease_expires_at", "rows_read", "rows_parsed")).alias("_beat"))
    joined = runs.join(last, runs["run_id"] == F.col("_run"), "left")
    heard = F.col("_beat").isNotNull() & F.coalesce(F.col("status") == "RUNNING", F.lit(False))
    new = ("lease_expires_at", "rows_read", "rows_parsed")
    return joined.select(*(F.when(heard, F.col(f"_beat.{c}")).otherwise(F.col(c)).alias(c) if c in new else c for c in runs.columns))


def claim_stages(stages: DataFrame, runs: DataFrame, wanted: DataFrame, now: Column, seconds: int = LEASE_SECONDS) -> DataFrame:
    """stages with those of wanted (run_id, stage_name, try_number, worker) claimed, made if they aren't there, and `_claimed`.

    Only a run that is STAGED has its stages claimed.
    """
    staged = runs.filter("status = 'STAGED'").select("run_id")
    asked = wanted.join(staged, "run_id", "left_semi").groupBy("run_id", "stage_name").agg(F.max(F.struct("try_number", "worker")).alias("_ask"))
    asked = asked.select(F.col("run_id").alias("_run"), F.col("stage_name").alias("_stage"), "_ask")
    joined = stages.join(asked, (stages["run_id"] == F.col("_run")) & (stages["stage_name"] == F.col("_stage")), "full_outer")
    unknown = F.col("run_id").isNull() & F.col("_run").isNotNull()
    claimed = F.col("_ask").isNotNull() & (unknown | claimable(F.col("status"), F.col("lease_expires_at"), now))
    new = {
        "run_id": F.col("_run"), "stage_name": F.col("_stage"), "status": F.lit("RUNNING"), "lease_expires_at": _lease(now, seconds), "try_number": F.col("_ask.try_number"), "worker": F.col("_ask.worker"),
        "started_at": F.coalesce("started_at", now),
    }
    return joined.select(*(F.when(claimed, new[c]).otherwise(F.col(c)).alias(c) if c in new else c for c in stages.columns), claimed.alias("_claimed"))


def complete_stages(stages: DataFrame, done: DataFrame) -> DataFrame:
    """stages with the status and finished_at of done (run_id, stage_name, status, finished_at), whatever they were before."""
    last = done.groupBy(F.col("run_id").alias("_run"), F.col("stage_name").alias("_stage")).agg(F.max(F.struct("finished_at", "status")).alias("_done"))
    joined = stages.join(last, (stages["run_id"] == F.col("_run")) & (stages["stage_name"] == F.col("_stage")), "left")
    return joined.select(*(F.coalesce(F.col(f"_done.{c}"), F.col(c)).alias(c) if c in ("status", "finished_at") else c for c in stages.columns))


def _set_status(table: DataFrame, key: str, done: DataFrame, status: str) -> DataFrame:
    keys = done.select(F.col(key).alias("_key")).distinct()
    joined = table.join(keys, table[key] == F.col("_key"), "left")
    return joined.select(*(F.when(F.col("_key").isNotNull(), status).otherwise(F.col(c)).alias(c) if c == "status" else c for c in table.columns))


def finalise(tables: Mapping[str, DataFrame], done: DataFrame) -> dict[str, DataFrame]:
    """files, batches and runs after done (run_id, file_id, batch_id, rows_loaded, finished_at, duration_ms, report_uri): PROCESSED, PUBLISHED and SUCCEEDED."""
    new = ("rows_loaded", "finished_at", "duration_ms", "report_uri")
    last = winners(done, ["run_id"], [F.desc("finished_at")]).select(F.col("run_id").alias("_run"), F.struct(*new).alias("_done"))
    runs = tables["runs"]
    joined = runs.join(last, runs["run_id"] == F.col("_run"), "left")
    hit = F.col("_run").isNotNull()
    runs = joined.select(*(F.when(hit, F.lit("SUCCEEDED") if c == "status" else F.col(f"_done.{c}")).otherwise(F.col(c)).alias(c) if c in (*new, "status") else c for c in runs.columns))
    return {"files": _set_status(tables["files"], "file_id", done, "PROCESSED"), "batches": _set_status(tables["batches"], "batch_id", done, "PUBLISHED"), "runs": runs}


def staged(runs: DataFrame) -> DataFrame:
    """Runs whose rows wait for a build, in order."""
    return runs.filter("status = 'STAGED'").orderBy("run_id")


def latest_succeeded(runs: DataFrame, by: str) -> DataFrame:
    """The newest run that succeeded for each file, content hash or other column."""
    return runs.filter("status = 'SUCCEEDED'").groupBy(by).agg(F.max("run_id").alias("run_id"))


def receipts(found: DataFrame) -> DataFrame:
    """One row: what the receipts of a pass add up to; zeros without any."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return found.agg(F.count("*").alias("receipts"), *(total(c) for c in ("rows_read", "rows_loaded", "rows_rejected")))


def report(findings: DataFrame) -> DataFrame:
    """One row per run: its findings as JSON, worst outcome first, as a report file holds them."""
    worst = F.when(F.col("outcome") == "FAIL", 0).when(F.col("outcome") == "PASS_WITH_WARNING", 1).otherwise(2)
    body = F.struct(worst.alias("_rank"), *(F.col(c) for c in findings.columns if c != "run_id"))
    listed = F.transform(F.sort_array(F.collect_list(body)), lambda x: x.dropFields("_rank"))
    return findings.groupBy("run_id").agg(F.to_json(listed).alias("report"))


class RunLedger:
    """The tables of SCHEMAS, and others published with them, such as a gold one."""

    def __init__(self, spark: SparkSession, path: str, more: Mapping[str, str] | None = None):
        self.spark, self.tables = spark, VersionedTables(spark, path, {**SCHEMAS, **(more or {})})

    def read(self, name: str) -> DataFrame:
        return self.tables.read(name)

    def commit(self, make: Callable[[dict[str, DataFrame]], Mapping[str, DataFrame]], tries: int = 5) -> int:
        """Publishes make(current tables), again on what another one has left if that came first."""
        for turn in range(tries):
            try:
                return self.tables.publish(make)
            except ConflictError:
                if turn == tries - 1:
                    raise
                time.sleep(0.05 * 2**turn)
        raise ValueError("tries must be positive")

    def _now(self, now: datetime | None) -> Column:
        return F.lit((now or datetime.now(UTC)).astimezone(UTC).strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")

    def claim(self, key: str, worker: str, try_number: int = 1, now: datetime | None = None) -> int | None:
        """The number of the run of that key if it is ours now, else None: finished, held by a live lease, or unknown."""
        wanted = self.spark.createDataFrame([(key, try_number, worker)], "idempotency_key string, try_number int, worker string")
        won: list[int] = []

        def make(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
            won.clear()
            next_ = claim_runs(t["runs"], wanted, self._now(now))
            won.extend(r["run_id"] for r in next_.filter("_claimed").select("run_id").collect())
            return {"runs": next_.drop("_claimed")} if won else {}

        self.commit(make)
        return won[0] if won else None

    def claim_stage(self, run_id: int, stage: str, worker: str, try_number: int = 1, now: datetime | None = None) -> bool:
        wanted = self.spark.createDataFrame([(run_id, stage, try_number, worker)], "run_id long, stage_name string, try_number int, worker string")
        won: list[bool] = []

        def make(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
            next_ = claim_stages(t["stages"], t["runs"], wanted, self._now(now))
            won[:] = [not next_.filter("_claimed").isEmpty()]
            return {"stages": next_.drop("_claimed")} if won[0] else {}

        self.commit(make)
        return won[0]

    def heartbeat(self, run_id: int, until: datetime, rows_read: int, rows_parsed: int) -> None:
        beats = self.spark.createDataFrame([(run_id, rows_read, rows_parsed)], "run_id long, rows_read long, rows_parsed long").withColumn("lease_expires_at", self._now(until))
        self.commit(lambda t: {"runs": heartbeats(t["runs"], beats)})

    def record(self, table: str, rows: DataFrame, run_id: int | None = None) -> None:
        """Adds findings, rejects or gaps; those that a run recorded before, in a try that died, are replaced."""

        def make(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
            old = t[table] if run_id is None else t[table].filter(~F.col("run_id").eqNullSafe(F.lit(run_id)))
            return {table: old.unionByName(rows, allowMissingColumns=True).distinct() if run_id is None else old.unionByName(rows, allowMissingColumns=True)}

        self.commit(make)

    def finalise(self, done: DataFrame, publish: Callable[[dict[str, DataFrame]], Mapping[str, DataFrame]] | None = None) -> int:
        """In one commit with what publish() changes, so that a run never succeeds without its rows, nor the other way round."""
        return self.commit(lambda t: {**(publish(t) if publish else {}), **finalise(t, done)})
