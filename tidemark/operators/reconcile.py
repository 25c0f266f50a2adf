"""Accounting for rows between layers: checksums, counts, sums, discrepancies, watermarks, freshness, recovery, lineage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Stages of a run, in order.
STAGES = ("STAGE_LOAD", "DBT_BUILD", "PUBLISH")


def row_checksum(*cols: Column) -> Column:
    """The first 64 bits of the MD5 of a row's fields joined by bars, as a signed long."""
    text = F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("")) for c in cols))
    return F.conv(F.substr(F.md5(text.cast("binary")), F.lit(1), F.lit(16)), 16, -10).cast("long")


def table_checksum(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: checksum, independent of order, and rows. Equal rows cancel in pairs, so both must agree."""
    return df.agg(F.lower(F.lpad(F.hex(F.coalesce(F.bit_xor(row_checksum(*(F.col(c) for c in columns))), F.lit(0).cast("long"))), 16, "0")).alias("checksum"), F.count("*").alias("rows"))


def profile(df: DataFrame, key: str, ts: str | None = None, amount: str | None = None, scale: int = 2) -> DataFrame:
    """One row: rows, keys, min_ts, max_ts and total, the exact sum."""
    none = F.lit(None)
    return df.agg(
        F.count("*").alias("rows"),
        F.countDistinct(key).alias("keys"),
        (F.min(ts) if ts else none.cast("timestamp")).alias("min_ts"),
        (F.max(ts) if ts else none.cast("timestamp")).alias("max_ts"),
        (F.sum(F.col(amount).cast(f"decimal(38,{scale})")) if amount else none.cast("decimal(38,2)")).alias("total"),
    )


def reconcile(left: DataFrame, right: DataFrame, hop: str) -> DataFrame:
    """Two profiles side by side, with what is missing on the right. Each is one row."""
    side = lambda df, name: df.select(*(F.col(c).alias(f"{c}_{name}") for c in df.columns))
    both = side(left, "input").crossJoin(F.broadcast(side(right, "output")))
    return both.select(F.lit(hop).alias("hop"), "*", (F.col("rows_input") - F.col("rows_output")).alias("discrepancy"), (F.coalesce("total_input", F.lit(0)) - F.coalesce("total_output", F.lit(0))).alias("total_discrepancy"))


def reconcile_dedup(files: DataFrame, counts: DataFrame) -> DataFrame:
    """A row for each file (file_id) with the build's counts, one row as dedup_counts() of history gives it.

    discrepancy counts as dropped only new rows that lost; corrected also those that were resident and got displaced.
    """
    out = F.col("output_count") + F.col("dedup_count")
    counts = counts.withColumn("discrepancy", F.col("input_count") - out).withColumn("corrected", F.col("input_count") - out - F.col("displaced_count"))
    return files.select("file_id").distinct().crossJoin(F.broadcast(counts))  # one row


def control_total(outputs: DataFrame, manifests: DataFrame, on: str) -> DataFrame:
    """outputs (on, output_count) with the expected count less the actual one, null where there is no manifest."""
    return outputs.join(manifests.select(on, "expected_row_count"), on, "left").withColumn("control_total_discrepancy", F.col("expected_row_count") - F.col("output_count"))


def advance_watermark(resident: DataFrame, proposed: DataFrame, on: str) -> DataFrame:
    """on, old_value and new_value: the greater of the resident watermark and the proposed one, so that it never goes back."""
    a, b = resident.select(on, F.col("value").alias("old_value")), proposed.select(on, F.col("value").alias("proposed"))
    return a.join(b, on, "full_outer").select(on, "old_value", F.greatest("old_value", "proposed").alias("new_value"))


def freshness(datasets: DataFrame, files: DataFrame, runs: DataFrame, now: Column) -> DataFrame:
    """Datasets with a frequency: last_received_at, last_success_at, delay and status ok, warn or fail.

    Files and runs are reduced to one row per dataset before they are joined, so neither multiplies the other. Limits are
    seconds.
    """
    last = files.groupBy("dataset_id").agg(F.max("discovered_at").alias("last_file"))
    good = runs.filter("status = 'SUCCEEDED'").groupBy("dataset_id").agg(F.max("finished_at").alias("last_success_at"))
    joined = datasets.filter("expected_frequency IS NOT NULL").join(last, "dataset_id", "left").join(good, "dataset_id", "left")
    joined = joined.withColumn("last_received_at", F.coalesce("last_file", "created_at"))
    delay = now.cast("long") - F.col("last_received_at").cast("long")
    status = F.when(F.col("freshness_fail_after").isNotNull() & (delay > F.col("expected_frequency") + F.col("freshness_fail_after")), "fail").when(delay > F.col("expected_frequency") + F.coalesce("freshness_warn_after", F.lit(0)), "warn").otherwise("ok")
    return joined.select("dataset_id", "dataset_name", "last_received_at", "last_success_at", delay.alias("processing_delay"), status.alias("freshness_status"))


def freshness_breaches(datasets: DataFrame, files: DataFrame, now: Column, tier: str) -> DataFrame:
    """Datasets whose last file is later than their frequency and the tier's limit allow: dataset_id, dataset_name and delay.

    warn without a limit is over with the frequency; fail without one never is.
    """
    if tier not in ("warn", "fail"):
        raise ValueError(f"unknown tier {tier!r}")
    last = files.groupBy("dataset_id").agg(F.max("discovered_at").alias("last_file"))
    delay = now.cast("long") - F.coalesce("last_file", "created_at").cast("long")
    limit = F.coalesce("freshness_warn_after", F.lit(0)) if tier == "warn" else F.col("freshness_fail_after")
    late = datasets.filter("expected_frequency IS NOT NULL").join(last, "dataset_id", "left").withColumn("delay", delay)
    return late.filter(F.col("delay") > F.col("expected_frequency") + limit).select("dataset_id", "dataset_name", "delay")


def stuck_stages(recovery: DataFrame) -> DataFrame:
    """Runs of run_recovery() whose next action is to try a stage again."""
    return recovery.filter("next_action LIKE 'retry stage%'").select("run_id", "next_action")


def run_recovery(runs: DataFrame, stages: DataFrame) -> DataFrame:
    """Each run with the status of its stages and what to do next; stages (run_id, stage_name, status) are pivoted once."""
    wide = stages.groupBy("run_id").agg(*(F.max(F.when(F.col("stage_name") == s, F.col("status"))).alias(s) for s in STAGES))
    joined = runs.join(wide, "run_id", "left")
    action = F.when((F.col("status") == "SUCCEEDED") & (F.col("PUBLISH") == "SUCCEEDED"), "complete")
    for s in STAGES:
        action = action.when(F.col(s).isNull() | F.col(s).isin("FAILED", "PENDING"), f"retry stage {s}")
    return joined.select("run_id", F.col("status").alias("run_status"), *(F.col(s).alias(f"{s.lower()}_status") for s in STAGES), action.otherwise("in progress").alias("next_action"))


def pending_builds(runs: DataFrame, stages: DataFrame) -> DataFrame:
    """Runs that are loaded and whose build is missing, failed or left running."""
    loaded = stages.filter("stage_name = 'STAGE_LOAD' AND status = 'SUCCEEDED'").select("run_id")
    build = stages.filter("stage_name = 'DBT_BUILD'").select("run_id", F.col("status").alias("build_status"))
    return runs.join(loaded, "run_id", "left_semi").join(build, "run_id", "left").filter("build_status IS NULL OR build_status IN ('FAILED', 'RUNNING')").select("run_id")


def lineage(rows: DataFrame, runs: DataFrame, files: DataFrame, batches: DataFrame, audits: DataFrame, model: str) -> DataFrame:
    """rows with their run, file and batch, and the audit whose range of runs holds theirs.

    An audit's range becomes a row per run, as many as there are runs, as builds follow each other; so all joins are on equal keys.
    """
    found = rows.join(runs, rows["_run_id"] == runs["run_id"]).join(files, rows["_file_id"] == files["file_id"]).join(batches, rows["_batch_id"] == batches["batch_id"])
    own = audits.filter((F.col("model_name") == model) & (F.col("min_run_id") <= F.col("max_run_id")))
    own = own.select(F.explode(F.sequence("min_run_id", "max_run_id")).alias("_audited"), "dedup_audit_id", "min_run_id", "max_run_id", "records_deduplicated")
    return found.join(own, found["_run_id"] == own["_audited"], "left").drop("_audited")


def redrive(rejects: DataFrame, published: DataFrame, key: str) -> DataFrame:
    """rejects with PENDING ones whose key has been published since set to REDRIVEN."""
    keys = published.select(F.col(key).alias("_published")).distinct()
    joined = rejects.join(keys, rejects[key] == F.col("_published"), "left")
    return joined.withColumn("status", F.when((F.col("status") == "PENDING") & F.col("_published").isNotNull(), "REDRIVEN").otherwise(F.col("status"))).drop("_published")


def duplicate_files(files: DataFrame) -> DataFrame:
    """files (dataset_id, file_id, content_sha256) with duplicate_of_file_id, the first file of equal content, null for that one itself.

    The first files come from a pre-aggregated minimum, so that one content may be that of most files.
    """
    first = files.groupBy(F.col("dataset_id").alias("_dataset"), F.col("content_sha256").alias("_content")).agg(F.min("file_id").alias("_first"))
    joined = files.join(first, files["dataset_id"].eqNullSafe(F.col("_dataset")) & files["content_sha256"].eqNullSafe(F.col("_content")))
    return joined.withColumn("duplicate_of_file_id", F.when(F.col("_first") != F.col("file_id"), F.col("_first"))).drop("_dataset", "_content", "_first")


def repair_lineage(files: DataFrame) -> DataFrame:
    """files with missing pointers to the first file of equal content filled in, and `repaired`; those that are set stay."""
    found = duplicate_files(files.withColumnRenamed("duplicate_of_file_id", "_old"))
    repaired = F.col("_old").isNull() & F.col("duplicate_of_file_id").isNotNull()
    return found.withColumn("repaired", repaired).withColumn("duplicate_of_file_id", F.coalesce("_old", "duplicate_of_file_id")).drop("_old")


def duplicate_groups(files: DataFrame) -> DataFrame:
    return files.groupBy("dataset_id", "content_sha256").agg(F.min("file_id").alias("first_file_id"), F.count("*").alias("n")).filter("n > 1")


def gaps(observed: DataFrame, day: str) -> DataFrame:
    """Days between the first and the last one observed that have no row."""
    span = observed.agg(F.min(day).alias("a"), F.max(day).alias("b")).filter("a IS NOT NULL")
    return span.select(F.explode(F.sequence("a", "b")).alias(day)).join(observed.select(day).distinct(), day, "left_anti")


def idempotency_key(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *(p.cast("string") for p in parts)).cast("binary"), 256)


def register(resident: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """resident with the incoming rows of unknown keys, one each: get or create without a transaction."""
    return resident.unionByName(incoming.dropDuplicates([key]).join(resident.select(key), key, "left_anti").select(*resident.columns))
