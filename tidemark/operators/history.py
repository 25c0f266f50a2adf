"""Deduplication, upserts and slowly changing dimensions, as functions from table versions to the next version."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.normalize import record_hash

FOREVER = "9999-12-31 00:00:00"


def newest_first(ts: str, *ties: str) -> list[Column]:
    return [F.col(ts).desc_nulls_last(), *(F.col(t).desc() for t in ties)]


def winners(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key; a window with a rank limit, which Spark applies before the exchange too."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def merge_incremental(resident: DataFrame, bronze: DataFrame, keys: Sequence[str], order: Sequence[Column], floor: int, run_col: str = "_run_id") -> DataFrame:
    """resident after the runs above floor: only keys they touch are ranked again, the others stay as they are."""
    new = bronze.filter(F.col(run_col) > floor)
    touched = new.select(*keys).distinct()
    contenders = new.unionByName(resident.join(touched, list(keys), "left_semi").select(*new.columns))
    return resident.join(touched, list(keys), "left_anti").select(*new.columns).unionByName(winners(contenders, keys, order))


def decisions(bronze: DataFrame, current: DataFrame, key: str, floor: int = 0) -> DataFrame:
    """Each new bronze row as kept or dropped against the current winner of its key, with the reason."""
    lineage = ("_file_id", "_source_row_number", "_record_hash", "_batch_id")
    won = current.select(key, *(F.col(c).alias(f"winner{c}") for c in lineage))
    same_row = (F.col("_file_id") == F.col("winner_file_id")) & (F.col("_source_row_number") == F.col("winner_source_row_number"))
    same_hash = F.col("_record_hash") == F.col("winner_record_hash")
    reason = F.when(same_row, "KEPT").when((F.col("_batch_id") == F.col("winner_batch_id")) & same_hash, "EXACT_DUP_IN_FILE").when(same_hash, "EXACT_DUP_CROSS_BATCH").otherwise("SUPERSEDED_BY_NEWER")
    return bronze.filter(F.col("_run_id") > floor).join(won, key).withColumn("reason", reason)


def audit(decided: DataFrame) -> DataFrame:
    """One row: the runs covered, and rows received, accepted, rejected and deduplicated."""
    kept = F.col("reason") == "KEPT"
    return decided.agg(F.min("_run_id").alias("min_run_id"), F.max("_run_id").alias("max_run_id"), F.count("*").alias("records_received"), F.count_if(kept).alias("records_accepted"), F.lit(0).cast("long").alias("records_rejected"), F.count_if(~kept).alias("records_deduplicated"))


def dedup_counts(bronze: DataFrame, keys: Sequence[str], order: Sequence[Column], floor: int, run_col: str = "_run_id") -> DataFrame:
    """One row for the build above floor, from one exchange: input_count, output_count, dedup_count (rows that lost in the build they
    came in) and displaced_count (winners up to floor that lost to a later one).
    """
    old = F.col(run_col) <= floor
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    old_rank = F.row_number().over(Window.partitionBy(*keys).orderBy(old.desc(), *order))
    winner_run = F.first(run_col).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ranked = bronze.select(old.alias("_old"), rank.alias("_rank"), old_rank.alias("_old_rank"), (winner_run > floor).alias("_late"))
    lost = (F.col("_old") & (F.col("_old_rank") > 1)) | (~F.col("_old") & (F.col("_rank") > 1))
    return ranked.agg(F.count("*").alias("input_count"), F.count_if(F.col("_rank") == 1).alias("output_count"), F.count_if(lost).alias("dedup_count"), F.count_if(F.col("_old") & (F.col("_old_rank") == 1) & F.col("_late")).alias("displaced_count"))


def high_water(resident: DataFrame, run_col: str = "_run_id") -> DataFrame:
    """One row, floor: the highest run that a table has, 0 if it is empty."""
    return resident.agg(F.coalesce(F.max(run_col), F.lit(0)).cast("long").alias("floor"))


def above(bronze: DataFrame, floor: DataFrame, run_col: str = "_run_id") -> DataFrame:
    """Rows of runs above the floor, one row, which is a subquery and not known to the caller."""
    return bronze.join(F.broadcast(floor), F.col(run_col) > F.col("floor")).drop("floor")  # one row


def upsert(resident: DataFrame, incoming: DataFrame, key: str, order_col: str, null_loses: bool = False, ties: Sequence[str] = ()) -> DataFrame:
    """resident after a hash-guarded upsert, with `_action`: inserted, updated or kept.

    The newest incoming row of a key replaces the resident one if its hash differs and it is not older. With null_loses a
    resident row without date is always replaced, and an incoming one without date never replaces a date; without it nulls
    come first among incoming rows, as in a plain descending order, and never pass the guard.
    """
    first = F.col(order_col).desc_nulls_last() if null_loses else F.col(order_col).desc_nulls_first()
    new = winners(incoming, [key], [first, *(F.col(t).desc() for t in ties)])
    r, n = resident.alias("r"), new.alias("n")
    newer = F.col(f"n.{order_col}") >= F.col(f"r.{order_col}")
    if null_loses:
        newer = F.col(f"r.{order_col}").isNull() | newer
    changed = ~F.col("n._record_hash").eqNullSafe(F.col("r._record_hash"))
    action = F.when(F.col(f"r.{key}").isNull(), "inserted").when(F.col(f"n.{key}").isNotNull() & changed & F.coalesce(newer, F.lit(False)), "updated").otherwise("kept")
    both = r.join(n, F.col(f"r.{key}") == F.col(f"n.{key}"), "full_outer").withColumn("_action", action)
    take = F.col("_action") != "kept"
    return both.select(*(F.when(take, F.col(f"n.{c}")).otherwise(F.col(f"r.{c}")).alias(c) for c in resident.columns), "_action")


@dataclass(frozen=True)
class Scd:
    """Columns by type: 2 starts a version when it changes, 1 shows its latest value everywhere, 0 its first."""

    key: str
    ts: str
    ties: tuple[str, ...]
    type2: tuple[str, ...]
    type1: tuple[str, ...] = ()
    type0: tuple[str, ...] = ()


def version_chain(history: DataFrame, scd: Scd, lineage: Sequence[str] = (), forever: str = FOREVER) -> DataFrame:
    """The versions of each key from its whole history: key, type 2, 1 and 0 columns, lineage, valid_from, valid_to, is_current.

    Versions differ by the hash of their type 2 columns, so null and empty are the same. A version's dates and values
    come from its first row, its lineage from the last one. All windows share one partitioning and order.
    """
    order = [F.col(scd.ts).asc_nulls_first(), *(F.col(t).asc() for t in scd.ties)]
    w = Window.partitionBy(scd.key).orderBy(*order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = history.withColumn("_hash", record_hash(*(F.col(c) for c in scd.type2)))
    rows = rows.withColumn("_starts", (F.row_number().over(w) == 1) | ~F.lag("_hash").over(w).eqNullSafe(F.col("_hash")))
    rows = rows.withColumn("_version", F.sum(F.col("_starts").cast("int")).over(w)).withColumn("_ends", F.coalesce(F.lead("_starts").over(w), F.lit(True)))
    same = [F.last(c).over(whole).alias(c) for c in scd.type1] + [F.first(c).over(whole).alias(c) for c in scd.type0]
    last = [F.last(c).over(Window.partitionBy(scd.key, "_version").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(c) for c in lineage]
    rows = rows.select(scd.key, *scd.type2, *same, *last, F.col(scd.ts).alias("valid_from"), "_starts", "_version")
    next_from = F.lead("valid_from").over(Window.partitionBy(scd.key).orderBy("_version"))
    chain = rows.filter("_starts").withColumn("is_current", F.lead("_version").over(Window.partitionBy(scd.key).orderBy("_version")).isNull())
    return chain.withColumn("valid_to", F.when(F.col("is_current"), F.lit(forever).cast("timestamp")).otherwise(next_from)).drop("_starts", "_version")


def as_of(versions: DataFrame, at: Column | str) -> DataFrame:
    """The versions in force at a time, which may be a literal or a column."""
    at = F.lit(at).cast("timestamp") if isinstance(at, str) else at
    return versions.filter((F.col("valid_from") <= at) & (at < F.col("valid_to")))


def vanished(current_keys: DataFrame, bronze_keys: DataFrame, snapshot_keys: DataFrame, key: str) -> DataFrame:
    """Current keys that bronze has seen and this pass's snapshot lacks."""
    return current_keys.select(key).distinct().join(bronze_keys.select(key), key, "left_semi").join(snapshot_keys.select(key), key, "left_anti")


def mass_delete(current_keys: DataFrame, gone: DataFrame, key: str, threshold: float) -> DataFrame:
    """One row: current_count, vanished_count, ratio and tripped, which is strict; nothing current means a ratio of 0."""
    a = current_keys.agg(F.countDistinct(key).alias("current_count"))
    b = gone.agg(F.countDistinct(key).alias("vanished_count"))
    ratio = F.when(F.col("current_count") == 0, F.lit(0.0)).otherwise(F.col("vanished_count").cast("double") / F.col("current_count"))
    return a.crossJoin(F.broadcast(b)).withColumn("ratio", ratio).withColumn("tripped", F.col("ratio") > threshold)  # one row each


def apply_deletes(versions: DataFrame, gone: DataFrame, key: str, closed_at: Column, mode: str, forever: str = FOREVER) -> DataFrame:
    """versions after the vanished keys' current versions are closed.

    ignore leaves them; invalidate ends them at closed_at; new_record also opens a copy from there, current and marked by
    is_deleted. Versions that started later than closed_at end where they start.
    """
    marked = versions.withColumn("is_deleted", F.lit(False))
    if mode == "ignore":
        return marked
    if mode not in ("invalidate", "new_record"):
        raise ValueError(f"unknown delete mode {mode!r}")
    hit = marked.join(gone.select(key).distinct().withColumn("_gone", F.lit(True)), key, "left").withColumn("_gone", F.coalesce("_gone", F.lit(False)) & F.col("is_current"))
    end = F.greatest(closed_at.cast("timestamp"), F.col("valid_from"))
    closed = hit.withColumn("valid_to", F.when(F.col("_gone"), end).otherwise(F.col("valid_to"))).withColumn("is_current", F.col("is_current") & ~F.col("_gone"))
    if mode == "new_record":
        opened = hit.filter("_gone").withColumn("valid_from", end).withColumn("valid_to", F.lit(forever).cast("timestamp")).withColumn("is_deleted", F.lit(True))
        closed = closed.unionByName(opened)
    return closed.drop("_gone")


def publish_scd(gold: DataFrame, bronze: DataFrame, snapshot: DataFrame, scd: Scd, mode: str = "ignore", threshold: float = 1.0, closed_at: Column | None = None) -> DataFrame:
    """The next gold version: deletes first, under the mass-delete breaker, then the keys of the snapshot rebuilt from all their history."""
    from .quality import QualityError

    gone = vanished(gold.filter("is_current"), bronze, snapshot, scd.key)
    row = mass_delete(gold.filter("is_current"), gone, scd.key, threshold).first()
    if row["tripped"]:
        raise QualityError(f"{row['vanished_count']} of {row['current_count']} keys vanished, the limit is {threshold}")
    if closed_at is None:
        closed_at = F.lit(snapshot.agg(F.max(scd.ts)).first()[0])
    closed = apply_deletes(gold.drop("is_deleted"), gone, scd.key, closed_at, mode)
    touched = snapshot.select(scd.key).distinct()
    rebuilt = version_chain(bronze.join(touched, scd.key, "left_semi"), scd).withColumn("is_deleted", F.lit(False))
    return closed.join(touched, scd.key, "left_anti").select(*rebuilt.columns).unionByName(rebuilt)
