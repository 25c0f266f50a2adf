"""From a data set's files to bronze: read, normalise, judge, hash, write; and from there to a published table by its strategy."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalize as n
from ..operators import history as h
from ..operators import quality as q
from ..operators.counters import Counters
from ..sources.contract import DatasetContract, normalised
from ..sources.scan import read_clean
from .tables import BronzeTable

Publisher = Callable[..., DataFrame]
_publishers: dict[str, Publisher] = {}


def register_publisher(strategy: str, publisher: Publisher) -> None:
    """A function of the resident table, the incoming one and its options, which gives the next version."""
    if strategy in _publishers:
        raise ValueError(f"there is a publisher for {strategy!r}")
    _publishers[strategy] = publisher


def resolve_publisher(strategy: str) -> Publisher:
    if strategy not in _publishers:
        raise ValueError(f"no publisher for {strategy!r}; there are {', '.join(sorted(_publishers))}")
    return _publishers[strategy]


register_publisher("upsert", h.upsert)
register_publisher("scd", h.publish_scd)
register_publisher("merge", h.merge_incremental)


@dataclass
class Ingested:
    """Rows by outcome, from one pass; findings are a row per rule."""

    good: DataFrame
    rejects: DataFrame
    findings: DataFrame


def ingest(spark: SparkSession, paths: str | Sequence[str], contract: DatasetContract, hash_columns: Sequence[str] | None = None) -> Ingested:
    """Regular files as bronze rows: normalised texts with `_record_hash`; ragged rows, bad values and failed rules as rejects.

    Files are split by Spark's reader, so one large file takes as many tasks as it has blocks.
    """
    schema = ", ".join(f"`{c}` string" for c in contract.names)
    rows = read_clean(spark, paths, schema, contract.delimiter or ",")
    ragged = rows.filter("_corrupt IS NOT NULL").select(F.lit("RAGGED_ROW").alias("error_type"), F.lit(None).cast("string").alias("error_column"), F.col("_corrupt").alias("raw_line"))
    # Spark's reader makes empty fields null; to the tokens they are empty texts.
    made = normalised(rows.filter("_corrupt IS NULL").drop("_corrupt").fillna("", contract.names), contract)
    split = q.split(made.good.withColumn("_ordinal", F.monotonically_increasing_id()), contract.rules, "_ordinal")
    failed = split.rejects.select("error_type", "error_column", n.raw_line(*(F.col(c) for c in contract.names)).alias("raw_line"))
    good = split.good.drop("_ordinal").withColumn("_record_hash", n.record_hash(*(F.col(c) for c in hash_columns or contract.names)))
    return Ingested(good, ragged.unionByName(made.rejects).unionByName(failed), split.findings)


def load(spark: SparkSession, paths: str | Sequence[str], contract: DatasetContract, bronze: BronzeTable, run_id: int, counters: Counters | None = None) -> None:
    """Good rows of the files as a run of bronze; a run tried again replaces itself. counters gets `loaded.rows`."""
    good = ingest(spark, paths, contract).good
    bronze.append(counters.watch(good, "loaded") if counters else good, run_id)
