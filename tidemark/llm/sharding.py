"""Shards of near equal bytes by histogram sort.

Documents are ordered by a hash of their text, then of their id, so equal texts are neighbours: a group of them lies in one
shard, or, where it has to be cut for equal bytes, in consecutive ones. Splitters are found without sorting: exact bytes
below candidate keys are counted over all partitions, each splitter's bracket shrinks to the two candidates around its target,
and new ones are tried inside, until every splitter is within tolerance or between two neighbouring rows. Then one exchange
moves each document to its range, where it gets its slot. Shards are cut into ranges of bounded bytes, so that no task holds one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import Scratch, fresh

#: Keys have 60 bits: ten hexadecimal digits of the text's hash, and five that tell the rows of one text apart.
BITS = 60
LOW, HIGH = 0, 1 << BITS
#: Candidate keys tried inside each bracket in a round.
PROBES = 15
#: Bytes of a range, and ranges at most, whose splitters are broadcast: 40 bytes for each.
RANGE_BYTES, MAX_RANGES = 1 << 25, 1 << 16
_TEXT = "md5(cast(coalesce(text, '') as binary))"
KEY = f"cast(conv(concat(substr({_TEXT}, 1, 10), substr(md5(cast(concat(coalesce(cast(doc_id as string), ''), '|', {_TEXT}) as binary)), 1, 5)), 16, 10) as long)"
SIZE = "cast(coalesce(octet_length(text), 0) + 1 as long)"


def _counted(probes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_bytes, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
        for batch in batches:
            at = np.searchsorted(probes, batch.column("key").to_numpy(), side="right")
            np.add.at(n_bytes, at, batch.column("size").to_numpy())
            rows += np.bincount(at, minlength=len(rows))
        some = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n_bytes[some]), pa.array(rows[some])], names=["at", "bytes", "rows"])

    return run


def below(keyed: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows with a key under each probe; the driver gets one row per probe."""
    sums = keyed.mapInArrow(_counted(probes), "at long, bytes long, rows long").groupBy("at").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")).collect()
    n_bytes, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    for r in sums:
        n_bytes[r["at"]], rows[r["at"]] = r["bytes"], r["rows"]
    return np.cumsum(n_bytes)[:-1], np.cumsum(rows)[:-1]


def find_splitters(keyed: DataFrame, ranges: int, tolerance: float) -> list[int]:
    """ranges - 1 keys that split the rows of keyed (key, size) in ranges of near equal size; a key belongs to the range it starts."""
    total = keyed.agg(F.sum("size")).first()[0] or 0
    goals = [total * (k + 1) / ranges for k in range(ranges - 1)]
    # Of each goal: keys on both sides, with the bytes and rows below them.
    lo, hi = [(LOW, 0, 0)] * len(goals), [(HIGH, total, None)] * len(goals)
    open_ = list(range(len(goals))) if total else []
    while open_:
        probes = sorted({lo[k][0] + (hi[k][0] - lo[k][0]) * (i + 1) // (PROBES + 1) for k in open_ for i in range(PROBES)} | {hi[k][0] for k in open_ if hi[k][2] is None})
        counts = list(zip(probes, *(x.tolist() for x in below(keyed, np.array(probes, np.int64))), strict=True))
        at = 0
        still = []
        for k in open_:
            while at < len(counts) and counts[at][1] <= goals[k]:
                at += 1
            if at and counts[at - 1][0] > lo[k][0]:
                lo[k] = counts[at - 1]
            if at < len(counts) and (hi[k][2] is None or counts[at][0] < hi[k][0]):
                hi[k] = counts[at]
            near = min(goals[k] - lo[k][1], hi[k][1] - goals[k])
            lone = hi[k][2] is not None and hi[k][2] - lo[k][2] <= 1
            if near > tolerance and not lone and hi[k][0] - lo[k][0] > 1:
                still.append(k)
        open_ = still
    return sorted(lo[k][0] if goals[k] - lo[k][1] <= hi[k][1] - goals[k] else hi[k][0] for k in range(len(goals)))


def _ranged(spark: SparkSession, docs: DataFrame, splitters: list[int], key: str, range_: str) -> DataFrame:
    """docs with the number of splitters up to the key. Keys meet, by their first bits, the few splitters that share these."""
    bits = max(1, len(splitters).bit_length())
    prefix = [min(s, HIGH - 1) >> (BITS - bits) for s in splitters]
    starts = np.searchsorted(np.array(prefix, np.int64), np.arange((1 << bits) + 1), side="left")
    rows = [(p, int(starts[p]), splitters[starts[p] : starts[p + 1]]) for p in range(1 << bits)]
    names = [fresh(docs, n) for n in ("_prefix", "_before", "_splitters")]
    table = spark.createDataFrame(rows, f"`{names[0]}` long, `{names[1]}` int, `{names[2]}` array<long>")
    most = max(len(r[2]) for r in rows)
    steps = F.array(*(F.lit(1 << b) for b in reversed(range(max(1, most.bit_length())))))
    own = F.col(names[2])
    inside = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(own, at + step - 1) <= F.col(key), at + step).otherwise(at))
    joined = docs.join(F.broadcast(table), F.shiftright(key, BITS - bits) == F.col(names[0]))
    return joined.withColumn(range_, F.col(names[1]) + inside).drop(*names)


def shard_by_bytes(spark: SparkSession, docs: DataFrame, shards: int = 8, tolerance: float = 0.0, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """docs with shard (int) and slot (long, from 0 without gaps), replacing columns of these names.

    Sizes are UTF-8 bytes of the text plus one, 1 for a null text. Each shard ends at the row that comes nearest to equal sizes,
    or at one within tolerance of that, a fraction of a shard, which takes fewer rounds. Rows of equal id and text, nulls included, share a key and so a
    shard; rows of equal text lie in one shard or, if a group of them doesn't fit, in consecutive ones. docs needs doc_id
    and text; the same rows always give the same shards, whatever their order or partitions.
    """
    scratch = Scratch(spark, "sharding")
    keyed = scratch.keep(docs.select(F.expr(KEY).alias("key"), F.expr(SIZE).alias("size")))
    total = keyed.agg(F.sum("size")).first()[0] or 0
    per = max(1, min(MAX_RANGES // shards, -(-total // (shards * range_bytes))))
    splitters = find_splitters(keyed, shards * per, tolerance * total / shards)
    rows = below(keyed, np.array([*splitters, HIGH], np.int64))[1] if splitters else np.zeros(1, np.int64)
    first = [0, *rows[:-1].tolist()]  # rows before each range
    key, range_, offset = fresh(docs, "_key"), fresh(docs, "_range"), fresh(docs, "_offset")
    offsets = spark.createDataFrame([(r, first[r] - first[r - r % per]) for r in range(len(first))], f"`{range_}` int, `{offset}` long")
    ranged = docs.withColumn(key, F.expr(KEY))
    ranged = _ranged(spark, ranged, splitters, key, range_) if splitters else ranged.withColumn(range_, F.lit(0))
    placed = ranged.repartitionById(len(first), F.col(range_)).withColumn("slot", F.row_number().over(Window.partitionBy(range_).orderBy(key, "doc_id")))
    placed = placed.join(F.broadcast(offsets), range_)  # a row per range, MAX_RANGES at most
    return placed.withColumn("slot", (F.col("slot") - 1 + F.col(offset)).cast("long")).withColumn("shard", F.floor(F.col(range_) / per).cast("int")).drop(range_, key, offset)
