"""Mixing sources to target weights by hash thresholds, in native expressions only.

Each document has a place in its source's hash order. A source takes every document `copies` times, and those below a
threshold once more. The threshold comes from histograms: sizes summed by source and hash bucket show in which bucket
the budget ends, and only that bucket is looked at more closely, until it holds one hash. Documents are never sorted,
and a larger weight only adds documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .quality_rules import WORD
from .store import Scratch, fresh

WEIGHTS = (5, 2, 1)
#: Hexadecimal digits of the hash per histogram: 256 buckets.
DIGITS = 2
#: Sources whose thresholds may be broadcast: a row takes under 200 bytes.
BROADCAST_SOURCES = 20_000


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place_of(doc_id: Column, text: Column) -> Column:
    """32 hexadecimal digits; rows of equal id and text have the same, and are taken or left together."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.md5(text.cast("binary")), F.lit(""))).cast("binary"))


def source_key(source: Column) -> Column:
    """Never null, and equal for equal sources only."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, limit: int = 2) -> DataFrame:
    """sizes (key, source, source_size) with target: what is above limit times a source's size is shared out again by weight.

    Sources are ranked by need, limit * size / weight; those at their limit are the first ones, each judged by what is
    left after those before. One row per source goes through the two windows.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")).cast("long")
    full = F.col("source_size") * limit
    all_, before = Window.partitionBy(), Window.orderBy("need", "key").rowsBetween(Window.unboundedPreceding, -1)
    ranked = sizes.withColumn("weight", weight).withColumn("need", full.cast("double") / F.col("weight"))
    ranked = ranked.withColumn("budget", F.sum("source_size").over(all_) * F.lit(float(share)))
    left = F.col("budget") - F.coalesce(F.sum(full).over(before), F.lit(0))
    at_limit = F.col("need") <= left / (F.sum("weight").over(all_) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    ranked = ranked.withColumn("at_limit", at_limit)
    spent = F.coalesce(F.sum(F.when(F.col("at_limit"), full)).over(all_), F.lit(0))
    rest = F.coalesce(F.sum(F.when(~F.col("at_limit"), F.col("weight"))).over(all_), F.lit(1))
    return ranked.select("key", "source", "source_size", F.when(F.col("at_limit"), full.cast("double")).otherwise(F.col("weight") * (F.col("budget") - spent) / rest).alias("target"))


def _small(spark: SparkSession, table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES else table


def plan_mix(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, limit: int = 2) -> DataFrame:
    """Per source: key, source_size, target, copies and threshold, a text that the hashes taken once more lie below.

    The boundary document is taken if that brings the source nearer to its target, so the two differ by half the size
    of one document at most (of one group, if rows repeat). Null texts have size 0.
    """
    scratch = Scratch(spark, "mixing")
    places = scratch.keep(docs.select(source_key(F.col("source")).alias("key"), "source", size_of(F.col("text")).alias("size"), place_of(F.col("doc_id"), F.col("text")).alias("place")))
    sums = places.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    plan = targets(sums, weights, share, limit)
    copies = F.when(F.col("source_size") > 0, F.least(F.lit(limit), F.floor(F.col("target") / F.col("source_size")))).otherwise(0).cast("int")
    plan = scratch.keep(plan.withColumn("copies", copies).withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size")).drop("source"))
    done, open_ = [], plan.select("key", "rest", F.lit("").alias("prefix"), F.lit(0).cast("long").alias("below"))
    for level in range(32 // DIGITS):
        size = level * DIGITS
        inside = places.join(_small(spark, scratch.keep(open_)), "key").filter(F.substr("place", F.lit(1), F.lit(size)) == F.col("prefix"))
        bucket = F.substr("place", F.lit(1), F.lit(size + DIGITS))
        counts = inside.groupBy("key", "rest", "prefix", "below", bucket.alias("bucket")).agg(F.sum("size").alias("size"), F.min("place").alias("first"), F.max("place").alias("last"))
        before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("before", F.col("below") + F.coalesce(F.sum("size").over(before), F.lit(0)))
        edge = F.min(F.when(F.col("before") + F.col("size") > F.col("rest"), F.struct("bucket", "before", "size", "first", "last"))).alias("edge")
        edges = scratch.keep(counts.groupBy("key", "rest", "prefix").agg(edge))
        one = F.col("edge.first") == F.col("edge.last")
        nearer = F.col("edge.before") + F.col("edge.size") - F.col("rest") < F.col("rest") - F.col("edge.before")
        threshold = F.when(F.col("edge").isNull(), F.concat("prefix", F.lit("g"))).when(one, F.concat("edge.first", F.when(nearer, F.lit("0")).otherwise(F.lit(""))))
        edges = edges.withColumn("threshold", threshold)
        done.append(edges.filter("threshold IS NOT NULL").select("key", "threshold"))
        open_ = edges.filter("threshold IS NULL").select("key", "rest", F.col("edge.bucket").alias("prefix"), F.col("edge.before").alias("below"))
        if open_.isEmpty():
            break
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return scratch.keep(plan.join(found, "key", "left").select("key", "source_size", "target", "copies", F.coalesce("threshold", F.lit("")).alias("threshold")))


def mix(spark: SparkSession, docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, limit: int = 2, into: str = "mix") -> DataFrame:
    """docs with a struct named into, of size, source_size, target and copies, how often the mix takes the document.

    Null texts and texts without words have size 0: whether they are taken changes no sum, but it is never more than
    limit times. Null sources are one source. Rows of equal id and text are taken alike. A column of docs of the struct's
    name is replaced. An empty table gives an empty one.
    """
    key, plan = fresh(docs, "_key"), fresh(docs, "_plan")
    own = plan_mix(spark, docs, weights, share, limit).select(F.col("key").alias(key), F.struct("*").alias(plan))
    joined = docs.join(_small(spark, own), source_key(F.col("source")) == F.col(key))
    more = F.when(place_of(F.col("doc_id"), F.col("text")) < F.col(f"{plan}.threshold"), 1).otherwise(0)
    copies = F.least(F.col(f"{plan}.copies") + more, F.lit(limit))
    made = F.struct(size_of(F.col("text")).alias("size"), F.col(f"{plan}.source_size").alias("source_size"), F.col(f"{plan}.target").alias("target"), copies.alias("copies"))
    return joined.withColumn(into, made).drop(key, plan)


def take(mixed: DataFrame, into: str = "mix") -> DataFrame:
    """The documents that mix() takes, repeated as often as it takes them."""
    copy, copies = fresh(mixed, "_copy"), F.col(f"{into}.copies")
    return mixed.filter(copies > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), copies))).drop(copy, into)
