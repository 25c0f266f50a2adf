"""URL filters by temporal list join: a capture is judged by the list entries in force when it was fetched.

Dated additions and removals of a list's entries become validity intervals. A capture has a few keys, the host and
each parent domain and each path prefix as deep as some entry's, and meets the intervals of equal key in an as-of join. Intervals are cut at
period ends, so that of an entry that changes often only the changes of one period meet a capture.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import fresh

#: Days of a period.
PERIOD = 64
FOREVER = "9999-12-31"


def normal_url(url: Column) -> Column:
    """Host and path in lower case without scheme, user, port, www., query and fragment; empty for a null."""
    bare = F.regexp_replace(F.lower(F.trim(F.coalesce(url, F.lit("")))), r"^[a-z][a-z0-9+.-]*://", "")
    bare = F.regexp_replace(F.regexp_replace(bare, r"[?#].*$", ""), r"^[^/@]*@", "")
    return F.regexp_replace(F.regexp_replace(bare, r"^([^/:]*):[0-9]*", "$1"), r"^www\.", "")


def depths_of(entries: DataFrame) -> DataFrame:
    """One row with depths, the distinct numbers of path parts in `p:` keys; a prefix of another depth equals none of them."""
    parts = F.length("key") - F.length(F.replace("key", F.lit("/"), F.lit("")))
    return entries.filter("key LIKE 'p:%'").agg(F.collect_set(parts).alias("depths"))


def keys_of(url: Column, depths: Column) -> Column:
    """`d:` keys for the host and its parent domains, `p:` keys for the host with each path prefix of one of the depths."""
    bare = normal_url(url)
    host = F.substring_index(bare, "/", 1)
    labels = F.split(host, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.concat(F.lit("d:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    parts = F.filter(F.split(F.regexp_replace(bare, "^[^/]*/?", ""), "/"), lambda x: x != "")
    deep = F.filter(depths, lambda n: (n > 0) & (n <= F.size(parts)))
    prefixes = F.transform(deep, lambda n: F.concat(F.lit("p:"), host, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), n), "/")))
    return F.when(host != "", F.array_distinct(F.concat(parents, prefixes))).otherwise(F.array().cast("array<string>"))


def validity(entries: DataFrame) -> DataFrame:
    """entries (list, key, action `add` or `remove`, on: date) as intervals (list, key, since, until), until exclusive.

    Of several changes on one day a removal wins. A change that repeats the state before it changes nothing. Entries with
    nulls, or of another action, take no part.
    """
    clean = entries.filter("list IS NOT NULL AND key IS NOT NULL AND on IS NOT NULL AND action IN ('add', 'remove')")
    daily = clean.groupBy("list", "key", "on").agg(F.min(F.when(F.col("action") == "add", 1).otherwise(0)).alias("active"))
    order = Window.partitionBy("list", "key").orderBy("on")
    changes = daily.withColumn("was", F.lag("active", 1, 0).over(order)).filter("active != was")
    return changes.withColumn("until", F.coalesce(F.lead("on").over(order), F.lit(FOREVER).cast("date"))).filter("active = 1").select("list", "key", F.col("on").alias("since"), "until")


def _period(day: Column) -> Column:
    return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / PERIOD).cast("int")


def judge(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """captures with lists, the sorted names of the lists that held the capture when it was fetched, and blocked.

    A capture without url or time is held by no list. Equal captures are judged once. Columns of captures named lists or
    blocked are replaced.
    """
    asked = captures.select(F.col(url_col).alias("_url"), F.col(time_col).cast("date").alias("_day")).filter("_url IS NOT NULL AND _day IS NOT NULL").distinct()
    deep = asked.crossJoin(F.broadcast(depths_of(entries)))  # one row
    keyed = deep.withColumn("key", F.explode(keys_of(F.col("_url"), F.col("depths")))).drop("depths").withColumn("period", _period(F.col("_day")))
    span = asked.agg(F.min("_day").alias("first"), F.max("_day").alias("last"))
    valid = validity(entries).join(F.broadcast(span), (F.col("since") <= F.col("last")) & (F.col("until") > F.col("first")))  # span is one row
    cut = valid.withColumn("period", F.explode(F.sequence(_period(F.greatest("since", "first")), _period(F.least(F.date_sub("until", 1), F.col("last"))))))
    held = keyed.join(cut.select("list", "key", "since", "until", "period"), ["key", "period"]).filter("_day >= since AND _day < until")
    lists = held.groupBy("_url", "_day").agg(F.array_sort(F.collect_set("list")).alias("lists"))
    url, day = fresh(captures, "_url"), fresh(captures, "_day")
    lists = lists.withColumnsRenamed({"_url": url, "_day": day})
    joined = captures.drop("lists", "blocked").join(lists, (F.col(url_col) == F.col(url)) & (F.col(time_col).cast("date") == F.col(day)), "left").drop(url, day)
    return joined.withColumn("lists", F.coalesce("lists", F.array().cast("array<string>"))).withColumn("blocked", F.size("lists") > 0)
