"""Finding files: listing, integrity, content hashes, multipart groups, markers, and the manifest a run works from."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from fnmatch import fnmatch

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reconcile import duplicate_files

EXTENSIONS = (".csv", ".csv.gz", ".csv.zip")
MARKER_SCHEMA = "expected_row_count long, expected_checksum string"


def list_files(spark: SparkSession, path: str, glob: str | None = None, content: bool = False) -> DataFrame:
    """path, name, length, modified and, if asked for, content_sha256 of the files below a folder.

    The listing is the file system's own, as Spark's readers leave out empty files. Hashes are made where files are read.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    found, rows = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True), []
    while found.hasNext():
        f = found.next()
        if glob is None or fnmatch(f.getPath().getName(), glob):
            rows.append((f.getPath().toString(), f.getPath().getName(), f.getLen(), f.getModificationTime()))
    listed = spark.createDataFrame(rows, "path string, name string, length long, ms long").select("path", "name", "length", F.timestamp_millis("ms").alias("modified"))
    if not content:
        return listed
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    hashes = reader.load(path).select(plain("path").alias("_path"), F.sha2("content", 256).alias("content_sha256"))
    joined = listed.join(hashes, plain("path") == F.col("_path"), "left").drop("_path")
    return joined.withColumn("content_sha256", F.when(F.col("length") == 0, F.sha2(F.lit(b""), 256)).otherwise(F.col("content_sha256")))


def integrity(listing: DataFrame, extensions: Sequence[str] = EXTENSIONS) -> DataFrame:
    """listing with status and reason: ACCEPTED, or REJECTED for the extension or an empty file."""
    known = F.lit(False)
    for e in extensions:
        known = known | F.lower("name").endswith(e)
    reason = F.when(~known, "unsupported-extension").when(F.col("length") == 0, "empty-file")
    return listing.withColumn("reason", reason).withColumn("status", F.when(reason.isNull(), "ACCEPTED").otherwise("REJECTED"))


def stable(listing: Callable[[], DataFrame], wait: float = 5.0) -> DataFrame:
    """Files that two listings, some seconds apart, show alike. The first one is kept on the driver's side as rows of names and sizes."""
    spark = listing().sparkSession
    first = listing().select("path", "length", "modified").toPandas()
    time.sleep(wait)
    before = spark.createDataFrame(first, "path string, length long, modified timestamp") if len(first) else spark.createDataFrame([], "path string, length long, modified timestamp")
    return listing().join(before, ["path", "length", "modified"], "left_semi")


def multipart(listing: DataFrame, regex: str, group: int = 1, index: int = 2) -> DataFrame:
    """Groups of parts: group, parts in order of index, first_index, n and error if an index is missing or twice. Names that don't match take no part."""
    found = listing.filter(F.col("name").rlike(regex)).select(F.regexp_extract("name", regex, group).alias("group"), F.regexp_extract("name", regex, index).cast("int").alias("index"), "path")
    grouped = found.groupBy("group").agg(F.sort_array(F.collect_list(F.struct("index", "path"))).alias("parts"), F.min("index").alias("first_index"), F.max("index").alias("last"), F.countDistinct("index").alias("distinct_n"), F.count("*").alias("n"))
    whole = (F.col("last") - F.col("first_index") + 1 == F.col("n")) & (F.col("distinct_n") == F.col("n"))
    return grouped.select("group", F.transform("parts", lambda p: p["path"]).alias("parts"), "first_index", "n", F.when(~whole, "multipart-group-incomplete").alias("error"))


def group_hash(hashes: Column) -> Column:
    """The hash of a group: of its parts' hashes in order, joined by bars."""
    return F.sha2(F.array_join(hashes, "|").cast("binary"), 256)


def marked(listing: DataFrame, markers: DataFrame, marker: str) -> DataFrame:
    """listing without the marker, with its expected counts; nothing at all while the marker is absent or invalid.

    markers: name and text of candidate markers.
    """
    parsed = markers.filter(F.col("name") == marker).select(F.from_json("text", MARKER_SCHEMA, {"mode": "PERMISSIVE"}).alias("m")).filter("m.expected_row_count >= 0 AND (m.expected_checksum IS NULL OR length(m.expected_checksum) <= 128)").select("m.*").limit(1)
    return listing.filter(F.col("name") != marker).crossJoin(F.broadcast(parsed))  # one row


def candidates(listing: DataFrame, known: DataFrame, max_units: int | None = None, skip_duplicates: bool = True) -> DataFrame:
    """The manifest: accepted files in order of their path, without those whose content came before, at most max_units of them.

    listing: dataset_id, file_id, path, content_sha256, status; known: earlier files with the same columns.
    """
    columns = ["dataset_id", "file_id", "path", "content_sha256"]
    old = known.select(*columns, F.lit(False).alias("_new"))
    everything = duplicate_files(listing.filter("status = 'ACCEPTED'").select(*columns, F.lit(True).alias("_new")).unionByName(old)).filter("_new").drop("_new")
    if skip_duplicates:
        everything = everything.filter("duplicate_of_file_id IS NULL")
    ordered = everything.orderBy("path")
    return ordered.limit(max_units) if max_units is not None else ordered
