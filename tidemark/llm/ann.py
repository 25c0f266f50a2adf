"""Approximate nearest neighbours by adaptive dimension scan over inverted lists.

Vectors are turned by a random rotation and dealt to the lists of their nearest centroids. A query probes the lists
nearest to it. Within a list, distances grow block of columns by block of columns: after each block a hypothesis test
asks whether the part seen, scaled up to all dimensions, could still belong to a distance below the k-th best one, and
abandons those for which it could not. After a random rotation the part seen is a fair sample, so the test errs seldom.
Distances of those left are computed on the original vectors in double precision.

Centroids and the number of lists to probe are fitted on a bounded sample; every row is indexed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import Scratch

#: Bounds of the fit: lists, sampled rows per list, and bytes of the sample on the driver.
MAX_LISTS, ROWS_PER_LIST, SAMPLE_BYTES = 4096, 40, 1 << 26
COLUMNS = 16
#: The hypothesis test's width: 2.1 standard errors abandon a right candidate about once in a thousand tests.
EPSILON = 2.1
#: Recall that the probes must reach on held-out sampled queries.
AIM = 0.97
#: Candidates and queries that meet in one task; a list with more is split.
BLOCK, QUERIES = 20_000, 2_000


@dataclass
class Index:
    dim: int
    rotation: np.ndarray
    centroids: np.ndarray
    probes: int

    def nearest(self, x: np.ndarray, n: int) -> np.ndarray:
        d = (self.centroids**2).sum(1) - 2 * (x @ self.rotation) @ self.centroids.T
        return np.argmin(d, 1)[:, None] if n == 1 else np.argsort(d, 1, kind="stable")[:, :n]


def vectors_of(column: pa.Array, dim: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the usable vectors: of dim components, all finite, not all zero."""
    column = column.cast(pa.list_(pa.float64()))
    sizes = np.asarray(column.value_lengths().fill_null(0)) if hasattr(column, "value_lengths") else np.array([len(x) if x is not None else 0 for x in column.to_pylist()])
    at = np.flatnonzero(sizes == dim) if dim else np.zeros(0, np.int64)
    if not len(at):
        return at, np.zeros((0, dim or 0))
    flat = column.take(pa.array(at)).flatten()
    x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), dim)
    good = np.isfinite(x).all(1) & (x != 0).any(1)
    return at[good], x[good]


def _kmeans(x: np.ndarray, lists: int, rounds: int = 10) -> np.ndarray:
    different = np.unique(x, axis=0)  # else copies of one vector would take many lists
    lists = min(lists, len(different))
    centroids = different[np.linspace(0, len(different) - 1, lists).astype(int)]
    for _ in range(rounds):
        which = np.argmin((centroids**2).sum(1) - 2 * x @ centroids.T, 1)
        n = np.bincount(which, minlength=lists)
        sums = np.zeros_like(centroids)
        np.add.at(sums, which, x)
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
    return centroids


def fit(vectors: DataFrame, k: int, lists: int | None = None, seed: int = 17) -> Index | None:
    """vectors: id, vec. The sample is those with the smallest hashes of their ids; None if no vector is usable."""
    size = F.size("vec")
    shape = vectors.filter("size(vec) > 0").groupBy(size.alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    if shape is None:
        return None
    dim, rows = shape["dim"], shape["n"]
    lists = lists or max(1, min(MAX_LISTS, int(rows**0.5)))
    wanted = min(max(ROWS_PER_LIST * lists, 1000), max(lists, SAMPLE_BYTES // (8 * dim)))
    picked = vectors.filter(size == dim).select("vec", F.xxhash64("id", F.lit(seed)).alias("h")).orderBy("h").limit(wanted).select("vec").toArrow()
    _, x = vectors_of(picked.column("vec").combine_chunks() if picked.num_rows else pa.array([], pa.list_(pa.float64())), dim)
    if not len(x):
        return None
    lists = min(lists, len(x))
    random = np.random.default_rng(seed)
    rotation, r = np.linalg.qr(random.standard_normal((dim, dim)))
    rotation *= np.sign(np.diag(r))
    index = Index(dim, rotation, _kmeans(x @ rotation, lists), lists)
    lists = len(index.centroids)
    # Probes: until the held-out queries find AIM of their neighbours in the sample.
    own, queries = index.nearest(x, 1)[:, 0], x[:: max(1, len(x) // 200)]
    d = (queries**2).sum(1)[:, None] + (x**2).sum(1) - 2 * queries @ x.T
    near = np.argsort(d, 1)[:, 1 : k + 1]
    rank = np.argsort(index.nearest(queries, lists), 1)  # of each list, for each query
    needed = np.sort(np.take_along_axis(rank, own[near], 1).ravel())
    index.probes = int(needed[min(len(needed) - 1, int(AIM * len(needed)))]) + 1 if len(needed) else lists
    return index


def scan(columns: list[np.ndarray], original: np.ndarray, ids: np.ndarray, query: np.ndarray, turned: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest of a list: ids and distances, ties to smaller ids; own is left out."""
    dim, at = len(query), np.flatnonzero(ids != own)
    part, seen, limit = np.zeros(len(at)), 0, np.inf
    for block in columns:
        q = turned[seen : seen + block.shape[1]]
        part = part + ((block[at] - q) ** 2).sum(1)
        seen += block.shape[1]
        if seen == block.shape[1] and len(at) > k:  # the first bound: of the k most promising, the farthest
            first = at[np.argpartition(part, k - 1)[:k]]
            limit = ((original[first] - query) ** 2).sum(1).max()
        wide = 1.0 if seen == dim else (1 + EPSILON / seen**0.5) ** 2 * seen / dim
        stay = part <= limit * wide * (1 + 1e-9) + 1e-12
        at, part = at[stay], part[stay]
        if len(at) > 4 * k and seen < dim:  # a tighter bound
            first = at[np.argpartition(part, k - 1)[:k]]
            limit = min(limit, ((original[first] - query) ** 2).sum(1).max())
    d = ((original[at] - query) ** 2).sum(1)
    order = np.lexsort((ids[at], d))[:k]
    return ids[at][order], np.sqrt(d[order])


def _file(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = vectors_of(batch.column("vec"), index.dim)
            for a in range(0, len(at), 4096):
                own = index.nearest(x[a : a + 4096], 1)
                yield _rows(batch, at[a : a + 4096], own, np.ones(own.shape, bool))

    return run


def _ask(index: Index, sizes: np.ndarray, k: int):
    """Lists for each query: as many of those that hold rows as the fit asks for, and on until they hold more than k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = vectors_of(batch.column("vec"), index.dim)
            for a in range(0, len(at), 512):
                lists = index.nearest(x[a : a + 512], len(sizes)) if len(sizes) > 1 else np.zeros((len(at[a : a + 512]), 1), np.int64)
                rows = sizes[lists]
                enough = (np.cumsum(rows > 0, 1) >= index.probes) & (np.cumsum(rows, 1) > k)
                last = np.where(enough.any(1), enough.argmax(1), lists.shape[1] - 1)
                yield _rows(batch, at[a : a + 512], lists, (rows > 0) & (np.arange(lists.shape[1]) <= last[:, None]))

    return run


def _rows(batch: pa.RecordBatch, at: np.ndarray, lists: np.ndarray, wanted: np.ndarray) -> pa.RecordBatch:
    row = pa.array(np.repeat(at, wanted.sum(1)))
    vec = batch.column("vec").take(row).cast(pa.list_(pa.float64()))
    return pa.RecordBatch.from_arrays([pa.array(lists[wanted].astype(np.int32)), batch.column("id").take(row), vec], names=["list", "id", "vec"])


def _search(index: Index, k: int):
    def run(_, queries: pa.Table, candidates: pa.Table) -> pa.Table:
        ids = candidates.column("id").to_numpy()
        x = np.asarray(candidates.column("vec").combine_chunks().flatten()).reshape(-1, index.dim)
        turned = x @ index.rotation
        columns = [np.ascontiguousarray(turned[:, a : a + COLUMNS]) for a in range(0, index.dim, COLUMNS)]
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        q_ids = queries.column("id").to_numpy()
        q = np.asarray(queries.column("vec").combine_chunks().flatten()).reshape(-1, index.dim)
        for own, vector, t in zip(q_ids, q, q @ index.rotation, strict=True):
            found, d = scan(columns, x, ids, vector, t, own, k)
            out.append((np.full(len(found), own, np.int64), found, d))
        cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})

    return run


def nearest_neighbours(spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", lists: int | None = None) -> DataFrame:
    """query_id, rank from 1, vec_id and score, the Euclidean distance, of the k nearest found of each query.

    vectors and queries have id_col and vec_col. Rows without id, and vectors that are null, zero, of another length
    than most, or hold null or non-finite components take no part. A row is no candidate for a query of its own id.
    Equal distances rank by id. Rows of one id are candidates one by one. If ids don't repeat, a query gets fewer than k rows
    only if there are fewer candidates.
    """
    pick = lambda df: df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec")).filter("id IS NOT NULL")
    vectors, queries, scratch = pick(vectors), pick(queries), Scratch(spark, "ann")
    index = fit(vectors, k, lists)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    schema = "list int, id long, vec array<double>"
    filed = scratch.keep(vectors.mapInArrow(_file(index), schema))
    sizes = {r["list"]: r["count"] for r in filed.groupBy("list").count().collect()}
    held = np.array([sizes.get(i, 0) for i in range(len(index.centroids))])
    asked = scratch.keep(queries.mapInArrow(_ask(index, held, k), schema))
    loads = {r["list"]: r["count"] for r in asked.groupBy("list").count().collect()}
    splits = [(i, -(-n // BLOCK), -(-loads[i] // QUERIES)) for i, n in sizes.items() if i in loads]
    split = F.broadcast(spark.createDataFrame(pd.DataFrame(splits, columns=["list", "parts", "loads"]), "list int, parts int, loads int"))  # a row per list, of which there are MAX_LISTS at most
    key = ["list", "part", "load"]
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    candidates = filed.join(split, "list").withColumn("part", own("parts")).withColumn("load", every("loads")).select(*key, "id", "vec")
    asked = asked.join(split, "list").withColumn("load", own("loads")).withColumn("part", every("parts")).select(*key, "id", "vec")
    found = asked.groupBy(*key).cogroup(candidates.groupBy(*key)).applyInArrow(_search(index, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
