"""Near-duplicate classes by BagMinHash signatures, banding, and exact multiset overlap.

A document is the multiset of its word runs (`size` words each). Its signature has one minimum for each of `BANDS * ROWS`
components. Every run has, over the weight axis from 0 up, a Poisson process of points (weight, component, time) that
all documents share; a document sees the points whose weight lies below its own count of that run. The axis is cut in
blocks [0, 1), [1, 2), [2, 4), [4, 8), ... with one process each, so a run that occurs a million times costs twenty
blocks. Of each component the earliest point counts, so two documents agree on one with the probability of their
weighted Jaccard similarity. Points later than a horizon can't be earliest for any component and aren't made; a
document that leaves a component empty gets a horizon twice as far.

Rows of one band hash make a bucket. Within buckets not all pairs are compared: in each round some members (pivots) are
held against the others that are in another class so far, then leave. A bucket is done when all its members not yet
pivots are in one class, so every pair is either compared or already linked. Nothing is capped, and a bucket of
copies is done after one round. Later rounds, of the few buckets left, hold groups of pivots against blocks of members
inside a task, so that no row is made for a pair that turns out to be no link. Two texts whose numbers of runs differ by more than
the threshold allows can't be a link, so only the others are read. Groups and blocks are bounded in rows and bytes,
and each round takes four times as many pivots, so that a bucket of n texts that are all different takes log n rounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import Scratch
from .words import U64, Words, _power, find_words, mix64, pieces, shingles

#: Pairs that share no band are never compared: at similarity 0.8 these are 7 in 10 ** 5, with 6 rows they would be 7 in 10 ** 4.
BANDS, ROWS = 24, 5
#: Pivots that a task holds against a block of members, and members in a block.
PIVOTS, BLOCK = 256, 500
#: Bytes of texts in either, beyond which there is one more text at most; pivots of a bucket in one round at most.
GROUP_BYTES, MOST_PIVOTS = 1 << 23, 1 << 13
#: Contents whose texts are picked out by a broadcast of their ids, 16 bytes each, before the exchange.
FEW = 50_000
#: Together with the id it stands for a row; ids may be null or repeated.
TIE = "xxhash64(text)"
WORDLESS = r"text IS NULL OR NOT text RLIKE '[^\\x20\\x09-\\x0D]'"


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> U64(11)).astype(np.float64) + 1) * 2.0**-53


def bag_signature(key: np.ndarray, doc: np.ndarray, weight: np.ndarray, n_docs: int, components: int) -> np.ndarray:
    """Signatures (n_docs, components) of documents given as distinct (doc, key) with weights; inf where a document is empty."""
    total = np.bincount(doc, weights=weight, minlength=n_docs)
    out = np.full((n_docs, components), np.inf)
    todo = total > 0
    horizon = np.where(todo, (np.log(components) + 4) / np.maximum(total, 1), 0)
    while todo.any():
        mine = todo[doc]
        block = 0
        k, d, w = key[mine], doc[mine], weight[mine]
        flat = np.full(n_docs * components, np.inf)
        while len(k):
            low, width = (0, 1) if block == 0 else (1 << (block - 1), 1 << (block - 1))
            _points(flat, mix64(k ^ mix64(np.array([block + 1], U64))), d, w, low, width, horizon, components)
            more = w > low + width
            k, d, w, block = k[more], d[more], w[more], block + 1
        got = flat.reshape(n_docs, components)
        out[todo] = got[todo]
        todo &= np.isinf(out).any(axis=1)
        horizon *= 2
    return out


def _points(flat: np.ndarray, seed: np.ndarray, doc: np.ndarray, weight: np.ndarray, low: int, width: int, horizon: np.ndarray, components: int) -> None:
    rate = float(components) * width
    x = mix64(seed)
    u = _uniform(x)
    near = u > np.exp(-rate * horizon)[doc]  # the logarithm only for the few points within the horizon
    seed, doc, weight, x = seed[near], doc[near], weight[near], x[near]
    time = -np.log(u[near]) / rate
    step = 1
    while len(seed):
        z = mix64(x ^ U64(0x5851F42D4C957F2D))
        seen = slice(None) if width == 1 else low + (((z & U64(0xFFFFFFFF)) * U64(width)) >> U64(32)).astype(np.int64) < weight
        part = ((z >> U64(32)) * U64(components)) >> U64(32)
        np.minimum.at(flat, (doc * components + part.astype(np.int64))[seen], time[seen])
        x = mix64(seed + U64(step * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        time = time - np.log(_uniform(x)) / rate
        near = time < horizon[doc]
        seed, doc, weight, x, time = seed[near], doc[near], weight[near], x[near], time[near]
        step += 1


def bags(run: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct runs of each text, sorted, with their counts."""
    order = np.lexsort((run, of))
    run, of = run[order], of[order]
    new = np.ones(len(run), bool)
    new[1:] = (run[1:] != run[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(new)
    return run[at], of[at], np.diff(np.append(at, len(run)))


def _content(words: Words) -> np.ndarray:
    """128 bits of each text's word sequence."""
    n = np.diff(words.offsets)
    out = np.zeros((len(n), 2), U64)
    full = np.flatnonzero(n)
    if len(full):
        h = words.hashes()
        place = np.arange(len(h)) - np.repeat(words.offsets[:-1], n)
        up, down = _power(int(n.max()) + 1)
        out[full, 0] = np.add.reduceat(h * up[place], words.offsets[full])
        out[full, 1] = np.add.reduceat(mix64(h ^ U64(0x2545F4914F6CDD1D)) * down[place], words.offsets[full])
        out = mix64(out + n[:, None].astype(U64))
    return out


def _sign(size: int):
    components = BANDS * ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in pieces(batch.column("text")):
                w = find_words(data, offsets)
                key, doc, count = bags(*shingles(w, size))
                rows = np.flatnonzero(np.diff(w.offsets))
                if not len(rows):
                    continue
                sig = bag_signature(key, doc, count, to - at, components)[rows].view(U64).reshape(len(rows), BANDS, ROWS)
                band = np.tile(np.arange(BANDS, dtype=U64), (len(rows), 1))
                for k in range(ROWS):
                    band = mix64(band * U64(0x9E3779B97F4A7C15) ^ sig[:, :, k])
                own = _content(w)[rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(at, to - at).take(pa.array(rows)) for c in ("doc_id", "tie", "bytes")),
                        pa.array([x.tobytes() for x in own], pa.binary()),
                        pa.array(np.bincount(doc, weights=count, minlength=to - at)[rows].astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * BANDS), pa.array(band.reshape(-1).view(np.int64))),
                    ],
                    names=["doc_id", "tie", "bytes", "content", "n", "bands"],
                )

    return run


def overlaps(a: Words, b: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row by row, the sizes of the multiset intersection and union."""
    rows = len(a.offsets) - 1
    sides = [bags(*shingles(x, size)) for x in (a, b)]
    run, of, count = (np.concatenate(x) for x in zip(*sides, strict=True))
    total = np.bincount(of, weights=count, minlength=rows).astype(np.int64)
    order = np.lexsort((run, of))
    run, of, count = run[order], of[order], count[order]
    both = np.flatnonzero((run[1:] == run[:-1]) & (of[1:] == of[:-1]))
    common = np.bincount(of[both], weights=np.minimum(count[both], count[both + 1]), minlength=rows).astype(np.int64)
    return common, total - common


def _verify(size: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for at, to, data, offsets in pieces(batch.column("text_a")):
                a = find_words(data, offsets)
                other = [find_words(x, o) for _, _, x, o in pieces(batch.column("text_b").slice(at, to - at), 1 << 62)]
                common, union = overlaps(a, other[0], size)
                good.append(common >= threshold * union - 1e-9)
            keep = pa.array(np.concatenate(good)) if good else pa.array([], pa.bool_())
            own = ("a", "b", "root_a", "root_b")
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in own], names=list(own))

    return run


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges (a, b), by large-star and small-star steps; root is the smallest node."""
    edges, mark = scratch.keep(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.withColumnRenamed("m", "b"))
        old, edges = edges, scratch.keep(small.distinct())
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        scratch.drop(old)
        if now == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now


def _only(texts: DataFrame, members: DataFrame) -> DataFrame:
    """The texts of members, if these are few; else all, which a join narrows as well."""
    if members.count() > FEW:
        return texts
    return texts.join(F.broadcast(members.select("content").distinct()), "content", "left_semi")


def _hooked(links: DataFrame) -> DataFrame:
    """(root, new): each linked root with the smallest neighbour of its smallest neighbour, itself counted among them."""
    edges = links.select(F.col("root_a").alias("u"), F.col("root_b").alias("v"))
    low = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return low.alias("x").join(low.alias("y"), F.col("x.m") == F.col("y.u"), "left").select(F.col("x.u").alias("old"), F.coalesce(F.col("y.m"), F.col("x.m")).alias("new"))


def _first_pivots(members: DataFrame) -> DataFrame:
    """key, pivot and its root: of each bucket the member of the highest degree, the sum of the sizes of all its buckets.

    Where many texts differ from one more than from each other, that is the one.
    """
    top = members.groupBy("key").agg(F.max(F.struct("degree", "content", "runs")).alias("top"))
    return top.select("key", F.col("top.content").alias("pivot"), F.col("top.content").alias("pivot_root"), F.col("top.runs").alias("pivot_runs"))


def _open_buckets(members: DataFrame) -> DataFrame:
    """key, main (the largest class) and blocks of each bucket that is not done."""
    parts = members.groupBy("key", "root").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).groupBy("key")
    blocks = F.greatest(F.ceil(F.sum("n") / BLOCK), F.ceil(F.sum("bytes") / GROUP_BYTES)).cast("int").alias("blocks")
    return parts.agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("roots"), blocks).filter("roots > 1").drop("roots")


def _pivots(members: DataFrame, buckets: DataFrame, most: int) -> DataFrame:
    """key, group, content and root of up to most pivots of each open bucket, by degree; its largest class waits, the others give them."""
    order = Window.partitionBy("key").orderBy(F.desc("degree"), "content")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = members.join(buckets, "key").filter("root != main").withColumn("rank", F.row_number().over(order)).withColumn("sum", F.sum("bytes").over(upto))
    group = F.floor((F.col("rank") - 1) / PIVOTS) + F.floor((F.col("sum") - F.col("bytes")) / GROUP_BYTES)  # both only grow, so a group has the bounds of each
    return ranked.filter(F.col("rank") <= most).select("key", group.cast("int").alias("group"), "content", "root")


def _in_blocks(size: int, threshold: float):
    """Links between the pivots of a bucket and a block of its members, each read once; only those that join classes not yet joined here."""
    names = ["a", "b", "root_a", "root_b"]

    def bag_list(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        for at, _, data, offsets in pieces(column):
            yield at, *bags(*shingles(find_words(data, offsets), size))

    def run(_, members: pa.Table, pivots: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        joined: dict[bytes, bytes] = {}

        def top(x: bytes) -> bytes:
            while (y := joined.get(x, x)) != x:
                joined[x] = joined.get(y, y)
                x = y
            return x

        if members.num_rows and pivots.num_rows:
            own = [(c, r) for c, r in zip(pivots.column("pivot_content").to_pylist(), pivots.column("pivot_root").to_pylist(), strict=True)]
            held = {}
            for at, key, of, count in bag_list(pivots.column("pivot_text").combine_chunks()):
                for k in np.unique(of):
                    held[at + int(k)] = (key[of == k], count[of == k])
            contents, roots = members.column("content").to_pylist(), members.column("root").to_pylist()
            for at, key, of, count in bag_list(members.column("text").combine_chunks()):
                total = np.bincount(of, weights=count)
                by_size = np.argsort(total, kind="stable")
                sizes, place_of = total[by_size], np.empty(len(total), np.int64)
                place_of[by_size] = np.arange(len(total))
                order = np.argsort(place_of[of], kind="stable")
                key, of, count = key[order], place_of[of][order], count[order]
                edge = np.searchsorted(of, np.arange(len(total) + 1))
                for k, (pivot_key, pivot_count) in held.items():
                    own_size = pivot_count.sum()
                    lo, hi = np.searchsorted(sizes, threshold * own_size - 1e-6), np.searchsorted(sizes, own_size / threshold + 1e-6, side="right")
                    lo = max(lo, np.searchsorted(sizes, 0, side="right"))
                    if lo >= hi:
                        continue
                    run = slice(edge[lo], edge[hi])
                    place = np.minimum(np.searchsorted(pivot_key, key[run]), len(pivot_key) - 1)
                    same = pivot_key[place] == key[run]
                    common = np.bincount(of[run][same] - lo, weights=np.minimum(count[run][same], pivot_count[place[same]]), minlength=hi - lo)
                    near = common >= threshold * (sizes[lo:hi] + own_size - common) - 1e-9
                    for m in by_size[lo + np.flatnonzero(near)]:
                        x, y = (contents[at + m], roots[at + m]), own[k]
                        if (p := top(x[1])) != (q := top(y[1])):
                            joined[p] = q
                            x, y = min(x, y), max(x, y)
                            rows.append((x[0], y[0], x[1], y[1]))
        return pa.table({n: pa.array([r[k] for r in rows], pa.binary()) for k, n in enumerate(names)})

    return run


def _block_links(open_: DataFrame, pivots: DataFrame, buckets: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    key = ["key", "block", "group"]
    groups = pivots.groupBy("key").agg(F.collect_set("group").alias("groups"))
    members = open_.join(buckets.join(groups, "key"), "key").withColumn("block", F.pmod(F.xxhash64("content"), F.col("blocks")).cast("int"))
    members = members.join(texts, "content").select("key", "block", F.explode("groups").alias("group"), "content", "root", "text")
    asked = pivots.join(buckets, "key").join(texts, "content").select("key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "group", "content", "root", "text")
    asked = asked.select(*(F.col(c).alias(f"pivot_{c}") for c in asked.columns))
    return members.groupBy(*key).cogroup(asked.groupBy(*(f"pivot_{c}" for c in key))).applyInArrow(_in_blocks(size, threshold), "a binary, b binary, root_a binary, root_b binary")


def _pair_links(open_: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """As there is one pivot, which a pair of texts has in common in many buckets, distinct pairs are fewest."""
    pairs = open_.filter("pivot_root != root").filter(F.least("runs", "pivot_runs") >= threshold * F.greatest("runs", "pivot_runs") - 1e-6)
    swap = F.col("content") > F.col("pivot")
    both = F.struct("content", "root"), F.struct(F.col("pivot").alias("content"), F.col("pivot_root").alias("root"))
    pairs = pairs.select(F.when(swap, both[1]).otherwise(both[0]).alias("x"), F.when(swap, both[0]).otherwise(both[1]).alias("y"))
    pairs = pairs.select(F.col("x.content").alias("a"), F.col("x.root").alias("root_a"), F.col("y.content").alias("b"), F.col("y.root").alias("root_b")).distinct()
    full = pairs.join(texts.select(F.col("content").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("content").alias("b"), F.col("text").alias("text_b")), "b")
    return full.select("a", "b", "root_a", "root_b", "text_a", "text_b").mapInArrow(_verify(size, threshold), "a binary, b binary, root_a binary, root_b binary")


def _link(scratch: Scratch, members: DataFrame, texts: DataFrame, size: int, threshold: float) -> list[DataFrame]:
    """Tables of verified links (a, b) that connect all contents that links of any kind connect.

    members: key, content, degree, bytes, runs. Between rounds links are only followed two steps, which may leave one class under
    several roots; that costs comparisons, not links.
    """
    found: list[DataFrame] = []
    columns = ["key", "content", "degree", "bytes", "runs"]
    members = members.withColumn("root", F.col("content"))
    for turn in range(1 << 30):
        if turn == 0:
            pivots = scratch.keep(_first_pivots(members))
            if pivots.isEmpty():
                return found
            open_ = members.join(pivots, "key")
            links = scratch.keep(_pair_links(open_, texts, size, threshold))
            rest = open_.filter("pivot != content").select(*columns, "root")
        else:
            buckets = scratch.keep(_open_buckets(members))
            if buckets.isEmpty():
                return found
            pivots = scratch.keep(_pivots(members, buckets, min(MOST_PIVOTS, PIVOTS * 4 ** (turn - 1))))
            open_ = scratch.keep(members.join(buckets.select("key"), "key", "left_semi"))
            links = scratch.keep(_block_links(open_, pivots, buckets, _only(texts, open_), size, threshold).distinct())
            rest = open_.join(pivots.select("key", "content"), ["key", "content"], "left_anti").select(*columns, "root")
        if not links.isEmpty():
            found.append(links.select("a", "b"))
            rest = rest.join(_hooked(links), F.col("root") == F.col("old"), "left").select(*columns, F.coalesce("new", "root").alias("root"))
        old, members = members, scratch.keep(rest)
        if turn:
            scratch.drop(old, open_, buckets)
        scratch.drop(pivots)
        scratch.release()
    raise AssertionError("a round without end")


def near_duplicate_classes(spark: SparkSession, docs: DataFrame, threshold: float = 0.8, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, tie, class_id, class_rows, keeper_id, keeper_tie and n_runs.

    Documents belong to one class if links of similarity `threshold` or more lead from one to the other. class_id is the
    smallest id in the class, null only if all its ids are. (keeper_id, keeper_tie) names the document that stays: of the
    smallest id, then hash. Texts of fewer than `size` words have all their words as one run; null texts and texts
    without words have no runs, are like nothing, and form classes of one row. Other columns of docs take no part.
    """
    scratch = Scratch(spark, "bagminhash")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("tie", F.expr(TIE))
    sized = docs.withColumn("bytes", F.octet_length("text").cast("long"))
    signed = scratch.keep(sized.mapInArrow(_sign(size), "doc_id long, tie long, bytes long, content binary, n long, bands array<long>"))
    named = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "tie")
    contents = scratch.keep(signed.groupBy("content").agg(F.min(named).alias("rep"), F.count("*").alias("copies"), F.max("bytes").alias("bytes"), F.first("n").alias("runs"), F.first("bands").alias("bands")))
    spread = contents.select("content", "bytes", "runs", F.explode("bands").alias("key"))
    shared = scratch.keep(spread.join(scratch.keep(spread.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")), "key"))
    members = scratch.keep(shared.join(shared.groupBy("content").agg(F.sum("n").alias("degree")), "content").select("key", "content", "degree", "bytes", "runs"))
    scratch.drop(shared)
    asked = members.select("content").distinct().join(contents, "content").select("content", F.col("rep.doc_id").alias("rep_id"), F.col("rep.tie").alias("rep_tie"))
    texts = docs.join(asked, (F.col("tie") == F.col("rep_tie")) & F.col("doc_id").eqNullSafe(F.col("rep_id"))).dropDuplicates(["rep_id", "rep_tie"]).select("content", "text")
    texts = scratch.keep(texts)
    scratch.release()
    found = _link(scratch, members, texts, size, threshold)
    labels = components(scratch, reduce(DataFrame.unionByName, found)) if found else None
    scratch.drop(members, texts)
    rooted = contents.select("content", "rep", "copies")
    rooted = rooted.withColumn("root", F.col("content")) if labels is None else rooted.join(labels, F.col("content") == F.col("node"), "left").select("content", "rep", "copies", F.coalesce("root", "content").alias("root"))
    classes = rooted.groupBy("root").agg(F.min("rep").alias("keeper"), F.sum("copies").alias("class_rows"))
    of_content = rooted.select("content", "root").join(classes, "root")
    rows = signed.select("doc_id", "tie", "content", "n").join(of_content, "content")
    rows = rows.select("doc_id", "tie", F.col("keeper.doc_id").alias("class_id"), "class_rows", F.col("keeper.doc_id").alias("keeper_id"), F.col("keeper.tie").alias("keeper_tie"), F.col("n").alias("n_runs"))
    alone = docs.filter(WORDLESS).select("doc_id", F.coalesce("tie", F.lit(0).cast("long")).alias("tie"), F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_rows"), F.col("doc_id").alias("keeper_id"), F.col("tie").alias("keeper_tie"), F.lit(0).cast("long").alias("n_runs"))
    return rows.unionByName(alone)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, threshold: float = 0.8, size: int = 5) -> DataFrame:
    """The rows of docs (columns doc_id, text and any others) without all but one document of each class.

    Documents without words all stay. Of rows with equal id and text one stays.
    """
    found = near_duplicate_classes(spark, docs, threshold, size).filter("n_runs > 0")
    keepers = found.filter(F.col("doc_id").eqNullSafe(F.col("keeper_id")) & (F.col("tie") == F.col("keeper_tie"))).groupBy("doc_id", "tie").agg(F.count("*").alias("same"))
    keepers = keepers.select(F.col("doc_id").alias("_keeper_id"), F.col("tie").alias("_keeper_tie"), F.col("same").alias("_same"))
    kept = docs.join(keepers, (F.expr(TIE) == F.col("_keeper_tie")) & F.col("doc_id").cast("long").eqNullSafe(F.col("_keeper_id")))
    once = kept.filter("_same = 1").select(*docs.columns)
    more = kept.filter("_same > 1").dropDuplicates(["_keeper_id", "_keeper_tie"]).select(*docs.columns)
    return once.unionByName(more).unionByName(docs.filter(WORDLESS))
