"""Exact substring removal across a corpus with suffix automata of reference shards.

A window is `length` consecutive words of one document. A word goes if a window that covers it also starts earlier: in
a document of smaller id, or in the same document further left.

The corpus is its own reference, so one automaton for all of it has no size bound and can't be broadcast. It is cut
into shards by content instead, so that equal windows always meet in one shard:

1. Every window is filed under its anchor, the leftmost smallest hash among its runs of `ANCHOR` words. Equal windows
   have equal anchors in equal places. Anchors are counted with map-side sums; windows under an anchor found once
   can't repeat, and stop here.
2. Windows of one anchor occurrence form a context of consecutive words. Equal contexts are reduced to the first one
   by a pre-aggregated minimum; each later one repeats as a whole. So a passage that a third of all documents hold
   is one row from here on.
3. The different contexts of each anchor are the reference. They are dealt to bounded shards by a hash of their anchor;
   each shard streams its contexts in document order through the suffix automaton of those before: where the matching
   statistic reaches `length`, the window that ends there repeats; then the context is added. An automaton holds at most
   `HOT` words: windows of an anchor with more are compared one by one, by a pre-aggregated minimum over their words.
4. The windows found go back to their documents, whose words are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import Scratch
from .words import _STEP, U64, Words, find_words, mix64, pieces

#: Words in an anchor; longer ones are rarer by chance, shorter ones leave fewer of them.
ANCHOR = 8
#: Words of one anchor's contexts that make one reference shard, some 50 MB as an automaton; beyond that, each window is one.
HOT = 1 << 16
#: Together with the id it stands for a document; ids may be null or repeated.
TIE = "xxhash64(text)"


def _runs(h: np.ndarray, size: int) -> np.ndarray:
    out = h[: len(h) - size + 1].copy()
    for k in range(1, size):
        out = out * _STEP + h[k : len(h) - size + 1 + k]
    return mix64(out)


def _span_hash(h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the words h[start:end] of each span, independent of those of _runs."""
    out = (ends - starts).astype(U64)
    step = U64(0xA0761D6478BD642F)
    g = mix64(h ^ U64(0xE7037ED1A0B428DB))
    longest = int((ends - starts).max(initial=0))
    for k in range(longest):
        at = starts + k
        more = at < ends
        out[more] = out[more] * step + g[at[more]]
    return mix64(out)


def contexts_of(words: Words, length: int) -> dict[str, np.ndarray]:
    """Of each anchor occurrence: its hash, the text, the first window's start in the text, the number of its windows, and a hash of the context."""
    h = words.hashes()
    none = {k: np.zeros(0, t) for k, t in (("anchor", U64), ("text", np.int64), ("lo", np.int64), ("n", np.int64), ("context", U64))}
    size = min(ANCHOR, length)
    if len(h) < length:
        return none
    owner = words.text_of()
    grams = _runs(h, size)
    spread = length - size + 1
    best, where = grams.copy(), np.arange(len(grams))
    done = 1
    while done < spread:  # the leftmost minimum of the next 2, 4, ... and spread anchors
        step = min(done, spread - done)
        better = best[step:] < best[: len(best) - step]
        best, where = np.where(better, best[step:], best[: len(best) - step]), np.where(better, where[step:], where[: len(where) - step])
        done += step
    n = len(h) - length + 1
    valid = np.flatnonzero(words.offsets[1:][owner[:n]] - np.arange(n) >= length)
    if not len(valid):
        return none
    place = where[valid]
    new = np.ones(len(valid), bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[valid[1:]] != owner[valid[:-1]])
    lo = valid[new]
    count = np.diff(np.append(np.flatnonzero(new), len(valid)))
    text = owner[lo]
    off = (place[new] - lo).astype(U64)
    return {"anchor": grams[place[new]], "text": text, "lo": lo - words.offsets[text], "n": count, "context": mix64(_span_hash(h, lo, lo + count - 1 + length) + off)}


def _anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in pieces(batch.column("text")):
                c = contexts_of(find_words(data, offsets), length)
                if len(c["lo"]):
                    own = pa.array(c["text"])
                    ids, ties = (batch.column(x).slice(at, to - at).take(own) for x in ("doc_id", "tie"))
                    spot = (c["lo"] << 16) | c["n"]
                    yield pa.RecordBatch.from_arrays([pa.array(c["anchor"].view(np.int64)), pa.array(c["context"].view(np.int64)), ids, ties, pa.array(spot)], names=["anchor", "context", "doc_id", "tie", "spot"])

    return run


def _anchor_hashes(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in pieces(batch.column("text")):
                found, n = np.unique(contexts_of(find_words(data, offsets), length)["anchor"], return_counts=True)
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["anchor", "n"])

    return run


class SuffixAutomaton:
    """Of several sequences, added one after the other; steps are the words' hashes."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, sequence: list[int]) -> None:
        nxt, link, length, last = self.next, self.link, self.length, 0
        for c in sequence:
            if (q := nxt[last].get(c)) is not None:  # known from an earlier sequence
                last = q if length[q] == length[last] + 1 else self._split(last, q, c)
                continue
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                link[cur] = q if length[q] == length[p] + 1 else self._split(p, q, c)
            last = cur

    def _split(self, p: int, q: int, c: int) -> int:
        twin = len(self.next)
        self.next.append(self.next[q].copy())
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = twin
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = twin
            p = self.link[p]
        return twin

    def statistics(self, sequence: list[int]) -> list[int]:
        """For each end, the length of the longest suffix that occurs in what was added."""
        nxt, link, length, state, n, out = self.next, self.link, self.length, 0, 0, []
        for c in sequence:
            while state and c not in nxt[state]:
                state = link[state]
                n = length[state]
            q = nxt[state].get(c)
            if q is None:
                n = 0
            else:
                state, n = q, n + 1
            out.append(n)
        return out


def _cut(length: int):
    """Words of contexts, whole or window by window, from the texts that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, wanted = batch.column("text"), batch.column("wanted").to_pylist()
            ids, ties = batch.column("doc_id").to_pylist(), batch.column("tie").to_pylist()
            rows: list[tuple] = []
            for at, to, data, offsets in pieces(column):
                w = find_words(data, offsets)
                h = w.hashes().view(np.int64)
                for d in range(at, to):
                    base = w.offsets[d - at]
                    for x in wanted[d]:
                        lo, n = x["spot"] >> 16, x["spot"] & 0xFFFF
                        if not x["hot"]:
                            rows.append((x["anchor"], x["context"], x["anchor"], ids[d], ties[d], x["spot"], -1, h[base + lo : base + lo + n - 1 + length].tobytes()))
                            continue
                        for k in range(n):
                            own = h[base + lo + k : base + lo + k + length].tobytes()
                            rows.append((x["anchor"], x["context"], int.from_bytes(hashlib.blake2b(own, digest_size=8).digest(), signed=True), ids[d], ties[d], x["spot"], k, own))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (*[pa.int64()] * 6, pa.int32(), pa.binary()), strict=True)], names=["anchor", "context", "deal", "doc_id", "tie", "spot", "first", "words"])

    return run


def _stream(length: int):
    """Rows come by shard, deal and document order; each deal has an automaton of its own, which is as exact as one for the shard since windows under different deals differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deal, automaton = None, SuffixAutomaton()
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for anchor, context, own, raw in zip(*(batch.column(c).to_pylist() for c in ("anchor", "context", "deal", "words")), strict=True):
                if own != deal:
                    deal, automaton = own, SuffixAutomaton()
                sequence = np.frombuffer(raw, np.int64).tolist()
                found = automaton.statistics(sequence)
                mask = sum(1 << k for k, n in enumerate(found[length - 1 :]) if n >= length)
                if mask:
                    out.append((anchor, context, mask))
                if mask.bit_count() <= len(sequence) - length:
                    automaton.add(sequence)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["anchor", "context", "mask"])

    return run


def _remove(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = batch.column("hits").to_pylist()
            kept, n_words, n_removed = [], [], []
            for at, to, data, offsets in pieces(batch.column("text")):
                w = find_words(data, offsets)
                for d in range(at, to):
                    a, b = w.offsets[d - at], w.offsets[d - at + 1]
                    starts, ends = w.starts[a:b], w.ends[a:b]
                    if hits[d]:
                        edge = np.zeros(b - a + 1, np.int64)
                        for x in hits[d]:
                            lo, mask, k = x["spot"] >> 16, x["mask"], 0
                            while mask:
                                if mask & 1:
                                    edge[lo + k] += 1
                                    edge[lo + k + length] -= 1
                                mask, k = mask >> 1, k + 1
                        left = np.cumsum(edge[:-1]) == 0
                        starts, ends = starts[left], ends[left]
                    n_words.append(int(b - a))
                    n_removed.append(int(b - a - len(starts)))
                    kept.append(_join(data, starts, ends))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])

    return run


def _join(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """Words joined by one space."""
    if not len(starts):
        return b""
    sizes = ends - starts + 1
    to = np.cumsum(sizes)
    out = np.full(int(to[-1]), 0x20, np.uint8)
    at = np.arange(len(out)) - np.repeat(to - sizes - starts, sizes)
    word = np.ones(len(out), bool)
    word[to - 1] = False
    out[word] = data[at[word]]
    return out[:-1].tobytes()


def remove_repeated_spans(spark: SparkSession, docs: DataFrame, length: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents as doc_id, n_words, n_removed and kept_text, what is left with one space between words.

    Null or empty texts have no words and an empty kept_text. Null ids come after all others. Rows of equal id and
    text are one document and get equal results; rows of one id with different texts are ordered by a hash of the
    text. Other columns of docs, whatever their names, take no part. Texts may have up to 2 ** 31 words.
    """
    if not 2 <= length <= ANCHOR + 40:
        raise ValueError(f"length must be from 2 to {ANCHOR + 40}")  # masks of windows are 63 bits
    scratch = Scratch(spark, "substring")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("tie", F.expr(TIE))
    texts = docs.filter(F.length("text") >= 2 * length - 1)
    counted = texts.select("text").mapInArrow(_anchor_hashes(length), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    repeated = scratch.keep(counted.filter("n > 1").select("anchor"))  # by itself, so that the join below may split a hot anchor
    scratch.release()
    found = scratch.keep(texts.mapInArrow(_anchors(length), "anchor long, context long, doc_id long, tie long, spot long").join(repeated, "anchor"))
    scratch.drop(repeated)
    scratch.release()
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "tie", "spot")
    firsts = scratch.keep(found.groupBy("anchor", "context").agg(F.min(place).alias("first")).select("anchor", "context", "first.doc_id", "first.tie", "first.spot"))
    cut = scratch.keep(_words_of_contexts(scratch, texts, firsts, length))
    scratch.release()
    masked = scratch.keep(_masked(firsts, cut, length))
    scratch.drop(firsts, cut)
    scratch.release()
    return _removed(docs, found, masked, length)


def _same(a: str, b: str) -> Column:
    return (F.col(f"{a}.tie") == F.col(f"{b}.tie")) & F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id"))


def _words_of_contexts(scratch: Scratch, texts: DataFrame, firsts: DataFrame, length: int) -> DataFrame:
    """The words of the first of equal contexts, where an anchor has several different ones."""
    words = F.sum(F.expr(f"cast(spot & 65535 as int) + {length - 1}")).alias("words")
    several = scratch.keep(firsts.groupBy("anchor").agg(F.count("*").alias("n"), words).filter("n > 1").select("anchor", (F.col("words") > HOT).alias("hot")))
    ask = firsts.join(several, "anchor").groupBy("doc_id", "tie").agg(F.collect_list(F.struct("anchor", "context", "spot", "hot")).alias("wanted"))
    cut = texts.alias("t").join(ask.alias("a"), _same("t", "a")).select("t.doc_id", "t.tie", "t.text", "a.wanted")
    return cut.mapInArrow(_cut(length), "anchor long, context long, deal long, doc_id long, tie long, spot long, first int, words binary")


def _masked(firsts: DataFrame, cut: DataFrame, length: int) -> DataFrame:
    """firsts with the windows of each that an earlier context has too."""
    shards = int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = cut.filter("first < 0").repartition(shards, "deal").sortWithinPartitions("deal", F.col("doc_id").asc_nulls_last(), "tie", "spot")
    masks = whole.mapInArrow(_stream(length), "anchor long, context long, mask long")
    single = cut.filter("first >= 0")
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "tie", "spot", "first")
    earliest = single.groupBy("deal", "words").agg(F.min(place).alias("earliest"))
    later = single.join(earliest, ["deal", "words"]).filter(place != F.col("earliest")).select("anchor", "context", F.expr("shiftleft(1L, first)").alias("mask"))
    masks = masks.unionByName(later).groupBy("anchor", "context").agg(F.bit_or("mask").alias("mask"))
    return firsts.join(masks, ["anchor", "context"], "left").select("anchor", "context", F.col("doc_id").alias("first_id"), F.col("tie").alias("first_tie"), F.col("spot").alias("first_spot"), F.coalesce("mask", F.lit(0).cast("long")).alias("first_mask"))


def _removed(docs: DataFrame, found: DataFrame, firsts: DataFrame, length: int) -> DataFrame:
    whole = F.expr("shiftleft(1L, cast(spot & 65535 as int)) - 1")
    is_first = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("tie") == F.col("first_tie")) & (F.col("spot") == F.col("first_spot"))
    hits = found.join(firsts, ["anchor", "context"]).select("doc_id", "tie", "spot", F.when(is_first, F.col("first_mask")).otherwise(whole).alias("mask")).filter("mask != 0")
    hits = hits.groupBy("doc_id", "tie").agg(F.collect_list(F.struct("spot", "mask")).alias("hits"))
    joined = docs.alias("t").join(hits.alias("h"), _same("t", "h"), "left").select("t.doc_id", "t.text", "h.hits")
    return joined.mapInArrow(_remove(length), "doc_id long, n_words long, n_removed long, kept_text string")
