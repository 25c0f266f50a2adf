import random
import re
from collections import Counter

import numpy as np
from tidemark.llm.bagminhash import BANDS, ROWS, bag_signature, drop_near_duplicates, near_duplicate_classes
from tidemark.llm.words import U64, mix64

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def bag(text, size=5):
    w = WORD.findall(text or "")
    return Counter(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else Counter()


def similarity(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute(rows, threshold=0.8):
    """Class of each row, by index of its first row."""
    bags, root = [bag(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j] and similarity(bags[i], bags[j]) >= threshold - 1e-12:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(rows))]


def corpus(seed, n=60):
    r = random.Random(seed)
    words = [f"v{i}" for i in range(500)] + ["ñandú", "日本"]
    rows = []
    base = [[r.choice(words) for _ in range(r.randint(30, 200))] for _ in range(8)]
    for _ in range(n):
        w = list(r.choice(base)) if r.random() < 0.7 else [r.choice(words) for _ in range(r.randint(1, 80))]
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = r.choice(words)
        rows.append((" ".join(w)))
    rows += [rows[0], rows[0], "a b c", "a b c", "a b", "", " \n", None, "x " * 300, "x " * 310, "x " * 900]
    return [(i, t) for i, t in enumerate(rows)]


def test_signatures_estimate_weighted_jaccard():
    r = np.random.default_rng(3)
    key = mix64(np.arange(300, dtype=U64))
    a, b = r.integers(0, 40, 300) ** 2 // 60, r.integers(0, 40, 300) ** 2 // 60
    b[:220] = a[:220]
    at, bt = np.flatnonzero(a), np.flatnonzero(b)
    sig = bag_signature(np.concatenate([key[at], key[bt]]), np.repeat([0, 1], [len(at), len(bt)]), np.concatenate([a[at], b[bt]]), 2, 20_000)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - true) < 4 * (true * (1 - true) / 20_000) ** 0.5


def test_classes_against_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        docs = spark.createDataFrame([(t, i, "q", 0) for i, t in rows], "text string, doc_id long, content string, key int").repartition(4)
        got = {x.doc_id: x.class_id for x in near_duplicate_classes(spark, docs).collect()}
        assert [got[i] for i, _ in rows] == brute(rows)


def test_one_bucket_of_many_near_copies_is_whole(spark):
    r = random.Random(7)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(150):  # a chain: neighbours are alike, the ends are not
        base = [*base[:-1], f"n{i}"] if i % 3 else [f"m{i}", *base[1:]]
        base[r.randrange(60)] = f"k{i}"
        rows.append((i, " ".join(base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.class_id for x in near_duplicate_classes(spark, docs, 0.7).collect()}
    assert [got[i] for i, _ in rows] == brute(rows, 0.7)


def test_groups_and_blocks_of_any_size_give_the_same_classes(spark, monkeypatch):
    import tidemark.llm.bagminhash as m

    rows = corpus(6)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for pivots, block, group_bytes in ((2, 3, 1 << 23), (256, 500, 700), (1, 1, 1)):
        monkeypatch.setattr(m, "PIVOTS", pivots)
        monkeypatch.setattr(m, "BLOCK", block)
        monkeypatch.setattr(m, "GROUP_BYTES", group_bytes)
        got = {x.doc_id: x.class_id for x in near_duplicate_classes(spark, docs, 0.7).collect()}
        assert [got[i] for i, _ in rows] == brute(rows, 0.7)


def test_a_bucket_of_different_texts_takes_few_rounds(spark, monkeypatch):
    import tidemark.llm.bagminhash as m

    monkeypatch.setattr(m, "PIVOTS", 4)
    rounds, real = [], m._pivots
    monkeypatch.setattr(m, "_pivots", lambda *a: (rounds.append(a[2]), real(*a))[1])
    shared = [f"s{i}" for i in range(90)]
    rows = [(i, " ".join(shared + [f"own{i}_{k}" for k in range(18)])) for i in range(120)] + [(500, " ".join(shared + [f"own7_{k}" for k in range(17)] + ["other"]))]
    got = {x.doc_id: x.class_id for x in near_duplicate_classes(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: 7 if i == 500 else i for i, _ in rows} and rounds == [4, 16, 64, 256][: len(rounds)] and len(rounds) <= 4


def test_dropping_keeps_one_row_of_each_class(spark):
    rows = corpus(4)
    docs = spark.createDataFrame([(t, i, i * 2) for i, t in rows] + [(rows[5][1], 5, 10), (rows[5][1], None, 1)], "text string, doc_id long, tie int")
    kept = drop_near_duplicates(spark, docs)
    assert kept.columns == docs.columns
    got = sorted(x.doc_id for x in kept.collect())
    classes = brute(rows)
    wordless = [i for i, t in rows if not bag(t)]
    assert got == sorted({c for i, c in enumerate(classes) if i not in wordless} | set(wordless))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicate_classes(spark, docs).collect() == [] and drop_near_duplicates(spark, docs).collect() == []


def test_pairs_at_the_threshold_share_a_band(spark):
    assert (1 - 0.8**ROWS) ** BANDS < 1e-4
    rows = []
    for seed in (993, 3100, 3106, 5492, 5537):  # of 6000 pairs at 0.8, those that share no band of 6 rows
        r = random.Random(seed)
        a = [f"u{r.randrange(10**9)}" for _ in range(49)]
        b = a[:44] + [f"u{r.randrange(10**9)}" for _ in range(5)]
        rows += [(2 * seed, " ".join(a)), (2 * seed + 1, " ".join(b))]
    assert all(similarity(bag(a), bag(b)) == 0.8 for (_, a), (_, b) in zip(rows[::2], rows[1::2], strict=True))
    got = {x.doc_id: x.class_id for x in near_duplicate_classes(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}
