import random
import re
from collections import defaultdict

from tidemark.llm.mixing import mix, plan_mix, take

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water(sizes, weights=(5, 2, 1), share=1.5, limit=2):
    """Targets by sharing out again until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    fixed = {}
    while True:
        rest = share * sum(sizes.values()) - sum(fixed.values())
        open_ = [s for s in names if s not in fixed]
        total = sum(w[s] for s in open_)
        target = {s: rest * w[s] / total for s in open_}
        over = [s for s in open_ if target[s] >= limit * sizes[s]]
        if not over:
            return {**fixed, **target}
        fixed |= {s: limit * sizes[s] for s in over}
        if len(fixed) == len(names):
            return fixed


def rows(seed, n=400):
    r = random.Random(seed)
    sources = ["b", "a", "é", "z" * 5, None, "", "src10", "src2"]
    out = [(i, r.choice(sources[: 3 + seed]), " ".join(["w"] * r.randint(0, 60))) for i in range(n)]
    out += [(n, "only", "one big " * 500), (n + 1, "none", None), (n + 2, "none", " "), (None, "a", "null id"), (None, "a", "null id"), (3, "a", "same id")]
    return out


def test_targets_and_taken(spark):
    for seed in range(1, 5):
        data = rows(seed)
        docs = spark.createDataFrame([(t, s, i, 5) for i, s, t in data], "text string, source string, doc_id long, mix int").repartition(3)
        got = mix(spark, docs).selectExpr("doc_id", "source", "text", "mix.*").collect()
        assert len(got) == len(data)
        sizes = defaultdict(int)
        for _, s, t in data:
            sizes[s] += len(WORD.findall(t or ""))
        want, taken, largest = water(sizes), defaultdict(int), defaultdict(int)
        for r in got:
            assert r.size == len(WORD.findall(r.text or "")) and r.source_size == sizes[r.source]
            assert abs(r.target - want[r.source]) < 1e-6 and 0 <= r.copies <= 2
            taken[r.source] += r.size * r.copies
            largest[r.source] = max(largest[r.source], r.size)
        for s in sizes:
            assert abs(taken[s] - want[s]) <= largest[s]
        again = mix(spark, docs.repartition(7)).selectExpr("doc_id", "text", "mix.copies").collect()
        assert sorted(map(str, again)) == sorted(str(r) for r in mix(spark, docs).selectExpr("doc_id", "text", "mix.copies").collect())


def test_a_larger_share_only_adds(spark):
    docs = spark.createDataFrame([(i, s, t) for i, s, t in rows(2)], "doc_id long, source string, text string")
    small = {(r.doc_id, r.text): r.c for r in mix(spark, docs, share=0.5).selectExpr("doc_id", "text", "mix.copies c").collect()}
    large = {(r.doc_id, r.text): r.c for r in mix(spark, docs, share=0.9).selectExpr("doc_id", "text", "mix.copies c").collect()}
    assert all(large[k] >= c for k, c in small.items())


def test_taking_repeats_rows(spark):
    docs = spark.createDataFrame([(i, s, t) for i, s, t in rows(1, 50)], "doc_id long, source string, text string")
    mixed = mix(spark, docs)
    assert take(mixed).columns == docs.columns and take(mixed).count() == mixed.agg({"mix.copies": "sum"}).first()[0]


def test_texts_without_words_stay_within_the_limit(spark):
    r = random.Random(5)
    data = [(i, s, r.choice(["", None, " ", "w w w"])) for s in ("a", "b") for i in range(80)]
    got = mix(spark, spark.createDataFrame(data, "doc_id long, source string, text string"), share=9.0).select("mix.size", "mix.copies").collect()
    assert len(got) == len(data) and all(x.copies <= 2 for x in got) and all(x.copies == 2 for x in got if x.size)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mix(spark, docs).collect() == [] and plan_mix(spark, docs).collect() == []
