import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tidemark.llm.quality_rules import BIT, CURRENT, POLICIES, ablations, apply_policy, ledger

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    runs = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(runs)
    hit = {i + k for i, x in enumerate(runs) if n[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


def texts():
    r = random.Random(1)
    small = ["a", "b", "c", "é", "日本", "#x", "<b>", " "]
    out = [None, "", " ", "\n\n", "a", "a b", "a b c", "a b c a b c", "x " * 500, "\x1fq \x85 q", "a\r\nb\r\na\r\n", "l1\nl1\nl1 \nl2\nl2", "😀😀 😀", "  lead trail  "]
    for _ in range(60):
        out.append("".join(r.choice(small) + r.choice([" ", "\n", "\t", "  ", "\x0b"]) for _ in range(r.randint(1, 200))))
    out.append(" ".join(f"w{i}" for i in range(30000)) + " w0 w1 w2 w3")
    return out


def test_measurements_against_brute_force(spark):
    rows = list(enumerate(texts()))
    got = ledger(spark.createDataFrame(rows, "id int, text string")).select("id", "ledger.*").collect()
    assert {r.id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got} == {i: brute(t) for i, t in rows}
    for r in got:
        n_words, *_, repeat = brute(rows[r.id][1])
        assert bool(r.failed & BIT["few_words"]) == (n_words < 50) and bool(r.failed & BIT["repeated_runs"]) == (100 * repeat > 50 * n_words)


def test_policies_and_ablations(spark):
    docs = spark.createDataFrame([(t, i, "x", 3) for i, t in enumerate(texts())], "text string, doc_id long, n_words string, failed int")
    full = ledger(docs)
    kept = apply_policy(docs)
    assert kept.columns == docs.columns
    bits = [r.failed for r in full.select(F.col("ledger.failed").alias("failed")).collect()]
    policy = POLICIES[CURRENT]
    assert kept.count() == sum(b & policy == 0 for b in bits)
    for r in ablations(full).collect():
        assert r.failed == sum(b & r.bit != 0 for b in bits)
        assert r.only_this == sum(b & policy == r.bit for b in bits)
        assert r.kept_without == sum(b & policy & ~r.bit == 0 for b in bits)


def test_a_policy_measures_once(spark):
    docs = spark.createDataFrame([(t, i) for i, t in enumerate(texts())], "text string, doc_id long")
    assert apply_policy(docs)._jdf.queryExecution().executedPlan().toString().count("xxhash64") == 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "text string, doc_id long")
    assert ledger(docs).collect() == [] and apply_policy(docs).collect() == []
