import hashlib
import random
import re

from tidemark.llm.substring_dedup import SuffixAutomaton, remove_repeated_spans

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, length):
    """Rows of distinct ids."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        words = WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - length + 1):
            key = tuple(words[i : i + length])
            if key in seen:
                gone.update(range(i, i + length))
            seen.add(key)
        out[doc] = (len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone))
    return out


def made(n, seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["é\u0085x", " ", "日本"]
    passages = [[r.choice(vocabulary) for _ in range(r.randint(20, 70))] for _ in range(4)]
    rows = []
    for i in range(n):
        words = [r.choice(vocabulary) for _ in range(r.randint(0, 60))]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randint(0, 10)
            words[r.randint(0, len(words)) : 0] = p[a:]
        rows.append((i * 3, r.choice([" ", "\n", " \t"]).join(words)))
    rows += [(1, ""), (2, None), (4, "a " * 100), (5, "x y " * 300), (None, rows[3][1]), (100001, rows[5][1]), (100002, rows[5][1]), (7, "  ")]
    return rows


def run(spark, rows, length=20):
    docs = spark.createDataFrame([(t, i, "z") for i, t in rows], "text string, doc_id long, anchor string").repartition(5)
    return [(r.doc_id, (r.n_words, r.n_removed, r.kept_text)) for r in remove_repeated_spans(spark, docs, length).collect()]


def test_against_brute_force(spark):
    for seed, length in ((1, 20), (2, 9)):
        rows = made(60, seed)
        got = run(spark, rows, length)
        assert len(got) == len(rows) and dict(got) == brute(rows, length)


def test_hot_anchor_is_dealt_by_window(spark, monkeypatch):
    import tidemark.llm.substring_dedup as m

    monkeypatch.setattr(m, "HOT", 3)
    rows = made(60, 3)
    assert dict(run(spark, rows)) == brute(rows, 20)


def test_empty_and_repeated_rows(spark):
    assert run(spark, []) == []
    text = " ".join(f"t{i}" for i in range(40))
    assert sorted(run(spark, [(1, text), (1, text), (2, text)])) == [(1, (40, 0, text)), (1, (40, 0, text)), (2, (40, 40, ""))]


def test_automaton_statistics():
    r = random.Random(5)
    for _ in range(100):
        old = [[r.randint(0, 3) for _ in range(r.randint(0, 12))] for _ in range(3)]
        a = SuffixAutomaton()
        for s in old:
            a.add(s)
        new = [r.randint(0, 4) for _ in range(15)]
        inside = lambda x: any(s[i : i + len(x)] == x for s in old for i in range(len(s) - len(x) + 1)) if x else True
        assert a.statistics(new) == [max(n for n in range(e + 2) if inside(new[e + 1 - n : e + 1])) for e in range(len(new))]


def test_hash_is_of_kept_words(spark):
    from tidemark.llm.queries import digest

    rows = made(20, 9)
    docs = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
    got = {r.doc_id: r.kept_sha256 for r in digest(remove_repeated_spans(spark, docs)).collect()}
    assert got == {k: hashlib.sha256(v[2].encode()).hexdigest() for k, v in brute(rows, 20).items()}


def test_thousands_of_null_ids_stay_apart(spark):
    r = random.Random(11)
    passages = [[f"p{k}.{i}" for i in range(30)] for k in range(5)]
    texts = []
    for i in range(3000):
        words = [f"t{i}.{k}" for k in range(r.randint(5, 40))]
        at = r.randint(0, len(words))
        texts.append(" ".join(words[:at] + r.choice(passages)[r.randint(0, 8) :] + words[at:]))
    docs = spark.createDataFrame([(None if i % 3 else 7, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    ranked = [(x.doc_id is None, x.h, x.text) for x in docs.selectExpr("doc_id", "text", "xxhash64(text) AS h").collect()]
    want = brute([((late, h), t) for late, h, t in ranked], 20)
    assert len(want) == 3000
    got = [(x.doc_id is None, x.n_words, x.n_removed, x.kept_text) for x in remove_repeated_spans(spark, docs).collect()]
    assert sorted(got) == sorted((late, *v) for (late, _), v in want.items())
