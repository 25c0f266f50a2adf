"""The stages against a pipeline of plain Python over a small corpus."""

import hashlib
import random
import re

import corpus_pipeline
from test_bagminhash import brute as classes_of
from test_mixing import water
from test_quality_rules import brute as measured
from test_sentencepiece import brute as encoded

from tidemark.llm import sentencepiece as sp
from tidemark.llm.pii import ROUNDS
from tidemark.llm.queries import PII_KEY, model_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def feistel(values, radices, tweak):
    half = len(values) // 2
    parts, radix = [list(values[:half]), list(values[half:])], [radices[:half], radices[half:]]
    for k in range(ROUNDS):
        own, other = (0, 1) if k % 2 == 0 else (1, 0)
        text = ",".join(map(str, parts[other]))
        parts[own] = [(x + int(hashlib.sha256(f"{PII_KEY}|{tweak}|{k}|{i}|{text}".encode()).hexdigest()[:12], 16)) % radix[own][i] for i, x in enumerate(parts[own])]
    return parts[0] + parts[1]


def luhn(d):
    return sum(sum(divmod(2 * x, 10)) if k % 2 else x for k, x in enumerate(reversed(d))) % 10


def hide(text):
    def ip(m):
        v = [int(x) for x in m[0].split(".")]
        return ".".join(map(str, feistel(v, [256] * 4, "ip"))) if max(v) < 256 else m[0]

    def card(m):
        d = [int(x) for x in m[0]]
        if luhn(d):
            return m[0]
        front = feistel(d[:-1], [10] * (len(d) - 1), "card")
        return "".join(map(str, [*front, (10 - luhn([*front, 0])) % 10]))

    return re.sub(r"(?<![0-9A-Za-z])[0-9]{16}(?![0-9A-Za-z])", card, re.sub(r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])", ip, text))


def keeps(text):
    n_words, chars, symbols, dup, repeat = measured(text)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return not (n_words < 50 or 100 * repeat > 50 * n_words or 10 * symbols > n_words or len(lines) >= 4 and 100 * dup > 60 * len(lines) or chars > 40 * n_words or 2 * chars < 3 * n_words)


def mixed(rows):
    sizes, out = {}, []
    for _, _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t))
    for s, target in water(sizes).items():
        copies = min(2, int(target // sizes[s]))
        rest, before, open_ = target - copies * sizes[s], 0, True
        own = sorted((hashlib.md5(f"{r[0]}|{hashlib.md5(r[3].encode()).hexdigest()}".encode()).hexdigest(), r) for r in rows if r[2] == s)
        for _, r in own:
            size, more = len(WORD.findall(r[3])), 0
            if open_ and before + size <= rest:
                more = 1
            elif open_:
                more, open_ = int(before + size - rest < rest - before), False
            before += size
            out += [r] * (copies + more)
    return out


def corpus():
    r = random.Random(8)
    words = [f"word{i}" for i in range(300)] + ["é", "日本", "4785380592391139", "233.233.171.252", "4785380592391138"]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(40, 160))) for _ in range(60)]
    texts += [texts[0], texts[1] + " end", "short", None, "", "x " * 200, " ".join(["a#b"] * 30 + [f"q{i}" for i in range(40)]), "\n".join(["same line of words here"] * 12 + texts[2:3])]
    return [(i, r.choice(["en", "de"]), r.choice(["a", "b", None, "c"]), t) for i, t in enumerate(texts)]


def test_stages_against_plain_python(spark, tmp_path):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, lang, s, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept = [r for r in rows if keeps(r[3])]
    classes = classes_of([(r[0], r[3]) for r in kept])
    kept = [(i, lang, s, hide(t)) for k, (i, lang, s, t) in enumerate(kept) if classes[k] == k]
    model = sp.Model.load(model_path())
    want = sorted((i, lang, str(s), encoded(model, t)) for i, lang, s, t in mixed(kept))
    got = sorted((x.doc_id, x.lang, str(x.source), x.ids) for x in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == want


def test_empty_and_odd_inputs(spark):
    schema = "n_chars long, source string, text string, lang string, doc_id long, mix string, ledger string, tie long"
    for data in ([], [(None,) * 8, (None,) * 8], [(1, "s", " ".join(f"w{i % 90}{i}" for i in range(100)), "en", None, "m", "l", 3)]):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, "")
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == [c.strip().split()[0] for c in schema.split(",")]
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.count() in (0, 1, 2)
