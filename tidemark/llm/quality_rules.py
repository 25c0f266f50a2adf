"""Quality rules as a bitmask ledger, in native expressions only.

Every rule is evaluated once for each document. The ledger holds the measurements and one integer whose bit k is set if
rule k failed. A policy is a versioned mask of rules that reject: applying one, or asking what would change without a
rule, needs the ledger only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import fresh

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """failed: a condition on the struct of measurements, never null."""

    name: str
    failed: Callable[[Column], Column]


#: A rule's place is its bit; rules are only ever added at the end.
RULES = (
    Rule("few_words", lambda m: m["n_words"] < 50),
    Rule("repeated_runs", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    Rule("symbols", lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule("repeated_lines", lambda m: (m["n_lines"] >= 4) & (100 * m["n_dup_lines"] > 60 * m["n_lines"])),
    Rule("long_words", lambda m: m["word_chars"] > 40 * m["n_words"]),
    Rule("short_words", lambda m: 2 * m["word_chars"] < 3 * m["n_words"]),
)
BIT = {rule.name: 1 << k for k, rule in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_runs"]
#: Version to mask of the rules that reject.
POLICIES = {1: BASE, 2: BASE | BIT["symbols"] | BIT["repeated_lines"], 3: (1 << len(RULES)) - 1}
CURRENT = 3
MEASURED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")


def _let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """The words of a text: what split() gives, without the empty strings that white space at the ends leaves."""

    def inner(parts: Column) -> Column:
        lead = F.when(F.get(parts, 0) == "", 1).otherwise(0)
        trail = F.when(F.element_at(parts, -1) == "", 1).otherwise(0)
        return F.when(lead + trail == 0, parts).otherwise(F.slice(parts, lead + 1, F.greatest(F.lit(0), F.size(parts) - lead - trail)))

    return _let(F.split(text, GAP), inner)


def _repeat_words(words: Column) -> Column:
    """Words inside runs of three that the text has twice or more.

    Starts are sorted by a hash shortened to leave room for the start itself, which narrows them to those with a partner;
    only these are compared word by word.
    """
    n = F.size(words)

    def covered(bits: Column) -> Column:
        place = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1

        def packed(high: Column) -> Column:
            return F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).bitwiseAND(high).bitwiseOR(i)))

        def exact(order: Column, high: Column) -> Column:
            near = _let(F.transform(order, lambda x: x.bitwiseAND(high)), lambda keys: F.filter(order, lambda _, i: (F.get(keys, i) == F.get(keys, i - 1)) | (F.get(keys, i) == F.get(keys, i + 1))))
            return _let(F.sort_array(F.transform(near, lambda x: _run(words, x.bitwiseAND(place).cast("int")))), starts)

        return _let(F.bitwise_not(place), lambda high: _let(packed(high), lambda order: exact(order, high)))

    def starts(order: Column) -> Column:
        alike = lambda a, b: (a["a"] == b["a"]) & (a["b"] == b["b"]) & (a["c"] == b["c"])
        twice = F.filter(order, lambda x, i: alike(x, F.get(order, i - 1)) | alike(x, F.get(order, i + 1)))
        return _let(F.sort_array(F.transform(twice, lambda x: x["at"])), lambda at: F.aggregate(F.transform(at, lambda x, i: F.coalesce(F.least(F.lit(3), x - F.get(at, i - 1)), F.lit(3))), F.lit(0).cast("long"), lambda s, x: s + x))

    return F.when(n < 3, F.lit(0).cast("long")).otherwise(_let(F.length(F.bin(n.cast("long"))), covered))


def _run(words: Column, at: Column) -> Column:
    return F.struct(F.get(words, at).alias("a"), F.get(words, at + 1).alias("b"), F.get(words, at + 2).alias("c"), at.alias("at"))


def measurements(text: Column) -> Column:
    """A struct of n_words, word_chars, n_symbols, n_dup_lines, n_lines and n_repeat_words, all long; a null text is empty."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of(words: Column, lines: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, f"[{SYMBOLS}]", ""))).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.size(lines).cast("long").alias("n_lines"),
            _repeat_words(words).alias("n_repeat_words"),
        )

    return _let(lines, lambda b: _let(words_of(text), lambda a: of(a, b)))


def ledger(docs: DataFrame, text_col: str = "text", into: str = "ledger") -> DataFrame:
    """docs with a struct named into: the measurements and failed, the bits of the rules that failed.

    A null or empty text has no words and fails few_words. A column of docs of that name is replaced.
    """
    return docs.withColumn(into, _let(measurements(F.col(text_col)), _judged))


def _judged(m: Column) -> Column:
    """The measurements with failed. As both come from one expression, a filter on failed measures a text once."""
    bits = (F.when(rule.failed(m), F.lit(BIT[rule.name]).cast("long")).otherwise(0) for rule in RULES)
    return F.struct(*(m[c].alias(c) for c in MEASURED), reduce(lambda a, b: a.bitwiseOR(b), bits).alias("failed"))


def kept(version: int = CURRENT, failed: Column | None = None) -> Column:
    return (F.col("ledger.failed") if failed is None else failed).bitwiseAND(F.lit(POLICIES[version]).cast("long")) == 0


def apply_policy(docs: DataFrame, version: int = CURRENT, text_col: str = "text") -> DataFrame:
    """The rows of docs that a policy keeps, with their own columns."""
    into = fresh(docs, "ledger")
    return ledger(docs, text_col, into).filter(kept(version, F.col(f"{into}.failed"))).select(*docs.columns)


def ablations(ledgered: DataFrame, version: int = CURRENT) -> DataFrame:
    """For each rule of a policy: documents it fails, those it alone rejects, and what the policy keeps without it.

    Documents are first summed by their bits, of which there are at most 2 ** rules.
    """
    sums = ledgered.groupBy(F.col("ledger.failed").bitwiseAND(F.lit(POLICIES[version]).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(BIT[r.name]).cast("long").alias("bit")) for r in RULES if POLICIES[version] & BIT[r.name])))
    each = sums.select("bits", "n", rules.alias("r")).select("bits", "n", "r.*")
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0).cast("long"))
    return each.groupBy("rule", "bit").agg(total(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("failed"), total(F.col("bits") == F.col("bit")).alias("only_this"), total(F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0).alias("kept_without"))
