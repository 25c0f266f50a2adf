"""From documents to token ids, in stages that are each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bagminhash, mixing, pii, quality_rules, sentencepiece
from tidemark.llm.queries import PII_KEY, model_path
from tidemark.llm.store import Scratch, fresh


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps."""
    return quality_rules.apply_policy(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return bagminhash.drop_near_duplicates(spark, docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers and dates under pseudonyms, in texts as long as before."""
    return pii.pseudonymise(docs, PII_KEY, found_col=None)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    into = fresh(docs, "mix")
    return mixing.take(mixing.mix(spark, docs, into=into), into).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the ids of the text."""
    return sentencepiece.encode(docs.select("doc_id", "lang", "source", "text"), model_path()).drop("text")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("minhash near-dedup", near_dedup),
    ("pii", private),
    ("mixing", mixed),
    ("sentencepiece", tokens),
]

#: Near-duplicate classes and Viterbi paths are beyond SQL; a test holds the rows against a brute-force pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        before, docs = docs, scratch.keep(stage(spark, docs, sf_dir))
        if scratch.n > 1:
            scratch.drop(before)
    return docs
