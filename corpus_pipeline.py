"""A corpus from documents to tokens.

Toxic documents go, then exact copies, near copies and documents that hold
benchmark items; the rest is encoded. Every stage reads what the one before it
wrote, so a stage that fails starts again from there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import bpe, decontam, exact, minhash, toxicity
from riskloom.llm.common import table
from riskloom.session import stage


#: Documents whose shingle sets overlap by this percentage are near copies.
NEAR_PERCENT = 80


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from those among them with labels, scores below one half."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The longest original of each group of equal texts."""
    return exact.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near copies."""
    return minhash.without_near_copies(docs, percent=NEAR_PERCENT)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of each document left."""
    return bpe.round_trip(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("bpe", encode),
]

#: SQL cannot express the classifier or the encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
