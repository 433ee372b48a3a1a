"""A corpus from raw documents: language, copies, near copies, secrets, sequences.

Each stage works on all rows that its predecessor kept, written as Parquet in between.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from talus.llm import exact, language, packing, secrets, similar
from talus.llm.common import publish
from talus.llm.queries import vocabulary


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without letters or of no learned language go."""
    return language.accepted(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, that of the smallest id."""
    return exact.without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies (5-word Jaccard similarity of 0.8 or more), that of the smallest id."""
    return similar.without_similar(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; the secrets found in their texts are masked."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its place in a sequence of 2048 tokens."""
    # the workers hold other stages' models too, so they remember fewer chunks
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), remembered=100_000)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

#: Trained models, fingerprints and tokenizers have no SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, on the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = publish(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
