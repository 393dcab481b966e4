"""From raw documents to packed training sequences.

Each stage takes the documents that its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dugout.llm import language, mixing, packing, pii, simhash
from dugout.llm.common import settle, table
from dugout.llm.queries import surrogate_key, vocabulary


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; texts that are NULL or without letters go."""
    return language.keep_determined(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates: three-word shingles, two bits."""
    return simhash.drop_near_copies(docs, words=3, max_bits=2)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced by surrogates."""
    return pii.replace_pii(docs, surrogate_key(spark)).drop("pii_counts")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for, in a random order."""
    return mixing.replicate(docs, seed=11, temperature=0.5).drop("copy")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), window=2048)


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_copies),
    ("PII", personal_data),
    ("mixing sources", mixed),
    ("packing", packed),
]

#: SQL has neither the tokenizer nor the hashes of these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = settle(docs, f"stage{number}")
    return docs
