"""From raw documents to packed training sequences.

Every stage is an operator of ``docgroups.llm`` over all that the stage before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docgroups.llm import language, packing, secrets, shingle_join, toxicity
from docgroups.llm.queries import BYTE_BPE, categories
from docgroups.session import cut

ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; those without a letter, and nulls, go."""
    return language.keep_identified(docs, language.train(docs))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain, learned from the labels of the documents at hand, does not call toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_category(docs, toxicity.train(docs, labels, categories()), "toxic")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles with a similarity of 0.8 or more connect: that with the smallest id."""
    return shingle_join.keep_one(docs, words=5, num=8, den=10)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets and widely copied examples of them masked."""
    return secrets.mask(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their places in sequences of 1024 tokens."""
    return packing.packed_documents(docs, BYTE_BPE)


STAGES = [
    ("language_id", identify_language),
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in their order over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
