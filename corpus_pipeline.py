"""A training corpus from raw documents, in stages that each read what the one before wrote.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns
of ``documents``; the last adds the token digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barloom.llm import bpe, decontamination, language, simhash
from barloom.llm.common import keep, table
from barloom.llm.queries import byte_vocabulary


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is accepted; the rejected ones go."""
    return language.accepted(docs, language.fit_documents(docs))


def near_copies_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the least doc_id."""
    return simhash.one_of_each(docs, shingle=3, radius=3)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the count and digest of their tokens and of the text decoded from them."""
    return bpe.tokenised(docs, byte_vocabulary(), with_ids=False)


STAGES = [
    ("language", known_language),
    ("simhash", near_copies_once),
    ("decontamination", without_benchmarks),
    ("bpe", tokens),
]

# SQL has no nearest centroids and no byte pair merges: the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
