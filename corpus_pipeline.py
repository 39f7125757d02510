"""A training corpus from raw documents, in five stages that each write a table for the next.

Documents without a main language go, one document of each group of near copies stays, documents that
hold benchmark passages go, sources are mixed to their budgets, and what is left is written as token
ids. A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm.decontaminate import decontaminate
from flowloom.llm.langid import held_out, keep_identified, learn
from flowloom.llm.mixing import mixed_documents
from flowloom.llm.neardup import keep_one
from flowloom.llm.store import saved
from flowloom.llm.tokenfiles import token_digest


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language; texts without letters or without one language in the majority go."""
    return keep_identified(docs, learn(docs.where(~held_out(F.col("doc_id"), 5, 0))))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near copies: five words a shingle, similarity 0.8."""
    return keep_one(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any run of ten words of a benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources holds it."""
    return mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files below the shared folder, and a digest of each document read back from them."""
    return token_digest(docs, public_tokenizers.path("word_bpe_49k.json"), end=2, vocabulary=49_408, splits=True)


STAGES = [("language", language), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixing), ("token_output", token_output)]

#: The language and tokenizer stages cannot be said in SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
