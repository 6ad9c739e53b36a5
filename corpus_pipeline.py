"""From raw documents to tokens: the stages of a small training-data pipeline.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor kept and returns
a DataFrame, which is written and read again before the next one. All but the last return the
columns they were given. Tables without rows, null texts and extra columns pass through every
stage; what each operator does with them is said in its module.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from labelwright.llm import decontaminate, language_id, line_edit_join, order_minhash, pieces
from labelwright.session import ship
from labelwright.sources.scratch import store

MODEL = "piece_bpe_32k.model"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that could be learned."""
    ship(spark)
    return language_id.recognised(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines nearly equal to an earlier one go, short ones if they are equal, and documents that consist of such lines."""
    ship(spark)
    return line_edit_join.without_near_equal_lines(docs, shorter=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ship(spark)
    return order_minhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    ship(spark)
    return decontaminate.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenisation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and hashes of ids and decoded text."""
    ship(spark)
    return pieces.token_digests(docs, public_tokenizers.path(MODEL))


STAGES = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("tokenisation", tokenisation),
]

#: SQL can express neither the classifier nor the tokenizer; the tests compose brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
