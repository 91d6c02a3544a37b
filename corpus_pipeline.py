"""From raw documents to packed sequences: quality rules, near-duplicates, repeated strings, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.near_copies import drop_near_copies
from tidemark.llm.packing import packed_documents
from tidemark.llm.quality import drop_outliers
from tidemark.llm.scratch import written
from tidemark.llm.suffixes import drop_repeats

#: SQL cannot express the stages; tests hold each against a plain version.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_outliers(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality rules", quality), ("near-duplicates", near_duplicates), ("repeated strings", repeated_strings), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
