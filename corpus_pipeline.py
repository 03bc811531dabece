"""A training corpus from ``documents`` in five stages.

quality     documents that the rule ensemble scores below its threshold go
language    documents without a letter, or in no language that the network tells clearly, go
duplicates  of each class of near copies the document with the smallest id stays
leaks       documents that hold a benchmark passage go
tokens      the texts that are left are encoded and decoded

A stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read
again as the next one's docs. All but the last return the columns of ``documents``. Each stage
takes any extra columns along; nulls, empty texts, repeated rows and empty tables are treated as its operator says."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weft.llm.bpe import digest_texts, public_codec
from weft.llm.common import materialise, table
from weft.llm.decontam import drop_leaks
from weft.llm.langid import keep_clear
from weft.llm.rules import keep_good
from weft.llm.simhash_golay import one_of_each


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_clear(docs)


def duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digest_texts(docs, public_codec)


STAGES = [("quality", quality), ("language", language), ("duplicates", duplicates), ("leaks", leaks), ("tokens", tokens)]

# Trained models, XXH64 and byte-pair merges are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
