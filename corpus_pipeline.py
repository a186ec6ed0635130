"""Cleaning and mixing of a training corpus, stage by stage.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor
kept, and returns the columns of ``documents``; the last returns the mix. A
stage's result is written as Parquet in the shared scratch folder and read again
before the next begins, so a lost executor costs tasks and never a stage.

Defined results: a null text fails the first stage. Rows that repeat an id stand
together until near-duplicates go, when one is left. Further columns pass
through every stage but the last. Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, language_id, mixing, quality_rules, simhash
from tidemark.session import scratch_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and read like trusted ones."""
    return quality_rules.keep(docs, quality_rules.model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the corpus, told with some confidence."""
    return language_id.keep_known(docs, language_id.train(docs.where(~language_id.held_out())))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints link, that of the smallest id."""
    return simhash.keep_first(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("language", language_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: Fingerprints and models are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
