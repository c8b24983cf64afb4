"""The corpus pipeline: each stage applies one operator of loomcat.llm to what its predecessor kept.

All stages but the last return the columns of their input as they are, whatever their names. Rows may repeat, and any column may
be null: a null or empty text is no toxic one and holds no benchmark item, has no language (so the second stage drops it), and null
texts are no duplicates of each other. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomcat.llm import decontamination, language_id, mixing, near_dedup, toxicity
from loomcat.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain's last category rejects go. It learns from the labelled rows of `documents`. A row with a null or empty text stays."""
    model = toxicity.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.kept(docs, model)


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language that is told with a score of one half go, and so do null texts and those without a letter."""
    return language_id.kept(docs, language_id.learn(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: that with the least id, any one row of it if it repeats. Null texts stay."""
    return near_dedup.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. Null texts stay."""
    return decontamination.kept(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with mix_tokens, mix_rate and mix_copies; those that get no copy go. It learns from the labels of the documents that are left."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels")).filter("mix_copies > 0")


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_known_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]
#: Trained models and similarity joins can't be said in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the last stage returns; each stage's rows are written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
