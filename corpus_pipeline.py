"""The corpus pipeline: five of the training-data operators, one after the other.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the
documents it keeps. ``run`` writes every stage's result as Parquet to the shared checkpoint
folder and reads it again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cashcast.llm import decontamination, language, mixing, ngram_join, sharding
from cashcast.session import store
from cashcast.sources.tables import read_table

#: Near duplicates: shingles of five words, a similarity of 0.8 or more.
SHINGLE = 5
PERCENT = 80


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a clear language."""
    return language.known_language(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    return ngram_join.deduplicate(docs, SHINGLE, PERCENT)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark."""
    return decontamination.decontaminate(docs, read_table(spark, "benchmark", sf_dir))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take the sources' documents, or copies of them, up to their targets."""
    return mixing.mixture(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Name every document's shard."""
    return sharding.sharded(docs)


STAGES = [("language_id", known_language), ("ngram_join", one_of_each_group), ("decontaminate", decontaminated),
          ("mix", mixed), ("shard", sharded)]

#: Near duplicates over components and a trained language model are not expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last is returned, the others are written."""
    docs = read_table(spark, "documents", sf_dir)
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
