"""The registered queries of the training-data operators; each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashcast.llm import (decontamination, fuzzy_passages, importance, language, line_rules, mixing, ngram_join, quality, sharding, simhash,
                          substring_index, toxicity, whitening)
from cashcast.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


@query("op1_decontaminate")
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(read_table(spark, "documents", sf_dir), read_table(spark, "benchmark", sf_dir))


@query("op2_mix_sources")
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(read_table(spark, "documents", sf_dir))


@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(read_table(spark, "documents", sf_dir), read_table(spark, "labels", sf_dir))


@query("op4_shards")
def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(spark, "documents", sf_dir))


@query("op5_repeats")
def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_index.remove_repeats(read_table(spark, "documents", sf_dir))


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read_table(spark, "documents", sf_dir), read_table(spark, "labels", sf_dir))


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(read_table(spark, "documents", sf_dir))


@query("op8_line_rules")
def op8_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.line_rules(read_table(spark, "documents", sf_dir))


@query("op9_ngram_join")
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(read_table(spark, "documents", sf_dir))


@query("op10_fuzzy_passages")
def op10_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_passages.passages(read_table(spark, "documents", sf_dir))


@query("op11_importance")
def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.importance_ranks(read_table(spark, "documents", sf_dir), read_table(spark, "benchmark", sf_dir))


@query("op12_simhash")
def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(read_table(spark, "documents", sf_dir))


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whitened(read_table(spark, "embeddings", sf_dir))
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))
