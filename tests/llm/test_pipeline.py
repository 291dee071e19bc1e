"""The corpus pipeline on the smallest tables: stage by stage, and as a query."""

import pytest

import corpus_pipeline
from cashcast.llm import decontamination, language, ngram_join
from tests.llm.cases import HAVE, SF, awkward

pytestmark = pytest.mark.skipif(not HAVE, reason="test tables not present")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        if name == "language_id":
            found = language.predict(before, language.learn(before)).filter("lang_pred = 'und'")
            assert docs.count() <= n - found.count()
        if name == "ngram_join":  # nothing left is alike
            left = ngram_join.ngram_components(docs, corpus_pipeline.SHINGLE, corpus_pipeline.PERCENT)
            assert left.filter("component_id <> doc_id").count() == 0
        if name == "decontaminate":
            assert decontamination.digest(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).filter("contaminated").count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.columns == [*columns, "shard"] and last.count() == docs.count()


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and "shard" in out.columns


def test_stages_on_awkward_rows(spark):
    docs = awkward(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() > 0
