"""Plan guards: no registered query may plan a cartesian product, a nested-loop join or a
row-at-a-time Python UDF; the only Python stage allowed is the model's grouped map."""

import os

import pytest

from cashcast.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")
MODEL = {"f1_model_forecast", "f7_model_vs_actual", "f8_model_fit_metrics", "f9_model_status", "f11_skill",
         "f1_forecast_keys", "a9_forecast_summary"}

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


def test_no_forbidden_operators(spark):
    bad = {}
    for name, fn in sorted(QUERIES.items()):
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        hits = [p for p in FORBIDDEN if p in plan]
        if "FlatMapGroupsInPandas" in plan and name not in MODEL:
            hits.append("FlatMapGroupsInPandas")
        if hits:
            bad[name] = hits
    assert bad == {}
