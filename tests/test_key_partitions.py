"""The checks by key sum in tasks of bounded rows: no sums are made where rows are read, and more rows are more tasks."""

import re

from cashcast.operators import quality as Q
from tests.test_quality import DOC_ITEMS, DOCS, ITEMS, ORDERS


def _report(spark):
    orders = spark.createDataFrame(ORDERS, "SalesOrder string, OverallSDProcessStatus string, OverallSDDocumentRejectionSts string")
    items = spark.createDataFrame([(k,) for k in ITEMS], "SalesOrder string")
    docs = spark.createDataFrame(DOCS, "BillingDocument string, BillingDocumentType string, SalesOrder string, BillingDocumentIsCancelled boolean, "
                                       "CancelledBillingDocument string, TotalNetAmount double, TotalTaxAmount double")
    doc_items = spark.createDataFrame(DOC_ITEMS, "BillingDocument string, NetAmount double, TaxAmount double")
    cash = spark.createDataFrame([("D1",), ("D1",)], "BillingDocument string")
    open_known = spark.createDataFrame([("D1",), ("D7",), (None,)], "BillingDocument string")
    return Q.cardinality_report(orders, items, docs, doc_items, cash, open_known)


def test_rows_are_dealt_by_key_before_they_are_summed(spark, monkeypatch):
    whole = _report(spark)
    monkeypatch.setattr(Q, "KEY_ROWS", 2)  # 8 documents, 9 items: 50 rows at most
    split = _report(spark)
    plan = split._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\(k#\d+, (\d+)\), (\w+)", plan)
    assert dealt and {d for d in dealt} == {("26", "REPARTITION_BY_NUM")}
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, whole.collect()))
