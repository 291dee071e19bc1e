from cashcast.operators import quality as Q


def test_duplicate_key_check(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    rows = {r.check: (r.observed, r.passed) for r in Q.key_report([("t", df, ["k"])]).collect()}
    assert rows == {"V9 null key t": (1.0, False), "V10 duplicate key t": (1.0, False)}


def test_zero_check_passes_on_empty(spark):
    df = spark.createDataFrame([], "k string")
    r = Q.zero_check(df, "x").collect()[0]
    assert (r.observed, r.passed, r.expected) == (0.0, True, "= 0")


ORDERS = [("1", "B", ""), ("2", "C", ""), ("3", "C", ""), ("4", "A", ""), ("5", "C", "C"), (None, "C", "")]
ITEMS = ["1", "1", "2", "2", "2", "3", "9", "9", None]
DOCS = [  # document, type, order, cancelled, cancels, net, tax
    ("D1", "F2", "1", False, None, 10.0, 1.9), ("D2", "F2", "2", True, None, 20.0, 0.0), ("D3", "S1", "2", False, "D2", -20.0, 0.0),
    ("D4", "F2", "3", True, None, 5.0, 0.0), ("D5", "S1", "3", False, "D4", -5.0, 0.0), ("D6", "S1", "3", False, "D4", -4.0, 0.0),
    ("D7", "F2", "1", False, None, 7.0, 0.0), ("D8", "S1", "4", False, "DX", -1.0, 0.0)]
DOC_ITEMS = [("D1", 4.0, 0.9), ("D1", 6.0, 1.0), ("D2", 20.0, 0.0), ("D3", -20.0, 0.0), ("D4", 5.0, 0.0), ("D5", -5.0, 0.0), ("D6", -5.0, 0.0),
             ("D7", 7.0, 0.5)]


def test_cardinality_checks_find_planted_faults(spark):
    orders = spark.createDataFrame(ORDERS, "SalesOrder string, OverallSDProcessStatus string, OverallSDDocumentRejectionSts string")
    items = spark.createDataFrame([(k,) for k in ITEMS], "SalesOrder string")
    docs = spark.createDataFrame(DOCS, "BillingDocument string, BillingDocumentType string, SalesOrder string, BillingDocumentIsCancelled boolean, "
                                       "CancelledBillingDocument string, TotalNetAmount double, TotalTaxAmount double")
    doc_items = spark.createDataFrame(DOC_ITEMS, "BillingDocument string, NetAmount double, TaxAmount double")
    cash = spark.createDataFrame([("D1",), ("D1",)], "BillingDocument string")
    open_known = spark.createDataFrame([("D1",), ("D7",), (None,)], "BillingDocument string")
    got = {r.check: r.observed for r in Q.cardinality_report(orders, items, docs, doc_items, cash, open_known).collect()}
    assert got == {
        "V8 orders without 2-3 items": 2.0,                 # order 3, and the item without an order id
        "V8 orders without items": 3.0,                     # 4, 5 and the order without an id
        "V8 items without order": 3.0,                      # twice 9, and the one without an id
        "V8 eligible orders without exactly one F2": 2.0,   # 1 has two, the one without an id none
        "V11 eligible share of orders": 0.666667, "V11 cancelled share of F2": 0.5,
        "V8 F2 with more than one S1": 1.0,                 # D4
        "V8 open F2 without exactly one cash row": 3.0,     # D1 twice, D7 never, one without an id
        "V12 S1 amounts not minus their F2": 3.0,           # both S1 of D4, and the one of an unknown document
        "V13 header total differs from item sum": 3.0,      # D6, D7's tax, D8 without items
    }


def test_volumes_against_targets(spark):
    counts = spark.createDataFrame([("salesorder", 1000), ("salesorderitem", 2500), ("weather", 210)], "table_name string, rows long")
    targets = Q.volume_targets(spark, [("small", [("salesorder", 1050), ("salesorderitem", 5000), ("weather", 210), ("cashflow", 10)])], 0.1)
    got = {r.table_name: r for r in Q.volume_report(counts, targets).collect()}
    assert {k: (r.rows, r.passed) for k, r in got.items()} == {
        "salesorder": (1000, True), "salesorderitem": (2500, False), "weather": (210, True), "cashflow": (0, False)}
    assert (got["salesorderitem"].per_order, got["salesorderitem"].quotient_passed) == (2.5, False) and got["salesorder"].quotient_passed
    none = Q.volume_report(counts.limit(0), targets).collect()
    assert all(r.rows == 0 and not r.passed and not r.quotient_passed and r.per_order is None for r in none)


def test_key_checks_count_rows_and_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), ("b", None), ("b", None), (None, 1), ("c", 1)], "k string, v int")
    rows = {r.check: r.observed for r in Q.key_checks(df, ["k", "v"], "t").collect()}
    assert rows == {"V9 null key t": 3.0, "V10 duplicate key t": 2.0}
    assert all(r.passed for r in Q.key_checks(df.limit(0), ["k", "v"], "t").collect())
