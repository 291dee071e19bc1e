import datetime as dt
from decimal import Decimal

from cashcast.operators import billing as B

ORDER_SCHEMA = ("OrderKey long, SalesOrder string, CreationDate date, SalesOrganization string, "
                "TransactionCurrency string, CustomerPaymentTerms string, SoldToParty string, "
                "IncotermsClassification string, PaymentMethod string, OverallSDProcessStatus string, "
                "OverallSDDocumentRejectionSts string, lag_days int, is_cancelled boolean")
ITEM_SCHEMA = ("SalesOrder string, SalesOrderItem string, Material string, Product string, Plant string, "
               "MaterialGroup string, ProductHierarchyNode string, NetAmount decimal(15,2), TaxAmount decimal(15,2), "
               "SalesOrderItemCategory string, SalesOrganization string, PayerParty string")


def _order(k, status="C", rej="", cancelled=False):
    return (k, str(k), dt.date(2025, 1, 1), "VKORG1", "EUR", "NT30", "C1", "EXW", "T", status, rej, 3, cancelled)


def test_eligibility_three_valued(spark):
    rows = [_order(1, "A"), _order(2, "B"), _order(3, "C"), _order(4, "B", None), _order(5, "C", "C")]
    o = spark.createDataFrame(rows, ORDER_SCHEMA)
    assert sorted(r.OrderKey for r in B.eligible_orders(o).collect()) == [2, 3]


def _items(spark, orders):
    rows = []
    for k in orders:
        for n in (1, 2, 3):
            rows.append((str(k), f"{n * 10:06d}", "M", "M", "PLANT1", "G", "H", Decimal(f"{n}0.10"), Decimal("1.90"),
                         "TAN", "VKORG1", "C1"))
    return spark.createDataFrame(rows, ITEM_SCHEMA)


def test_pairs_numbering_and_mirror(spark):
    o = spark.createDataFrame([_order(1), _order(2, cancelled=True), _order(3)], ORDER_SCHEMA)
    items = _items(spark, [1, 2, 3])
    docs = B.cancellation_pairs(B.billing_documents(o, items))
    got = sorted((r.BillingDocument, r.BillingDocumentType, r.SalesOrder, r.CancelledBillingDocument,
                  r.BillingDocumentIsCancelled, r.AccountingPostingStatus) for r in docs.collect())
    assert got == [
        ("BD-000001", "F2", "1", None, False, "C"),
        ("BD-000002", "F2", "2", None, True, "A"),
        ("BD-000003", "S1", "2", "BD-000002", False, "C"),
        ("BD-000004", "F2", "3", None, False, "C"),
    ]
    d = {r.BillingDocument: r for r in docs.collect()}
    assert d["BD-000002"].CreationDate == dt.date(2025, 1, 4)
    assert d["BD-000003"].TotalNetAmount == -d["BD-000002"].TotalNetAmount == -60.3
    it = B.billing_items(docs, items)
    s1 = sorted((r.BillingDocumentItem, r.NetAmount, r.GrossAmount) for r in it.collect() if r.BillingDocument == "BD-000003")
    f2 = sorted((r.BillingDocumentItem, r.NetAmount, r.GrossAmount) for r in it.collect() if r.BillingDocument == "BD-000002")
    assert [x[0] for x in s1] == ["000010", "000020", "000030"]
    assert [(-a, -b) for _, a, b in s1] == [(a, b) for _, a, b in f2]
    tot = {r.BillingDocument: (r.TotalNetAmount, r.TotalTaxAmount) for r in B.document_totals(it).collect()}
    assert tot["BD-000003"] == (-60.3, -5.7)
    assert tot["BD-000001"] == (d["BD-000001"].TotalNetAmount, d["BD-000001"].TotalTaxAmount)


def test_order_without_items_gets_zero_totals(spark):
    o = spark.createDataFrame([_order(7)], ORDER_SCHEMA)
    items = _items(spark, [8])
    d = B.cancellation_pairs(B.billing_documents(o, items)).collect()[0]
    assert (d.TotalNetAmount, d.TotalTaxAmount, d.PayerParty) == (0.0, 0.0, None)
