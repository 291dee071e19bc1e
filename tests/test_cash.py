import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from cashcast.operators import cash as CS


def test_posting_date_clamp(spark):
    df = spark.createDataFrame([(30, 0, -2), (170, 50, 3), (-4, 0, -9)], "b int, a int, n int").withColumn("d", F.lit(dt.date(2025, 1, 1)))
    days, post = CS.posting_date(F.col("d"), F.col("b"), F.col("a"), F.col("n"))
    assert [r.x for r in df.select(days.alias("x")).collect()] == [28, 180, 1]
    assert df.select(post.alias("p")).first().p == dt.date(2025, 1, 29)


def test_validity_value(spark):
    from cashcast.functions.numeric import validity_value
    r = spark.createDataFrame([(dt.date(2026, 1, 1),)], "d date").select(validity_value("d").alias("v")).first()
    assert r.v == Decimal("1767225600.0000000")


def _docs(spark, rows):
    return spark.createDataFrame(
        rows, "BillingDocument string, SalesOrder string, BillingDocumentType string, BillingDocumentIsCancelled boolean, "
              "PayerParty string, BillingDocumentDate date, TotalNetAmount double, TransactionCurrency string")


def test_postings_currency_bank_and_terms(spark):
    docs = _docs(spark, [
        ("BD-1", "10", "F2", False, "A1", dt.date(2025, 1, 1), 100.0, "EUR"),
        ("BD-2", "11", "F2", False, "A1", dt.date(2025, 1, 1), 100.0, "USD"),
        ("BD-3", "12", "F2", True, "A1", dt.date(2025, 1, 1), 100.0, "EUR"),    # cancelled: no cash
        ("BD-4", "13", "F2", False, "ZZ", dt.date(2025, 1, 1), 100.0, "EUR"),   # unknown payer: skipped
    ])
    tiers = spark.createDataFrame([("A1", "A")], "Customer string, Tier string")
    dun = spark.createDataFrame([("A1", None)], "Customer string, DunningLevel int")
    t = CS.payment_terms(docs, tiers, dun).withColumns({
        "OrderKey": F.col("SalesOrder").cast("long"), "base_dso": F.lit(30), "noise": F.lit(0),
        "base_rate": F.lit(1).cast("decimal(5,2)")})
    out = {r.BillingDocument: r for r in CS.cash_postings(t).collect()}
    assert set(out) == {"BD-1", "BD-2"}
    assert (out["BD-1"].AmountInCompanyCodeCurrency, out["BD-1"].BankAccountInternalID) == (Decimal("100.0000"), "BANK001")
    assert (out["BD-2"].AmountInCompanyCodeCurrency, out["BD-2"].BankAccountInternalID) == (Decimal("92.0000"), "BANK002")
    assert out["BD-1"].PostingDate == dt.date(2025, 1, 31)
    assert sorted(r.CashFlowID for r in out.values()) == ["CF-000001", "CF-000002"]


def test_dunning_default(spark):
    dun = spark.createDataFrame([("A", None), ("C", 1), ("C", 3)], "Customer string, DunningLevel int")
    cust = spark.createDataFrame([("A",), ("B",), ("C",)], "Customer string")
    lv = CS.dunning_levels(dun)
    out = {r.Customer: r.lv for r in cust.join(lv, "Customer", "left").select(
        "Customer", F.coalesce("DunningLevel", F.lit(0)).alias("lv")).collect()}
    assert out == {"A": 0, "B": 0, "C": 3}


def test_seasonal_index_and_forecast(spark):
    # ISO week 2 of 2024 (8-14 Jan) mean 70, week 3 (15-21 Jan) mean 210
    cash = spark.createDataFrame([(dt.date(2024, 1, 8), Decimal("70")), (dt.date(2024, 1, 15), Decimal("200")),
                                  (dt.date(2024, 1, 16), Decimal("220"))],
                                 "PostingDate date, AmountInCompanyCodeCurrency decimal(34,4)")
    idx = CS.seasonal_index(cash, 2024, 2024)
    si = {r.iso_week: r.seasonal_index for r in idx.collect()}
    assert si == {2: 0.5, 3: 1.5}
    fc = CS.cash_forecast(idx, dt.date(2026, 1, 5), 1)  # 2026-01-05 is in ISO week 2
    v = {r.PostingDate: r.AmountInCompanyCodeCurrency for r in fc.collect()}
    assert v[dt.date(2026, 1, 5)] == Decimal("10.4000")    # 140/7 * 0.5 * 1.04
    assert v[dt.date(2026, 1, 12)] == Decimal("31.2000")   # week 3
    assert v[dt.date(2026, 1, 19)] == Decimal("20.8000")   # week 4: no history -> index 1.0
    assert fc.count() == 31
    assert min(r.CashFlowID for r in fc.collect()) == "FCF-000001"
