"""Billing: eligible orders (B1), F2 documents (B2), F2/S1 cancellation pairs (B3, U2, W4, J14),
document items (B4, J9, W5), header totals from items (B5, A5, J15)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashcast import config as C
from cashcast.functions.calendar import fiscal_period, fiscal_year
from cashcast.functions.numeric import padded_id
from cashcast.operators.ids import global_row_number

DOCUMENT_COLUMNS = [
    "BillingDocument", "BillingDocumentType", "BillingDocumentCategory", "CreationDate",
    "BillingDocumentDate", "SalesOrganization", "TotalNetAmount", "TotalTaxAmount",
    "TransactionCurrency", "CustomerPaymentTerms", "PayerParty", "SoldToParty", "CompanyCode",
    "IncotermsClassification", "PaymentMethod", "BillingDocumentIsCancelled",
    "CancelledBillingDocument", "AccountingPostingStatus", "FiscalYear", "FiscalPeriod",
]

ITEM_COLUMNS = [
    "BillingDocument", "BillingDocumentItem", "Material", "Product", "Plant", "MaterialGroup",
    "ProductHierarchyNode", "NetAmount", "GrossAmount", "TaxAmount",
    "EligibleAmountForCashDiscount", "SalesDocumentItemCategory", "SalesOrganization",
]


def eligible_orders(orders: DataFrame) -> DataFrame:
    """Status B or C and rejection status not 'C'. A null rejection status is
    dropped (three-valued logic), an empty one passes."""
    return orders.filter(F.col("OverallSDProcessStatus").isin("B", "C")
                         & (F.col("OverallSDDocumentRejectionSts") != "C"))


def _order_key(*tables: DataFrame) -> str:
    """The bigint key if all tables have it: joins and aggregates on one key share their exchanges."""
    return "OrderKey" if all("OrderKey" in t.columns for t in tables) else "SalesOrder"


def order_item_totals(items: DataFrame, key: str = "SalesOrder") -> DataFrame:
    """A4 + A11: per order - first payer (lowest, deterministic), net and tax sums (exact decimals).

    Items that carry the payer as a number, ``PayerKey``, are aggregated by hash; the least of
    texts needs a sort.
    """
    payer = F.min("PayerKey").cast("string") if "PayerKey" in items.columns else F.min("PayerParty")
    return items.groupBy(key).agg(
        payer.alias("_payer"),
        F.sum("NetAmount").alias("_net"),
        F.sum("TaxAmount").alias("_tax"),
    )


def billing_documents(orders: DataFrame, items: DataFrame, lag_days: str = "lag_days",
                      is_cancelled: str = "is_cancelled") -> DataFrame:
    """B2: one F2 per eligible order, before numbering.

    Billing date = creation + ``lag_days`` (an input column: the draw is data, not
    randomness); cancelled documents get status 'A', others 'C'. Totals come from the
    order's items (B5), 0 for an order without items.
    """
    elig = eligible_orders(orders)
    key = _order_key(elig, items)
    d = elig.join(order_item_totals(items, key), key, "left")
    bill = F.date_add(F.col("CreationDate"), F.col(lag_days).cast("int"))
    cancelled = F.col(is_cancelled).cast("boolean")
    return d.select(
        "OrderKey", "SalesOrder",
        F.lit("F2").alias("BillingDocumentType"),
        F.lit(C.FISCAL_BILLING_CATEGORY).alias("BillingDocumentCategory"),
        bill.alias("CreationDate"), bill.alias("BillingDocumentDate"),
        "SalesOrganization",
        F.coalesce(F.col("_net"), F.lit(0).cast("decimal(25,2)")).alias("_net"),
        F.coalesce(F.col("_tax"), F.lit(0).cast("decimal(25,2)")).alias("_tax"),
        "TransactionCurrency", "CustomerPaymentTerms",
        F.col("_payer").alias("PayerParty"), "SoldToParty",
        F.lit(C.COMPANY_CODE).alias("CompanyCode"),
        "IncotermsClassification", "PaymentMethod",
        cancelled.alias("BillingDocumentIsCancelled"),
        F.when(cancelled, "A").otherwise("C").alias("AccountingPostingStatus"),
        fiscal_year(bill).alias("FiscalYear"), fiscal_period(bill).alias("FiscalPeriod"),
    )


def _variants(cancelled: Column) -> Column:
    """0 for the F2; 1 for the S1 of a cancelled one."""
    return F.explode(F.when(cancelled, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))


def document_numbers(eligible: DataFrame, is_cancelled: str = "is_cancelled") -> DataFrame:
    """W4 of the billing documents: (OrderKey, _first), the number of each eligible order's F2.

    Only the key and the flag are range-partitioned and written, whatever the documents carry.
    """
    narrow = eligible.select("OrderKey", _variants(F.col(is_cancelled).cast("boolean")).alias("_s1"))
    return global_row_number(narrow, ["OrderKey", "_s1"], "_first").filter("_s1 = 0").drop("_s1")


def document_keys(eligible: DataFrame, numbers: DataFrame, is_cancelled: str = "is_cancelled", prefix: str = "BD-") -> DataFrame:
    """(OrderKey, BillingDocument, BillingDocumentType) of all documents, without their amounts."""
    x = eligible.select("OrderKey", _variants(F.col(is_cancelled).cast("boolean")).alias("_s1")).join(numbers, "OrderKey")
    return x.select("OrderKey", padded_id(prefix, F.col("_first") + F.col("_s1")).alias("BillingDocument"),
                    F.when(F.col("_s1") == 1, "S1").otherwise("F2").alias("BillingDocumentType"))


def cancellation_pairs(docs: DataFrame, numbers: DataFrame | None = None, prefix: str = "BD-") -> DataFrame:
    """B3 + U2 + W4 + J14: every cancelled F2 is followed by its S1 reversal.

    One pass: each F2 joins its order's number (``numbers``, from ``document_numbers``; made of
    the documents' own keys where none is given) and explodes into itself and, when cancelled,
    its S1 variant. An S1 directly follows its F2, so its reference is the previous number -
    no self-join, and no range exchange of the documents.
    S1: not cancelled, status 'C', amounts negated.
    """
    if numbers is None:
        numbers = document_numbers(docs, "BillingDocumentIsCancelled")
    numbered = (docs.join(numbers, "OrderKey").withColumn("_s1", _variants(F.col("BillingDocumentIsCancelled")))
                .withColumn("_rn", F.col("_first") + F.col("_s1")))
    is_s1 = F.col("_s1") == 1
    sign = F.when(is_s1, F.lit(-1)).otherwise(F.lit(1))
    return numbered.select(
        padded_id(prefix, F.col("_rn")).alias("BillingDocument"),
        F.when(is_s1, "S1").otherwise(F.col("BillingDocumentType")).alias("BillingDocumentType"),
        "BillingDocumentCategory", "CreationDate", "BillingDocumentDate", "SalesOrganization",
        F.bround(F.col("_net") * sign, 2).cast("double").alias("TotalNetAmount"),
        F.bround(F.col("_tax") * sign, 2).cast("double").alias("TotalTaxAmount"),
        "TransactionCurrency", "CustomerPaymentTerms", "PayerParty", "SoldToParty", "CompanyCode",
        "IncotermsClassification", "PaymentMethod",
        F.when(is_s1, F.lit(False)).otherwise(F.col("BillingDocumentIsCancelled")).alias("BillingDocumentIsCancelled"),
        F.when(is_s1, padded_id(prefix, F.col("_rn") - 1)).otherwise(F.lit(None).cast("string")).alias("CancelledBillingDocument"),
        F.when(is_s1, F.lit("C")).otherwise(F.col("AccountingPostingStatus")).alias("AccountingPostingStatus"),
        "FiscalYear", "FiscalPeriod", "SalesOrder", "OrderKey",
    )


def billing_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """B4 + J9 + W5: each document mirrors all items of its order; S1 items are negated.

    Item numbers follow the order item sequence (000010, 000020, ...), which is already
    dense per order, so no second window is needed; items that were not numbered give no
    item number. gross = net + tax; discount base = net.
    """
    key = _order_key(docs, items)
    d = docs.select("BillingDocument", key, (F.col("BillingDocumentType") == "S1").alias("_s1"))
    j = d.join(items, key)
    item_no = [F.col("SalesOrderItem").alias("BillingDocumentItem")] if "SalesOrderItem" in items.columns else []
    sign = F.when(F.col("_s1"), F.lit(-1)).otherwise(F.lit(1))
    net = (F.col("NetAmount") * sign).cast("decimal(16,2)")
    tax = (F.col("TaxAmount") * sign).cast("decimal(16,2)")
    return j.select(
        "BillingDocument",
        *item_no,
        "Material", "Product", "Plant", "MaterialGroup", "ProductHierarchyNode",
        net.cast("double").alias("NetAmount"),
        (net + tax).cast("double").alias("GrossAmount"),
        tax.cast("double").alias("TaxAmount"),
        net.cast("double").alias("EligibleAmountForCashDiscount"),
        F.col("SalesOrderItemCategory").alias("SalesDocumentItemCategory"),
        "SalesOrganization",
    )


def item_amounts(docs: DataFrame, items: DataFrame) -> DataFrame:
    """B4's amounts alone: BillingDocument, NetAmount, TaxAmount of every document item."""
    key = _order_key(docs, items)
    sign = F.when(F.col("BillingDocumentType") == "S1", F.lit(-1)).otherwise(F.lit(1))
    j = docs.select(key, "BillingDocument", "BillingDocumentType").join(items.select(key, "NetAmount", "TaxAmount"), key)
    return j.select("BillingDocument", *[(F.col(c) * sign).cast("decimal(16,2)").cast("double").alias(c) for c in ("NetAmount", "TaxAmount")])


def document_totals(doc_items: DataFrame) -> DataFrame:
    """Net and tax sums per document from its items, rounded to 2."""
    return doc_items.groupBy("BillingDocument").agg(
        F.round(F.sum(F.col("NetAmount").cast("decimal(16,2)")), 2).cast("double").alias("TotalNetAmount"),
        F.round(F.sum(F.col("TaxAmount").cast("decimal(16,2)")), 2).cast("double").alias("TotalTaxAmount"),
    )


def first_items(items: DataFrame, n: int, item_col: str = "SalesOrderItem") -> DataFrame:
    """The first ``n`` items of each order (by item number). Item numbers are dense
    per order (000010, 000020, ...), so this is a filter - no window, no shuffle."""
    return items.filter(F.col(item_col).cast("int") <= F.lit(n * 10))
