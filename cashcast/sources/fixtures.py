"""Business tables built from the driver's TPC-H-style tables (FIXTURES.md section 3).

Each builder is a lazy DataFrame plan over parquet scans, so Catalyst prunes the
columns and pushes the filters of whatever operator consumes it. Builders come in
slim variants so a query joins only what it needs.

Broadcasts here are limited to ``nation`` and ``region``: fixed-size dimensions
(25 and 5 rows at every scale factor). Every other join is left to the planner,
which with AQE broadcasts a side only after measuring it at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cashcast import config as C
from cashcast.functions.calendar import fiscal_period, fiscal_year
from cashcast.functions.numeric import padded
from cashcast.sources.tables import read_table


def lookup(col: Column, pairs, default=None) -> Column:
    """CASE expression from a fixed (key, value) list."""
    expr = None
    for k, v in pairs:
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def material_group(type_col: Column) -> Column:
    return lookup(type_col, C.MATERIAL_GROUPS)


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, "nation", sf_dir).select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, "region", sf_dir).select("r_regionkey", "r_name")
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey, "left")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer geo + tier: Customer, CustKey, Country, Region, Segment, Tier, Currency."""
    cust = read_table(spark, "customer", sf_dir).select("c_custkey", "c_nationkey", "c_mktsegment")
    geo = _geo(spark, sf_dir)
    df = cust.join(F.broadcast(geo), cust.c_nationkey == geo.n_nationkey, "left")
    return df.select(
        F.col("c_custkey").cast("string").alias("Customer"),
        F.col("c_custkey").alias("CustKey"),
        F.col("r_name").alias("Country"),
        F.col("n_name").alias("Region"),
        F.col("c_mktsegment").alias("Segment"),
        lookup(F.col("c_mktsegment"), C.SEGMENT_TIERS).alias("Tier"),
        lookup(F.col("r_name"), C.REGION_CURRENCY, C.OTHER_REGION_CURRENCY).alias("Currency"),
    )


def customer_dunning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customerdunning: one row per customer, level custkey % 5 with 4 standing for null."""
    cust = read_table(spark, "customer", sf_dir).select("c_custkey")
    lvl = F.col("c_custkey") % 5
    return cust.select(
        F.col("c_custkey").cast("string").alias("Customer"),
        F.when(lvl == 4, F.lit(None)).otherwise(lvl).cast("int").alias("DunningLevel"),
    )


def _sales_areas(cust: DataFrame) -> DataFrame:
    """Customers with one row for each of their channels: 20 for everyone, plus 10 when custkey % 3 = 0."""
    channels = F.when(F.col("CustKey") % 3 == 0, F.array(F.lit("10"), F.lit("20"))).otherwise(F.array(F.lit("20")))
    return cust.withColumn("DistributionChannel", F.explode(channels)).withColumns({
        "CustomerPaymentTerms": lookup(F.col("Tier"), C.TIER_PAYMENT_TERMS, C.OTHER_PAYMENT_TERMS),
        "IncotermsClassification": F.when(F.col("DistributionChannel") == "10", F.lit("EXW")).otherwise(F.lit("FCA")),
        "CustomerGroup": F.when(F.col("CustKey") % 4 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("KG0"), (F.col("CustKey") % 3 + 2).cast("string"))),
    })


def customer_sales_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customersalesarea: one row per customer and channel."""
    return _sales_areas(customers(spark, sf_dir)).select(
        "Customer", "CustKey", "DistributionChannel", "CustomerPaymentTerms", "IncotermsClassification", "Currency", "CustomerGroup")


def preferred_sales_area(area: DataFrame, key: str = "Customer") -> DataFrame:
    """One sales-area row per customer, channel '10' first, then the lowest channel."""
    w = Window.partitionBy(key).orderBy((F.col("DistributionChannel") != C.DEFAULT_CHANNEL), "DistributionChannel")
    return area.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer geo + preferred sales area, one row per customer. Dealt out by CustKey once,
    which the join with the orders uses again."""
    return preferred_sales_area(_sales_areas(customers(spark, sf_dir)), "CustKey")


def sales_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """salesorder header (orders x customer dimension). TotalNetAmount is back-filled by A11."""
    o = read_table(spark, "orders", sf_dir).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    dim = customer_dim(spark, sf_dir)
    df = o.join(dim, o.o_custkey == dim.CustKey, "left")
    created = F.col("o_orderdate").cast("date")
    return df.select(
        F.col("o_orderkey").alias("OrderKey"),
        F.col("o_orderkey").cast("string").alias("SalesOrder"),
        F.lit("OR").alias("SalesOrderType"),
        created.alias("CreationDate"),
        created.alias("SalesOrderDate"),
        F.col("o_custkey").cast("string").alias("SoldToParty"),
        F.lit(C.SALES_ORGANIZATION).alias("SalesOrganization"),
        F.coalesce(F.col("DistributionChannel"), F.lit(C.DEFAULT_CHANNEL)).alias("DistributionChannel"),
        F.lit("01").alias("OrganizationDivision"),
        F.lit("SG01").alias("SalesGroup"),
        F.lit("SO01").alias("SalesOffice"),
        F.col("Currency").alias("TransactionCurrency"),
        F.col("CustomerPaymentTerms"),
        F.date_add(created, (F.col("o_orderkey") % 17 + 5).cast("int")).alias("RequestedDeliveryDate"),
        F.col("IncotermsClassification"),
        F.lit("").alias("DeliveryBlockReason"),
        F.lit("").alias("HeaderBillingBlockReason"),
        lookup(F.col("o_orderstatus"), C.ORDER_STATUS).alias("OverallSDProcessStatus"),
        F.when(F.col("o_orderpriority") == C.REJECTED_PRIORITY, F.lit("C")).otherwise(F.lit("")).alias("OverallSDDocumentRejectionSts"),
        fiscal_year(created).alias("FiscalYear"),
        fiscal_period(created).alias("FiscalPeriod"),
        F.lit(C.COMPANY_CODE).alias("BillingCompanyCode"),
        F.lit("T").alias("PaymentMethod"),
        F.coalesce(F.col("CustomerGroup"), F.lit(C.DEFAULT_CUSTOMER_GROUP)).alias("AdditionalCustomerGroup1"),
        F.col("Country"), F.col("Region"), F.col("Tier"),
    )


_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def net_amount() -> Column:
    """l_extendedprice * (1 - l_discount), exact in decimal, rounded to cents."""
    return F.expr("CAST(ROUND(CAST(l_extendedprice AS DECIMAL(15,2)) * "
                  "(1 - CAST(l_discount AS DECIMAL(15,2))), 2) AS DECIMAL(15,2))")


def tax_amount(currency: Column) -> Column:
    """19 % of NetAmount in EUR, else 0."""
    return F.when(currency == "EUR", F.expr("CAST(ROUND(NetAmount * 0.19, 2) AS DECIMAL(15,2))")).otherwise(F.lit(0).cast("decimal(15,2)"))


def item_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """salesorderitem, slim: one row per item (OrderKey, Material, MaterialGroup, OrderQuantity)."""
    li = read_table(spark, "lineitem", sf_dir).select("l_orderkey", "l_partkey", "l_quantity")
    p = read_table(spark, "part", sf_dir).select("p_partkey", "p_type")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_orderkey").alias("OrderKey"),
        F.col("p_type").alias("Material"),
        material_group(F.col("p_type")).alias("MaterialGroup"),
        F.col("l_quantity").cast("int").alias("OrderQuantity"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 slim: one row per item with the header's order date (SalesOrderDate, Material, MaterialGroup, OrderQuantity)."""
    li = read_table(spark, "lineitem", sf_dir).select("l_orderkey", "l_partkey", "l_quantity")
    o = read_table(spark, "orders", sf_dir).select("o_orderkey", "o_orderdate")
    p = read_table(spark, "part", sf_dir).select("p_partkey", "p_type")
    df = li.join(p, li.l_partkey == p.p_partkey).join(o, li.l_orderkey == o.o_orderkey)
    return df.select(
        F.col("l_orderkey").cast("string").alias("SalesOrder"),
        F.col("o_orderdate").cast("date").alias("SalesOrderDate"),
        F.col("p_type").alias("Material"),
        material_group(F.col("p_type")).alias("MaterialGroup"),
        F.col("l_quantity").cast("int").alias("OrderQuantity"),
    )


def sales_order_items(spark: SparkSession, sf_dir: str, header: DataFrame | None = None,
                      numbered: bool = True, carry: tuple[str, ...] = (), first: int | None = None) -> DataFrame:
    """salesorderitem: lineitem x part, with header fields carried from the order.

    ``carry`` names further columns of the header (or of ``part``) that the caller needs on
    the lines, so that the items are joined to their orders once.

    Item numbers (000010, 000020, ...) follow the line order inside each order. They are
    computed skew-safe (``rank_within``) on the
    narrow lineitem rows before the joins, and only when asked for: totals per order do
    not need them. With ``first`` only that many items of each order are kept (W6), which Spark
    limits already before the exchange.
    """
    li = read_table(spark, "lineitem", sf_dir).select("l_orderkey", *_LINE_ORDER)
    if numbered:
        from cashcast.operators.ids import rank_within
        li = rank_within(li, ["l_orderkey"], _LINE_ORDER, "_item")
        li = li if first is None else li.filter(F.col("_item") <= first)
    from_part = [c for c in carry if c.startswith("p_")]
    p = read_table(spark, "part", sf_dir).select("p_partkey", "p_type", "p_brand", *from_part)
    hdr = (header if header is not None else sales_orders(spark, sf_dir)).select(
        "OrderKey", "SalesOrganization", "DistributionChannel", "SoldToParty",
        "TransactionCurrency", "OverallSDDocumentRejectionSts", "Tier", *[c for c in carry if c != "Tier" and c not in (*from_part, "TransactionCurrency")])
    df = li.join(p, li.l_partkey == p.p_partkey).join(hdr, li.l_orderkey == hdr.OrderKey)
    df = df.withColumn("NetAmount", net_amount())
    tax = tax_amount(F.col("TransactionCurrency"))
    item_no = [padded(F.col("_item") * 10).alias("SalesOrderItem")] if numbered else []
    return df.select(
        F.col("l_orderkey").alias("OrderKey"),
        F.col("l_orderkey").cast("string").alias("SalesOrder"),
        *item_no,
        F.col("p_type").alias("Material"),
        F.col("p_type").alias("Product"),
        F.when(F.col("DistributionChannel") == "10", F.lit("PLANT1")).otherwise(F.lit("PLANT2")).alias("Plant"),
        material_group(F.col("p_type")).alias("MaterialGroup"),
        F.col("p_brand").alias("ProductHierarchyNode"),
        F.col("l_quantity").cast("int").alias("OrderQuantity"),
        F.lit("CS").alias("OrderQuantityUnit"),
        F.col("NetAmount"),
        tax.alias("TaxAmount"),
        F.lit("TAN").alias("SalesOrderItemCategory"),
        F.when(F.col("OverallSDDocumentRejectionSts") == "C", F.lit("Z1")).otherwise(F.lit("")).alias("SalesDocumentRjcnReason"),
        F.lit("C").alias("DeliveryStatus"),
        F.lit("").alias("BillingBlockStatus"),
        lookup(F.col("Tier"), [("A", "1"), ("B", "5"), ("C", "9")], "9").alias("DeliveryPriority"),
        F.col("p_brand").alias("InternationalArticleNumber"),
        "SalesOrganization", "DistributionChannel", "SoldToParty",
        F.col("SoldToParty").alias("PayerParty"), *carry,
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """weather: one row per (supplier nation, ship month) with lineitem averages as readings.

    lineitem is first reduced to (supplier, year, month) partial sums, so the join
    with supplier and the final aggregate see supplier x month rows, not line rows.
    Readings: mean quantity as temperature, mean discount in percent - 5 as anomaly,
    mean tax in per mille as precipitation.
    """
    li = read_table(spark, "lineitem", sf_dir).select("l_suppkey", "l_quantity", "l_discount", "l_tax", "l_shipdate")
    part = (li.groupBy("l_suppkey", F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"))
            .agg(F.sum("l_quantity").alias("q"), F.sum(F.round(F.col("l_discount") * 100)).alias("d"),
                 F.sum(F.round(F.col("l_tax") * 1000)).alias("t"), F.count(F.lit(1)).alias("n")))
    sup = read_table(spark, "supplier", sf_dir).select("s_suppkey", "s_nationkey")
    geo = _geo(spark, sf_dir)
    df = part.join(sup, part.l_suppkey == sup.s_suppkey).join(F.broadcast(geo), F.col("s_nationkey") == geo.n_nationkey)
    agg = df.groupBy("n_nationkey", "n_name", "r_name", "year", "month").agg(
        F.sum("q").alias("q"), F.sum("d").alias("d"), F.sum("t").alias("t"), F.sum("n").alias("n"))
    # readings are rounded half-up to 2 decimals (precipitation to 1), as in a weather
    # table, using integer arithmetic: (x * 2k + n) div (2n) = round(x / n, k digits)
    def rounded(col: str, scale: int) -> Column:
        return F.expr(f"(CAST({col} AS BIGINT) * {2 * scale} + CAST(n AS BIGINT)) div (CAST(n AS BIGINT) * 2)")

    return agg.select(
        F.concat(F.lit("ST_"), F.col("n_nationkey").cast("string")).alias("station_id"),
        F.col("n_name").alias("station_name"),
        F.col("r_name").alias("country"),
        F.col("n_name").alias("region"),
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        (rounded("q", 100) / F.lit(100.0)).alias("avg_temp_c"),
        ((rounded("d", 100) - F.lit(500)) / F.lit(100.0)).alias("temp_anomaly_c"),
        (rounded("t", 10) / F.lit(10.0)).alias("precipitation_mm"),
        F.lit(False).alias("extreme_heat_flag"),
    )


def item_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """salesorderitem, slim: OrderKey, SalesOrder, PayerKey, NetAmount, TaxAmount; what totals need."""
    li = read_table(spark, "lineitem", sf_dir).select("l_orderkey", "l_partkey", "l_extendedprice", "l_discount")
    p = read_table(spark, "part", sf_dir).select("p_partkey")
    o = read_table(spark, "orders", sf_dir).select("o_orderkey", "o_custkey")
    cust = customers(spark, sf_dir).select("CustKey", "Currency")
    hdr = o.join(cust, o.o_custkey == cust.CustKey, "left")
    df = li.join(p, li.l_partkey == p.p_partkey, "left_semi").join(hdr, li.l_orderkey == hdr.o_orderkey)
    return df.withColumn("NetAmount", net_amount()).select(
        F.col("l_orderkey").alias("OrderKey"), F.col("l_orderkey").cast("string").alias("SalesOrder"),
        F.col("o_custkey").alias("PayerKey"), "NetAmount", tax_amount(F.col("Currency")).alias("TaxAmount"))


def order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """billing_orders, slim: keys, statuses and the cancellation draw, from the orders alone."""
    o = read_table(spark, "orders", sf_dir)
    return o.select(
        F.col("o_orderkey").alias("OrderKey"), F.col("o_orderkey").cast("string").alias("SalesOrder"),
        F.col("o_custkey").cast("string").alias("SoldToParty"),
        lookup(F.col("o_orderstatus"), C.ORDER_STATUS).alias("OverallSDProcessStatus"),
        F.when(F.col("o_orderpriority") == C.REJECTED_PRIORITY, F.lit("C")).otherwise(F.lit("")).alias("OverallSDDocumentRejectionSts"),
        (F.col("o_orderkey") % 10 == 0).alias("is_cancelled"))


def orders_with_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OrderKey of every order that has an item, once (reduced before it is shuffled)."""
    li = read_table(spark, "lineitem", sf_dir).select("l_orderkey", "l_partkey")
    p = read_table(spark, "part", sf_dir).select("p_partkey")
    return li.join(p, li.l_partkey == p.p_partkey, "left_semi").select(F.col("l_orderkey").alias("OrderKey")).distinct()


def billing_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """salesorder plus the billing draws re-aimed as data: lag_days and is_cancelled."""
    return sales_orders(spark, sf_dir).withColumns({
        "lag_days": (F.lit(3) + F.col("OrderKey") % 8).cast("int"),
        "is_cancelled": (F.col("OrderKey") % 10 == 0),
    })


def cash_draws(terms: DataFrame) -> DataFrame:
    """The cash draws re-aimed as data, from the document's order key and tier terms:
    base_dso = tier mean + key % 11 - 5, noise = key % 7 - 3, base_rate = tier low + (key % 4) x 0.01."""
    key = F.col("SalesOrder").cast("bigint")
    return terms.withColumns({
        "OrderKey": key,
        "base_dso": (F.col("dso_mean") + key % 11 - 5).cast("int"),
        "noise": (key % 7 - 3).cast("int"),
        "base_rate": (F.col("rate_lo") + (key % 4) * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(5,2)"),
    })
