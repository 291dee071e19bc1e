"""Demand and price features: seasonal weight (D1), weather multiplier (D2), expected
quantity (D3), price surge (D4), line amounts (D5), phase-out (D6), weather features per
line (D7, J10), requested quantity and date (D8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashcast import config as C
from cashcast.functions.numeric import exact_mean
from cashcast.session import broadcast_if_small
from cashcast.sources.fixtures import lookup


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def seasonal_weight(month, year, group, base_year: int = C.BASE_YEAR) -> Column:
    """L001/L004 get +0.40 Jul-Aug, +0.20 Oct-Nov, -0.20 Jan-Feb; the swing is scaled
    x0.50 for L004 and x0.05 for P001 (which, as the rule is written, receives no offset);
    then x(1 + 0.03 (year - base_year))."""
    m, g = _c(month), _c(group)
    offset = F.lit(0.0)
    for months, off in C.SEASONAL_OFFSETS:
        offset = offset + F.when(m.isin(*months), F.lit(off)).otherwise(F.lit(0.0))
    offset = F.when(g.isin("L001", "L004"), offset).otherwise(F.lit(0.0))
    swing = lookup(g, C.GROUP_SWING, 1.0).cast("double")
    return (F.lit(1.0) + offset * swing) * (F.lit(1.0) + F.lit(C.YOY_GROWTH) * (_c(year) - F.lit(base_year)))


def weather_multiplier(temp, anomaly, group) -> Column:
    """Ramp +50% from 22 to 27 C, +30% above 25 C, +20% per degree of positive
    anomaly, capped at 3x; P001 keeps 30% of the excess."""
    t, a = _c(temp), _c(anomaly)
    ramp = F.when(t > C.HEAT_RAMP_START_C,
                  F.lit(C.HEAT_RAMP_MAX) * F.least((t - F.lit(C.HEAT_RAMP_START_C)) / F.lit(C.HEAT_RAMP_WIDTH_C), F.lit(1.0))
                  ).otherwise(F.lit(0.0))
    hot = F.when(t > C.HOT_THRESHOLD_C, F.lit(C.HOT_BONUS)).otherwise(F.lit(0.0))
    mult = F.least(F.lit(1.0) + ramp + hot + F.lit(C.ANOMALY_BONUS) * F.greatest(F.lit(0.0), a), F.lit(C.WEATHER_CAP))
    return F.when(_c(group) == "P001", F.lit(1.0) + (mult - F.lit(1.0)) * F.lit(C.P001_WEATHER_SHARE)).otherwise(mult)


def expected_quantity(base, seasonal, weather) -> Column:
    """D3: max(1, round(base x seasonal x weather)), half-even; the noise factor is left out."""
    return F.greatest(F.lit(1), F.bround(_c(base) * _c(seasonal) * _c(weather), 0).cast("long"))


def surge_dim(spark):
    """D4 input: SKUs with a Sep-Dec surge and their rate (small fixed table)."""
    from decimal import Decimal
    return spark.createDataFrame([(k, Decimal(r)) for k, r in C.SURGE_SKUS], "sku string, surge_rate decimal(4,2)")


def price_with_surge(df: DataFrame, base: str, month: str, group: str, sku: str) -> DataFrame:
    """x1.05 in Jul-Aug unless P001; + the SKU's surge rate in Sep-Dec for listed SKUs.
    Exact decimal arithmetic, so cent rounding later has no binary ties."""
    s = surge_dim(df.sparkSession).withColumnRenamed("sku", "_sku")
    j = df.join(F.broadcast(s), F.col(sku) == F.col("_sku"), "left")
    one = F.lit(1).cast("decimal(4,2)")
    summer = F.when(F.col(month).isin(*C.SUMMER_MONTHS) & (F.col(group) != "P001"),
                    F.lit(C.SUMMER_SURGE).cast("decimal(4,2)")).otherwise(one)
    autumn = F.when(F.col(month).isin(*C.SURGE_MONTHS) & F.col("surge_rate").isNotNull(),
                    one + F.col("surge_rate")).otherwise(one)
    price = (F.col(base).cast("decimal(15,2)") * summer * autumn).cast("decimal(24,6)")
    return j.withColumn("unit_price", price).drop("_sku", "surge_rate")


def line_amounts(qty, price, currency):
    """net = qty x price (cents); tax = 19% in EUR, else 0. Returns (net, tax) columns."""
    net = F.round(_c(qty).cast("decimal(18,2)") * _c(price).cast("decimal(24,6)"), 2).cast("decimal(20,2)")
    tax = F.when(_c(currency) == "EUR", F.round(net * F.lit(C.VAT_RATE).cast("decimal(4,2)"), 2)).otherwise(F.lit(0)).cast("decimal(20,2)")
    return net, tax


def order_tables(orders: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The full salesorder and salesorderitem tables: lines priced (D4), with their amounts
    (D5) and requested quantity (D8); headers with TotalNetAmount back-filled from the lines
    (A11, J15). ``lines`` carry p_retailprice, SalesOrderDate and TransactionCurrency."""
    priced = price_with_surge(lines.withColumn("_month", F.month("SalesOrderDate")), "p_retailprice", "_month", "MaterialGroup", "Material")
    net, tax = line_amounts("OrderQuantity", "unit_price", "TransactionCurrency")
    factor = F.lit(1.05).cast("decimal(6,2)") + (F.col("OrderKey") % 11) * F.lit(0.01).cast("decimal(6,2)")
    items = priced.withColumns({
        "RequestedQuantity": requested_quantity("OrderQuantity", factor), "RequestedQuantityUnit": F.lit("CS"),
        "NetPriceAmount": F.round("unit_price", 2).cast("decimal(24,2)"), "NetAmount": net, "TaxAmount": tax,
    }).select("OrderKey", *ITEM_TABLE)
    totals = items.groupBy("OrderKey").agg(F.sum("NetAmount").alias("TotalNetAmount"))
    return orders.join(totals, "OrderKey", "left").select(*ORDER_TABLE), items.drop("OrderKey")


# FIXED VALUES: column names of the two order tables
ORDER_TABLE = [
    "SalesOrder", "SalesOrderType", "CreationDate", "SalesOrderDate", "SoldToParty", "SalesOrganization", "DistributionChannel",
    "OrganizationDivision", "SalesGroup", "SalesOffice", "TransactionCurrency", "TotalNetAmount", "CustomerPaymentTerms",
    "RequestedDeliveryDate", "IncotermsClassification", "DeliveryBlockReason", "HeaderBillingBlockReason",
    "OverallSDProcessStatus", "OverallSDDocumentRejectionSts", "FiscalYear", "FiscalPeriod", "BillingCompanyCode",
    "PaymentMethod", "AdditionalCustomerGroup1",
]

ITEM_TABLE = [
    "SalesOrder", "SalesOrderItem", "Material", "Product", "Plant", "MaterialGroup", "ProductHierarchyNode", "OrderQuantity",
    "OrderQuantityUnit", "RequestedQuantity", "RequestedQuantityUnit", "NetPriceAmount", "NetAmount", "TaxAmount",
    "SalesOrderItemCategory", "SalesDocumentRjcnReason", "DeliveryStatus", "BillingBlockStatus", "DeliveryPriority",
    "InternationalArticleNumber", "SalesOrganization", "DistributionChannel", "SoldToParty", "PayerParty",
]


def phase_out_filter(lines: DataFrame, phased_out, date_col: str = "SalesOrderDate",
                     material: str = "Material") -> DataFrame:
    """Drop lines of a phased-out material on or after its phase-out date."""
    cond = F.lit(False)
    for sku, since in phased_out:
        cond = cond | ((F.col(material) == sku) & (F.col(date_col) >= F.lit(str(since)).cast("date")))
    return lines.filter(~cond)


def weather_lookup(orders: DataFrame, weather: DataFrame, fallback=C.WEATHER_FALLBACK, few_places: bool = False) -> DataFrame:
    """Weather of the customer's (country, region) in the order's month; default
    (10.0, 0.0) when there is none. Several stations of one place and month count with
    their mean, so an order never gets two rows. ``few_places`` says that the places are a
    dimension of fixed size (countries' regions), so a row per place and calendar month is
    broadcast and the orders need no shuffle by a few skewed places; else that is up to a count."""
    w = weather.groupBy(F.col("country").alias("_cty"), F.col("region").alias("_reg"),
                        F.col("year").alias("_y"), F.col("month").alias("_m")).agg(
        exact_mean("avg_temp_c").alias("avg_temp_c"), exact_mean("temp_anomaly_c").alias("temp_anomaly_c"))
    d = F.col("SalesOrderDate")
    cond = ((F.col("Country") == F.col("_cty")) & (F.col("Region") == F.col("_reg"))
            & (F.year(d) == F.col("_y")) & (F.month(d) == F.col("_m")))
    return (orders.join(F.broadcast(w) if few_places else broadcast_if_small(w), cond, "left")
            .withColumn("avg_temp_c", F.coalesce("avg_temp_c", F.lit(float(fallback[0]))))
            .withColumn("temp_anomaly_c", F.coalesce("temp_anomaly_c", F.lit(float(fallback[1]))))
            .drop("_cty", "_reg", "_y", "_m"))


def demand_weather_features(lines: DataFrame, base_year: int = C.BASE_YEAR) -> DataFrame:
    """Per item line the seasonal weight (D1) and the weather multiplier (D2), from its order's
    date and weather. J10 goes to the headers first, so items and orders are joined once."""
    d = F.col("SalesOrderDate")
    return lines.withColumns({
        "seasonal_weight": seasonal_weight(F.month(d), F.year(d), F.col("MaterialGroup"), base_year),
        "weather_mult": weather_multiplier(F.col("avg_temp_c"), F.col("temp_anomaly_c"), F.col("MaterialGroup")),
    })


def requested_quantity(qty, factor) -> Column:
    """max(qty + 1, round(qty x factor)), half-even; factor is an input column."""
    q = _c(qty)
    return F.greatest(q.cast("long") + 1, F.bround(q.cast("decimal(18,2)") * _c(factor).cast("decimal(6,2)"), 0).cast("long"))


def requested_date(created, days) -> Column:
    """Creation date + days (input column)."""
    return F.date_add(_c(created), _c(days).cast("int"))
