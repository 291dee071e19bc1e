"""Cash: payment terms (C1, P7, J7, J8, J13), posting date (C2), collected amount (C3),
cash postings (C4, X9, X18, W4), seasonal index (C5, A6, A7), daily cash forecast (C6, J11)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, StringType, StructField, StructType

from cashcast import config as C
from cashcast.functions.calendar import iso_week
from cashcast.functions.numeric import clamp, padded_id, validity_value
from cashcast.operators.ids import global_row_number
from cashcast.sources.fixtures import lookup

MONEY = "decimal(34,4)"


# --- fixed parameter dimensions (S2: small typed frames; a few rows, always broadcast) ---

def terms_dim(spark: SparkSession) -> DataFrame:
    schema = StructType([StructField("Tier", StringType(), False), StructField("dso_mean", IntegerType()),
                         StructField("dso_std", IntegerType()), StructField("rate_lo", DecimalType(5, 2)),
                         StructField("rate_hi", DecimalType(5, 2))])
    from decimal import Decimal
    rows = [(t, m, s, Decimal(str(lo)), Decimal(str(hi))) for t, m, s, lo, hi in C.TIER_TERMS]
    return spark.createDataFrame(rows, schema)


def dunning_dim(spark: SparkSession) -> DataFrame:
    from decimal import Decimal
    schema = StructType([StructField("DunningLevel", IntegerType(), False), StructField("adj_days", IntegerType()),
                         StructField("mult", DecimalType(5, 2))])
    return spark.createDataFrame([(lv, d, Decimal(str(m))) for lv, d, m in C.DUNNING_TERMS], schema)


def fx_dim(spark: SparkSession) -> DataFrame:
    from decimal import Decimal
    schema = StructType([StructField("TransactionCurrency", StringType(), False), StructField("fx_rate", DecimalType(10, 4))])
    return spark.createDataFrame([(c, Decimal(str(r))) for c, r in C.FX_RATES], schema)


# --- operators ------------------------------------------------------------------------

def dunning_levels(dunning: DataFrame) -> DataFrame:
    """J8 pre-aggregation: one level per customer (the highest when several rows exist)."""
    return dunning.groupBy("Customer").agg(F.max("DunningLevel").alias("DunningLevel"))


def payment_terms(docs: DataFrame, tiers: DataFrame, dunning: DataFrame) -> DataFrame:
    """Open F2 documents (P7) with the payer's tier (J7, inner: unknown payers are
    skipped), dunning level (J8, missing or null -> 0) and tier / dunning parameters (J13;
    an unknown level -> +0 days, x1.00)."""
    spark = docs.sparkSession
    open_f2 = docs.filter((F.col("BillingDocumentIsCancelled") == F.lit(False)) & (F.col("BillingDocumentType") == "F2"))
    # one payer dimension (tier and level), joined to the documents once
    payers = (tiers.select("Customer", "Tier").join(dunning_levels(dunning), "Customer", "left")
              .select(F.col("Customer").alias("PayerParty"), "Tier", F.coalesce("DunningLevel", F.lit(0)).alias("DunningLevel")))
    j = (open_f2.join(payers, "PayerParty")
         .join(F.broadcast(terms_dim(spark)), "Tier")
         .join(F.broadcast(dunning_dim(spark)), "DunningLevel", "left"))
    return j.withColumns({
        "adj_days": F.coalesce(F.col("adj_days"), F.lit(0)),
        "mult": F.coalesce(F.col("mult"), F.lit(1).cast("decimal(5,2)")),
    })


def posting_date(billing_date, base_dso, adj_days, noise):
    """Billing date + clamp(max(1, base) + adj + noise, 1, 180) days. Returns (days, date)."""
    days = clamp(F.greatest(F.lit(1), base_dso) + adj_days + noise, C.DSO_MIN, C.DSO_MAX).cast("int")
    return days, F.date_add(billing_date, days)


def collected_amount(net, rate, mult):
    """round(net x rate x multiplier, 4), half-even, in exact decimals."""
    return F.bround(net.cast("decimal(20,2)") * rate.cast("decimal(5,2)") * mult.cast("decimal(5,2)"), 4).cast(MONEY)


def posting_numbers(keys: DataFrame, order_key: str = "OrderKey") -> DataFrame:
    """W4 of the postings: (order key, _rn) of the orders that have one, in order."""
    return global_row_number(keys.select(order_key), [order_key], "_rn")


def cash_postings(terms: DataFrame, base_dso: str = "base_dso", noise: str = "noise",
                  base_rate: str = "base_rate", order_key: str = "OrderKey", prefix: str = "CF-",
                  numbered: bool = True, numbers: DataFrame | None = None) -> DataFrame:
    """C4: one cash row per open F2 with a known payer: posting date, collected amount,
    conversion into company currency (X18, via the FX dimension; an unknown currency
    gives NULL), house bank, validity value (X9) and CF-numbering (W4) in document order.

    ``base_dso``, ``noise`` and ``base_rate`` are input columns (the draws are data).
    Numbers come from narrow rows of the order key, one posting an order: ``numbers`` (order
    key, ``_rn``; see ``posting_numbers``), or else the postings' own keys.
    With ``numbered=False`` the CashFlowID is left NULL: consumers that only aggregate
    the postings (seasonal index, checks) skip the global numbering.
    """
    spark = terms.sparkSession
    days, post = posting_date(F.col("BillingDocumentDate"), F.col(base_dso), F.col("adj_days"), F.col(noise))
    amount = collected_amount(F.col("TotalNetAmount"), F.col(base_rate), F.col("mult"))
    rows = (terms.withColumns({"total_dso": days, "PostingDate": post, "_amount": amount})
            .join(F.broadcast(fx_dim(spark)), "TransactionCurrency", "left"))
    if numbered:
        rows = rows.join(posting_numbers(terms, order_key) if numbers is None else numbers, order_key)
        cf_id = padded_id(prefix, F.col("_rn"))
    else:
        cf_id = F.lit(None).cast("string")
    cc = F.bround(F.col("_amount").cast("decimal(24,4)") * F.col("fx_rate"), 4).cast(MONEY)
    return rows.select(
        cf_id.alias("CashFlowID"),
        validity_value("PostingDate").alias("CshFlwValdtyStrtDteTmeVal"),
        F.lit(C.COMPANY_CODE).alias("CompanyCode"),
        F.col("PostingDate").alias("TransactionDate"),
        "PostingDate", "TransactionCurrency",
        F.col("_amount").alias("AmountInTransactionCurrency"),
        F.lit(C.COMPANY_CURRENCY).alias("CompanyCodeCurrency"),
        cc.alias("AmountInCompanyCodeCurrency"),
        F.lit(C.COMPANY_CURRENCY).alias("GlobalCurrency"),
        cc.alias("AmountInGlobalCurrency"),
        lookup(F.col("TransactionCurrency"), C.BANK_BY_CURRENCY[:1], C.BANK_BY_CURRENCY[1][1]).alias("BankAccountInternalID"),
        "BillingDocument",
    )


def seasonal_index(cash: DataFrame, first_year: int, last_year: int,
                   amount: str = "AmountInCompanyCodeCurrency") -> DataFrame:
    """Mean amount per posting for each ISO week (A6) over calendar years
    [first_year, last_year], divided by the unweighted mean of those weekly means (A7);
    index 1.0 when the overall mean is 0. Postings without an amount (no rate for their
    currency) cannot count; ``n_skipped`` tells how many of the week's they are.

    The weekly mean is the exact decimal sum over the count, so it does not depend on
    how rows are split over partitions. The first aggregate leaves at most 53 rows, so the overall mean is a window over a
    frame whose size is fixed by the calendar.
    """
    y = F.year("PostingDate")
    weekly = (cash.filter((y >= first_year) & (y <= last_year))
              .groupBy(iso_week("PostingDate").alias("iso_week"))
              .agg((F.sum(F.col(amount)).cast("double") / F.count(F.col(amount)).cast("double")).alias("mean_amount"),
                   F.count_if(F.col(amount).isNull()).alias("n_skipped")))
    overall = F.avg("mean_amount").over(_whole())
    return weekly.withColumn("overall_mean", overall).withColumn(
        "seasonal_index",
        F.when(F.col("overall_mean") != 0, F.col("mean_amount") / F.col("overall_mean")).otherwise(F.lit(1.0)))


def _whole():
    from pyspark.sql import Window
    return Window.partitionBy(F.lit(0))


def cash_forecast(index: DataFrame, start: dt.date, months: int, growth: float = C.CASH_GROWTH,
                  noise: float = 1.0, prefix: str = "FCF-") -> DataFrame:
    """One row per day from ``start`` for ``months`` months:
    overall/7 x index(ISO week of the day) x growth x noise, half-even to 4 digits.

    A week without history takes index 1.0 (J11). The spine is exploded from the
    one-row overall mean, so the job derives from the cash table; numbers follow the
    day offset, so no window is needed.
    """
    # the index (53 weeks at most) becomes one row, so it is computed once
    overall = index.agg(F.first("overall_mean", ignorenulls=True).alias("overall_mean"),
                        F.map_from_entries(F.collect_list(F.struct("iso_week", "seasonal_index"))).alias("_index"))
    start_c = F.lit(str(start)).cast("date")
    end_c = F.date_sub(F.add_months(start_c, months), 1)
    days = overall.select("overall_mean", "_index", F.explode(F.sequence(start_c, end_c)).alias("d"))
    days = days.withColumn("iso_week", iso_week("d"))
    j = days
    si = F.coalesce(F.try_element_at("_index", F.col("iso_week")), F.lit(1.0))
    base = F.coalesce(F.col("overall_mean"), F.lit(0.0))
    value = F.bround(base / 7 * si * F.lit(growth) * F.lit(noise), 4).cast(MONEY)
    n = F.datediff(F.col("d"), start_c) + 1
    return j.select(
        padded_id(prefix, n).alias("CashFlowID"),
        validity_value("d").alias("CshFlwValdtyStrtDteTmeVal"),
        F.lit(C.COMPANY_CODE).alias("CompanyCode"),
        F.col("d").alias("TransactionDate"), F.col("d").alias("PostingDate"),
        F.lit(C.COMPANY_CURRENCY).alias("TransactionCurrency"),
        value.alias("AmountInTransactionCurrency"),
        F.lit(C.COMPANY_CURRENCY).alias("CompanyCodeCurrency"),
        value.alias("AmountInCompanyCodeCurrency"),
        F.lit(C.COMPANY_CURRENCY).alias("GlobalCurrency"),
        value.alias("AmountInGlobalCurrency"),
    )
