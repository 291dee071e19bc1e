"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

tables through ``cashcast.sources.fixtures`` so its work grows with them.
"""

from __future__ import annotations

import functools
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashcast.config import DEFAULT as CFG
from cashcast.operators import history as H
from cashcast.session import store
from cashcast.sources import fixtures as X
from cashcast.sources.tables import schemas_read_once, table_profile

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Intermediates shared by the branches of one query (e.g. the numbered billing documents
# used by several checks) are built once per query call. The memo is per thread and
# cleared when the call returns, so every query still computes everything it needs.
_LOCAL = threading.local()


def _memo_dict() -> dict:
    if not hasattr(_LOCAL, "memo"):
        _LOCAL.memo = {}
    return _LOCAL.memo


def memo(fn):
    @functools.wraps(fn)
    def wrapper(spark, sf_dir):
        m = _memo_dict()
        key = (fn.__name__, id(spark), sf_dir)
        if key not in m:
            m[key] = fn(spark, sf_dir)
        return m[key]
    return wrapper


def query(name: str):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            _memo_dict().clear()
            try:
                with schemas_read_once():
                    return fn(spark, sf_dir)
            finally:
                _memo_dict().clear()
        QUERIES[name] = run
        return fn
    return deco


@memo
def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.weekly_history(H.daily_feature(X.order_lines(spark, sf_dir)), CFG.training_end, CFG.materials)


@query("a17_daily_feature")
def a17_daily_feature(spark, sf_dir):
    return H.daily_feature(X.order_lines(spark, sf_dir))


@query("f5_weekly_history")
def f5_weekly_history(spark, sf_dir):
    return _history(spark, sf_dir)


@query("f6_weekly_actuals")
def f6_weekly_actuals(spark, sf_dir):
    orders = X.read_table(spark, "orders", sf_dir).select(
        F.col("o_orderkey").alias("OrderKey"), F.col("o_orderdate").alias("SalesOrderDate"))
    return H.weekly_actuals(X.item_lines(spark, sf_dir), orders, CFG.training_end, CFG.materials, key="OrderKey")


@query("f4_monthly_regressors")
def f4_monthly_regressors(spark, sf_dir):
    return H.monthly_regressors(X.weather(spark, sf_dir), CFG.countries).select(
        "month_start", F.round("avg_temp_c", 6).alias("avg_temp_c"), F.round("temp_anomaly_c", 6).alias("temp_anomaly_c"))


@query("a8_history_profile")
def a8_history_profile(spark, sf_dir):
    return H.history_profile(_history(spark, sf_dir))


@query("a9_run_summary")
def a9_run_summary(spark, sf_dir):
    return H.run_summary(_history(spark, sf_dir))


@query("a9_weather_summary")
def a9_weather_summary(spark, sf_dir):
    """A9 of the weather table: months and stations."""
    w = X.weather(spark, sf_dir).withColumn("month_start", F.make_date("year", "month", F.lit(1)))
    return H.run_summary(w, "month_start", "station_id")


@query("f12_split")
def f12_split(spark, sf_dir):
    feature = H.daily_feature(X.order_lines(spark, sf_dir))
    train, complete = H.split_by_date(feature, "SalesOrderDate", CFG.training_end, CFG.test_end)
    test = H.test_window(complete, "SalesOrderDate", CFG.training_end, CFG.test_end)
    return (train.withColumn("split", F.lit("train"))
            .unionByName(test.withColumn("split", F.lit("test")))
            .groupBy("split", "Material")
            .agg(F.count(F.lit(1)).alias("days"), F.sum("Sum_OrderQuantity").cast("bigint").alias("qty")))


# --- regressors, spine, naive forecast, evaluation -------------------------------------

from cashcast.operators import evaluate as EV  # noqa: E402
from cashcast.operators.regressors import attach_regressors  # noqa: E402

REGRESSORS = "avg_temp_c, temp_anomaly_c"
# every listed material gets a status row, also one that was never ordered before the training end
LISTED = (*CFG.materials, "UNLISTED")


@memo
def _monthly(spark, sf_dir):
    return H.monthly_regressors(X.weather(spark, sf_dir), CFG.countries)


@memo
def _actuals(spark, sf_dir):
    return f6_weekly_actuals(spark, sf_dir)


@query("f3_regressor_fill")
def f3_regressor_fill(spark, sf_dir):
    hist = _history(spark, sf_dir).select(F.col("week_start").alias("ds"), "Material", "MaterialGroup")
    filled = attach_regressors(hist, _monthly(spark, sf_dir), fallback=CFG.fallback, order_extra=("MaterialGroup",))
    return filled.select("ds", "Material", F.round("avg_temp_c", 6).alias("avg_temp_c"),
                         F.round("temp_anomaly_c", 6).alias("temp_anomaly_c"))


@query("f2_future_weeks")
def f2_future_weeks(spark, sf_dir):
    return EV.future_weeks(_history(spark, sf_dir), CFG.horizon).select("Material", "MaterialGroup", "ds")


@query("f10_naive_yoy")
def f10_naive_yoy(spark, sf_dir):
    return EV.naive_yoy_forecast(_history(spark, sf_dir), CFG.horizon)


@memo
def _naive_forecast_rows(spark, sf_dir):
    return _naive_rows(EV.naive_yoy_forecast(_history(spark, sf_dir), CFG.horizon))


def _naive_rows(naive: DataFrame) -> DataFrame:
    """Naive forecasts under the forecast table's names, without a band."""
    return naive.select(
        F.col("ds").alias("SalesOrderDate"), "Material", "MaterialGroup", "predicted_qty",
        F.lit(None).cast("double").alias("predicted_qty_lower"),
        F.lit(None).cast("double").alias("predicted_qty_upper"))


@query("f7_forecast_vs_actual")
def f7_forecast_vs_actual(spark, sf_dir):
    return EV.forecast_vs_actual(_naive_forecast_rows(spark, sf_dir), _actuals(spark, sf_dir))


@query("f8_fit_metrics")
def f8_fit_metrics(spark, sf_dir):
    return EV.fit_metrics(EV.naive_in_sample(_history(spark, sf_dir)))


@query("f9_series_status")
def f9_series_status(spark, sf_dir):
    return EV.series_status(_history(spark, sf_dir), CFG.min_rows, CFG.horizon, REGRESSORS, listed=LISTED)


@query("a16_min_history")
def a16_min_history(spark, sf_dir):
    return EV.with_min_history(_history(spark, sf_dir), CFG.min_rows)


# --- billing ---------------------------------------------------------------------------

from cashcast.operators import billing as B  # noqa: E402


@memo
def _billing(spark, sf_dir):
    """(orders, items without item numbers, numbered documents)."""
    orders = X.billing_orders(spark, sf_dir)
    items = X.sales_order_items(spark, sf_dir, header=orders, numbered=False)
    docs = B.cancellation_pairs(B.billing_documents(orders, X.item_amounts(spark, sf_dir)), _document_numbers(spark, sf_dir))
    return orders, items, docs


@memo
def _eligible_keys(spark, sf_dir):
    return B.eligible_orders(X.order_keys(spark, sf_dir))


@memo
def _document_numbers(spark, sf_dir):
    return B.document_numbers(_eligible_keys(spark, sf_dir))


@memo
def _document_keys(spark, sf_dir):
    """Ids and types of the documents, for their items."""
    return B.document_keys(_eligible_keys(spark, sf_dir), _document_numbers(spark, sf_dir))


@memo
def _posting_keys(spark, sf_dir):
    """(OrderKey, PayerParty) of the orders with a cash posting: open F2, an item, a payer with a tier."""
    open_f2 = _eligible_keys(spark, sf_dir).filter(~F.col("is_cancelled"))
    payers = X.customers(spark, sf_dir).filter(F.col("Tier").isNotNull()).select(F.col("Customer").alias("SoldToParty"))
    return (open_f2.join(X.orders_with_items(spark, sf_dir), "OrderKey", "left_semi").join(payers, "SoldToParty", "left_semi")
            .select("OrderKey", F.col("SoldToParty").alias("PayerParty")))


@memo
def _items(spark, sf_dir):
    """Items with their item numbers (skew-safe numbering)."""
    return X.sales_order_items(spark, sf_dir, header=X.billing_orders(spark, sf_dir))


@query("w9_preferred_row")
def w9_preferred_row(spark, sf_dir):
    return X.preferred_sales_area(X.customer_sales_area(spark, sf_dir)).drop("CustKey")


@query("a11_header_totals")
def a11_header_totals(spark, sf_dir):
    orders = X.sales_orders(spark, sf_dir)
    items = X.sales_order_items(spark, sf_dir, header=orders, numbered=False)
    tot = items.groupBy("SalesOrder").agg(F.sum("NetAmount").alias("_net"))
    return (orders.select("SalesOrder", "SoldToParty", "TransactionCurrency").join(tot, "SalesOrder", "left")
            .select("SalesOrder", "SoldToParty", "TransactionCurrency",
                    F.col("_net").cast("double").alias("TotalNetAmount")))


@query("b1_eligible")
def b1_eligible(spark, sf_dir):
    return B.eligible_orders(X.sales_orders(spark, sf_dir)).select(
        "SalesOrder", "CreationDate", "OverallSDProcessStatus", "OverallSDDocumentRejectionSts")


@query("b2_documents")
def b2_documents(spark, sf_dir):
    _, _, docs = _billing(spark, sf_dir)
    return docs.filter(F.col("BillingDocumentType") == "F2").drop("OrderKey")


@query("b3_pairs")
def b3_pairs(spark, sf_dir):
    _, _, docs = _billing(spark, sf_dir)
    return docs.drop("OrderKey")


@query("b4_items")
def b4_items(spark, sf_dir):
    return B.billing_items(_document_keys(spark, sf_dir), _items(spark, sf_dir))


@query("b5_totals")
def b5_totals(spark, sf_dir):
    return B.document_totals(B.item_amounts(_document_keys(spark, sf_dir), X.item_amounts(spark, sf_dir)))


# --- cash ------------------------------------------------------------------------------

from cashcast.operators import cash as CS  # noqa: E402


def doubles(df: DataFrame) -> DataFrame:
    """Check projection: decimals as doubles (the stored tables keep their decimal types)."""
    return df.select([F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal"
                      else F.col(f.name) for f in df.schema.fields])


@memo
def _terms(spark, sf_dir):
    return _payer_terms(spark, sf_dir, _billing(spark, sf_dir)[2])


def _payer_terms(spark, sf_dir, docs):
    tiers = X.customers(spark, sf_dir).filter(F.col("Tier").isNotNull()).select("Customer", "Tier")
    return CS.payment_terms(docs, tiers, X.customer_dunning(spark, sf_dir))


@memo
def _postings(spark, sf_dir):
    """Numbered cash postings (CashFlowID assigned)."""
    return CS.cash_postings(X.cash_draws(_terms(spark, sf_dir)), numbers=CS.posting_numbers(_posting_keys(spark, sf_dir)))


@memo
def _cash_rows(spark, sf_dir):
    """Cash postings without ids, for consumers that only aggregate them."""
    return CS.cash_postings(X.cash_draws(_terms(spark, sf_dir)), numbered=False)


@memo
def _plain_cash(spark, sf_dir):
    """Cash rows built on the F2 documents before numbering: dates and amounts, no ids."""
    f2 = B.billing_documents(X.billing_orders(spark, sf_dir), X.item_amounts(spark, sf_dir))
    f2 = (f2.withColumn("TotalNetAmount", F.bround(F.col("_net"), 2).cast("double"))
          .withColumn("BillingDocument", F.lit(None).cast("string")))
    return CS.cash_postings(X.cash_draws(_payer_terms(spark, sf_dir, f2)), numbered=False)


@memo
def _index(spark, sf_dir):
    return CS.seasonal_index(_plain_cash(spark, sf_dir), *CFG.cash_years)


@query("j8_dunning_default")
def j8_dunning_default(spark, sf_dir):
    cust = X.customers(spark, sf_dir).select("Customer")
    lv = CS.dunning_levels(X.customer_dunning(spark, sf_dir))
    return cust.join(lv, "Customer", "left").select("Customer", F.coalesce("DunningLevel", F.lit(0)).alias("DunningLevel"))


@query("c1_payment_terms")
def c1_payment_terms(spark, sf_dir):
    return doubles(_terms(spark, sf_dir).select(
        "BillingDocument", "PayerParty", "Tier", "DunningLevel", "dso_mean", "adj_days", "mult", "rate_lo"))


@query("c2_posting_date")
def c2_posting_date(spark, sf_dir):
    t = X.cash_draws(_terms(spark, sf_dir))
    days, post = CS.posting_date(F.col("BillingDocumentDate"), F.col("base_dso"), F.col("adj_days"), F.col("noise"))
    return t.select("BillingDocument", "BillingDocumentDate", "base_dso", "adj_days", "noise",
                    days.alias("total_dso"), post.alias("PostingDate"))


@query("c3_collected_amount")
def c3_collected_amount(spark, sf_dir):
    t = X.cash_draws(_terms(spark, sf_dir))
    return doubles(t.select("BillingDocument", "base_rate", "mult",
                            CS.collected_amount(F.col("TotalNetAmount"), F.col("base_rate"), F.col("mult")).alias("amount")))


@query("c4_postings")
def c4_postings(spark, sf_dir):
    return doubles(_postings(spark, sf_dir))


@query("c5_seasonal_index")
def c5_seasonal_index(spark, sf_dir):
    return _index(spark, sf_dir).select(
        "iso_week", "mean_amount", F.round("seasonal_index", 6).alias("seasonal_index"), "n_skipped")


@query("c6_cash_forecast")
def c6_cash_forecast(spark, sf_dir):
    return doubles(CS.cash_forecast(_index(spark, sf_dir), CFG.cash_forecast_start, CFG.cash_forecast_months))


# --- weather and demand ----------------------------------------------------------------

from cashcast.operators import demand as D  # noqa: E402
from cashcast.operators import weather as W  # noqa: E402


def _r6(*cols):
    return [F.round(c, 6).alias(c) for c in cols]


@memo
def _baseline(spark, sf_dir):
    return W.fitted_baseline(X.weather(spark, sf_dir))


@query("h1_harmonic")
def h1_harmonic(spark, sf_dir):
    return W.fit_harmonic(X.weather(spark, sf_dir)).select("station_id", *_r6("a0", "a1", "b1"))


@query("h3_anomaly")
def h3_anomaly(spark, sf_dir):
    a = W.temperature_anomaly(_baseline(spark, sf_dir))
    return a.select("station_id", "year", "month", "step", *_r6("baseline_c", "anomaly_c"))


@query("h4_extreme_heat")
def h4_extreme_heat(spark, sf_dir):
    h = W.extreme_heat(_baseline(spark, sf_dir), CFG.heat_windows)
    return h.select("station_id", "year", "month", "extreme_heat_flag")


@query("d1_seasonal_weight")
def d1_seasonal_weight(spark, sf_dir):
    lines = X.order_lines(spark, sf_dir)
    d = F.col("SalesOrderDate")
    g = lines.groupBy(F.year(d).alias("year"), F.month(d).alias("month"), "MaterialGroup").agg(
        F.count(F.lit(1)).alias("lines"))
    return g.withColumn("seasonal_weight", F.round(D.seasonal_weight(F.col("month"), F.col("year"),
                                                                     F.col("MaterialGroup"), CFG.base_year), 6))


@query("d2_weather_mult")
def d2_weather_mult(spark, sf_dir):
    hist = _history(spark, sf_dir).select(F.col("week_start").alias("ds"), "Material", "MaterialGroup")
    f = attach_regressors(hist, _monthly(spark, sf_dir), fallback=CFG.fallback, order_extra=("MaterialGroup",))
    return f.select("ds", "Material", F.round(D.weather_multiplier(F.col("avg_temp_c"), F.col("temp_anomaly_c"),
                                                                   F.col("MaterialGroup")), 6).alias("weather_mult"))


@memo
def _features(spark, sf_dir):
    # the month's weather goes to the orders, and with them to the lines: one join of items and orders
    orders = D.weather_lookup(X.sales_orders(spark, sf_dir), X.weather(spark, sf_dir), few_places=True)
    items = X.sales_order_items(spark, sf_dir, header=orders, carry=("SalesOrderDate", "avg_temp_c", "temp_anomaly_c"))
    return D.demand_weather_features(items, CFG.base_year)


@query("d3_expected_qty")
def d3_expected_qty(spark, sf_dir):
    f = _features(spark, sf_dir)
    return f.select("SalesOrder", "SalesOrderItem", "OrderQuantity",
                    D.expected_quantity(F.col("OrderQuantity"), F.col("seasonal_weight"), F.col("weather_mult")).alias("expected_qty"))


@query("d7_features")
def d7_features(spark, sf_dir):
    f = _features(spark, sf_dir)
    return f.select("SalesOrder", "SalesOrderItem", "Material", "MaterialGroup",
                    *_r6("avg_temp_c", "temp_anomaly_c", "seasonal_weight", "weather_mult"))


@query("j10_weather_lookup")
def j10_weather_lookup(spark, sf_dir):
    orders = X.sales_orders(spark, sf_dir).select("SalesOrder", "SalesOrderDate", "Country", "Region")
    return D.weather_lookup(orders, X.weather(spark, sf_dir), few_places=True).select(
        "SalesOrder", "Country", "Region", *_r6("avg_temp_c", "temp_anomaly_c"))


@memo
def _priced(spark, sf_dir):
    orders = X.sales_orders(spark, sf_dir)
    li = X.read_table(spark, "lineitem", sf_dir).select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    p = X.read_table(spark, "part", sf_dir).select("p_partkey", "p_type", "p_retailprice")
    o = orders.select("OrderKey", "SalesOrderDate", "TransactionCurrency")
    j = li.join(p, li.l_partkey == p.p_partkey).join(o, li.l_orderkey == o.OrderKey)
    j = j.withColumns({"month": F.month("SalesOrderDate"), "MaterialGroup": X.material_group(F.col("p_type"))})
    return D.price_with_surge(j, "p_retailprice", "month", "MaterialGroup", "p_type")


@query("d4_price")
def d4_price(spark, sf_dir):
    return doubles(_priced(spark, sf_dir).groupBy("p_partkey", "month").agg(F.max("unit_price").alias("unit_price")))


@query("d5_amounts")
def d5_amounts(spark, sf_dir):
    pr = _priced(spark, sf_dir)
    net, tax = D.line_amounts(F.col("l_quantity"), F.col("unit_price"), F.col("TransactionCurrency"))
    return doubles(pr.groupBy(F.col("OrderKey").cast("string").alias("SalesOrder")).agg(
        F.sum(net).alias("net"), F.sum(tax).alias("tax")))


def _order_tables(spark, sf_dir, numbered: bool):
    orders = X.sales_orders(spark, sf_dir)
    lines = X.sales_order_items(spark, sf_dir, header=orders, numbered=numbered,
                                carry=("SalesOrderDate", "TransactionCurrency", "p_retailprice"))
    return D.order_tables(orders, lines if numbered else lines.withColumn("SalesOrderItem", F.lit(None).cast("string")))


@query("t_salesorder")
def t_salesorder(spark, sf_dir):
    return doubles(_order_tables(spark, sf_dir, numbered=False)[0])


@query("t_salesorderitem")
def t_salesorderitem(spark, sf_dir):
    return doubles(_order_tables(spark, sf_dir, numbered=True)[1])


@query("d6_phase_out")
def d6_phase_out(spark, sf_dir):
    lines = X.order_lines(spark, sf_dir)
    kept = D.phase_out_filter(lines, CFG.phased_out)
    a = lines.groupBy("Material").agg(F.count(F.lit(1)).alias("rows_in"))
    b = kept.groupBy("Material").agg(F.count(F.lit(1)).alias("rows_kept"))
    return a.join(b, "Material", "left").select("Material", "rows_in", F.coalesce("rows_kept", F.lit(0)).alias("rows_kept"))


@query("d8_requested")
def d8_requested(spark, sf_dir):
    j = X.sales_order_items(spark, sf_dir, header=X.sales_orders(spark, sf_dir), carry=("CreationDate",))
    factor = (F.lit(1.05).cast("decimal(6,2)") + (F.col("OrderKey") % 11) * F.lit(0.01).cast("decimal(6,2)"))
    return j.select("SalesOrder", "SalesOrderItem", "OrderQuantity",
                    D.requested_quantity(F.col("OrderQuantity"), factor).alias("requested_qty"),
                    D.requested_date(F.col("CreationDate"), F.col("OrderKey") % 17 + 5).alias("requested_date"))


# --- quality ---------------------------------------------------------------------------

from cashcast import config as C  # noqa: E402
from cashcast.operators import quality as Q  # noqa: E402

ALL_MATERIALS = [m for m, _ in C.MATERIAL_GROUPS]


@query("v_integrity")
def v_integrity(spark, sf_dir):
    orders, items, docs = _billing(spark, sf_dir)
    cash = _cash_rows(spark, sf_dir)
    return Q.integrity_report(orders, items, X.order_lines(spark, sf_dir), docs, cash, X.customers(spark, sf_dir),
                              X.weather(spark, sf_dir), ALL_MATERIALS, CFG.phased_out, CFG.heat_windows,
                              CFG.uplift_groups, CFG.uplift_years).withColumn("observed", F.round("observed", 6))


@query("v_cardinality")
def v_cardinality(spark, sf_dir):
    """Over written tables, as in the jobs: items and documents are made once, with what the checks read."""
    orders = X.billing_orders(spark, sf_dir)
    items = store(X.item_amounts(spark, sf_dir), "items")
    docs = store(B.cancellation_pairs(B.billing_documents(orders, items), _document_numbers(spark, sf_dir)).select(
        "OrderKey", "SalesOrder", "BillingDocument", "BillingDocumentType", "BillingDocumentIsCancelled", "CancelledBillingDocument",
        "BillingDocumentDate", "PayerParty", "TransactionCurrency", "TotalNetAmount", "TotalTaxAmount"), "documents")
    terms = _payer_terms(spark, sf_dir, docs)
    return Q.cardinality_report(X.order_keys(spark, sf_dir), items, docs, B.item_amounts(docs, items),
                                CS.cash_postings(X.cash_draws(terms), numbered=False), terms)


@query("v_targets")
def v_targets(spark, sf_dir):
    """Row counts against the volume targets, counted on the keys of the tables."""
    items = X.item_lines(spark, sf_dir)
    doc_items = _document_keys(spark, sf_dir).join(items, "OrderKey")
    fc = CS.cash_forecast(_index(spark, sf_dir), CFG.cash_forecast_start, CFG.cash_forecast_months)
    counts = Q.table_counts([
        ("weather", X.weather(spark, sf_dir)), ("salesorder", X.order_keys(spark, sf_dir)), ("salesorderitem", items),
        ("billingdocument", _document_keys(spark, sf_dir)), ("billingdocumentitem", doc_items),
        ("cashflow", _posting_keys(spark, sf_dir)), ("cashflowforecast", fc)])
    return Q.volume_report(counts, Q.volume_targets(spark))


@query("v_keys")
def v_keys(spark, sf_dir):
    orders, _, docs = _billing(spark, sf_dir)
    items = _items(spark, sf_dir)
    return Q.key_report([  # all seven tables
        ("billingdocument", docs, ["BillingDocument"]),
        ("billingdocumentitem", B.billing_items(docs, items), ["BillingDocument", "BillingDocumentItem"]),
        ("cashflow", _postings(spark, sf_dir), ["CashFlowID", "CshFlwValdtyStrtDteTmeVal"]),
        ("salesorderitem", items, ["SalesOrder", "SalesOrderItem"]),
        ("salesorder", orders, ["SalesOrder"]),
        ("cashflowforecast", CS.cash_forecast(_index(spark, sf_dir), CFG.cash_forecast_start, CFG.cash_forecast_months),
         ["CashFlowID", "CshFlwValdtyStrtDteTmeVal"]),
        ("weather", X.weather(spark, sf_dir), ["station_id", "year", "month"]),
    ])


@query("a12_tier_share")
def a12_tier_share(spark, sf_dir):
    return Q.revenue_share(X.sales_order_items(spark, sf_dir, numbered=False, carry=("Tier",)))


@query("a12_customer_share")
def a12_customer_share(spark, sf_dir):
    return Q.revenue_share(X.sales_order_items(spark, sf_dir, numbered=False), "SoldToParty")


@query("a13_funnel")
def a13_funnel(spark, sf_dir):
    docs = _eligible_keys(spark, sf_dir).withColumnRenamed("is_cancelled", "BillingDocumentIsCancelled")
    return Q.eligibility_funnel(X.order_keys(spark, sf_dir), docs, _posting_keys(spark, sf_dir))


@query("a14_heat_anomaly")
def a14_heat_anomaly(spark, sf_dir):
    return Q.heat_anomaly(X.weather(spark, sf_dir), CFG.heat_windows).withColumn("mean_anomaly", F.round("mean_anomaly", 6))


@query("a15_uplift")
def a15_uplift(spark, sf_dir):
    u = Q.period_uplift(X.order_lines(spark, sf_dir), CFG.uplift_groups, *CFG.uplift_years)
    return u.select(*_r6("mean_a", "mean_b", "uplift"))


@query("a18_month_volume")
def a18_month_volume(spark, sf_dir):
    return Q.month_volume(X.sales_orders(spark, sf_dir), CFG.base_year)


# --- model (no SQL twin: the driver records a rows-only check) ---------------------------

from cashcast.operators import forecast as FC  # noqa: E402


@memo
def _stored_history(spark, sf_dir):
    """The weekly history (one row per series and week), written once for queries that read it several times."""
    return store(_history(spark, sf_dir), "history")


@memo
def _model(spark, sf_dir):
    return FC.forecast_by_key(_stored_history(spark, sf_dir), _monthly(spark, sf_dir), CFG.horizon, CFG.fallback,
                              min_rows=CFG.min_rows)


def _scored(forecast: DataFrame, actual: DataFrame) -> DataFrame:
    """F8 of forecast weeks that have an actual."""
    j = EV.forecast_vs_actual(forecast, actual).filter(F.col("actual_qty").isNotNull() & F.col("predicted_qty").isNotNull())
    return EV.fit_metrics(j.select("Material", F.col("actual_qty").alias("y"), F.col("predicted_qty").alias("yhat")))


@query("f1_model_forecast")
def f1_model_forecast(spark, sf_dir):
    return FC.forecast_rows(_model(spark, sf_dir))


@query("f1_model_record")
def f1_model_record(spark, sf_dir):
    """The stored models' record of each run, and whether the forecasts scored from the stored
    coefficients by column expressions have the errors that the fit itself reported."""
    inp = store(FC.model_input(_stored_history(spark, sf_dir), _monthly(spark, sf_dir), CFG.horizon, CFG.fallback, min_rows=CFG.min_rows), "model_input")
    models = FC.fit_models(inp)
    rows = inp.filter("is_train").select("Material", "ds", "y", F.col("avg_temp_c_train").alias("avg_temp_c"),
                                         F.col("temp_anomaly_c_train").alias("temp_anomaly_c"))
    scored = EV.fit_metrics(FC.score(models, rows)).withColumnRenamed("mae", "_mae").withColumnRenamed("mape_pct", "_mape")
    same = (F.abs(F.col("_mae") - F.col("train_mae")) < 0.011) & (F.abs(F.col("_mape") - F.col("train_mape_pct")) < 0.011)
    return models.join(scored, "Material", "left").select(
        "Material", "training_rows", "training_end", F.size("trend").alias("n_trend"), F.size("season").alias("n_season"),
        F.size("reg_effect").alias("n_regressors"), F.coalesce(same, F.lit(False)).alias("scores_agree"))


@query("f1_band_widths")
def f1_band_widths(spark, sf_dir):
    """The band of the last forecast week is wider than that of the first."""
    fc = FC.forecast_rows(_model(spark, sf_dir))
    width = F.col("predicted_qty_upper") - F.col("predicted_qty_lower")
    ends = fc.groupBy("Material").agg(F.min_by(width, "SalesOrderDate").alias("first"), F.max_by(width, "SalesOrderDate").alias("last"),
                                      F.count(F.lit(1)).alias("weeks"))
    return ends.select("Material", "weeks", (F.col("last") >= F.col("first")).alias("wider"))


@query("f7_model_vs_actual")
def f7_model_vs_actual(spark, sf_dir):
    return EV.forecast_vs_actual(FC.forecast_rows(_model(spark, sf_dir)), _actuals(spark, sf_dir))


@query("f8_model_fit_metrics")
def f8_model_fit_metrics(spark, sf_dir):
    return EV.fit_metrics(FC.fit_rows(_model(spark, sf_dir)))


@query("f9_model_status")
def f9_model_status(spark, sf_dir):
    return EV.series_status(_stored_history(spark, sf_dir), CFG.min_rows, CFG.horizon, REGRESSORS,
                            fit_status=FC.fit_errors(_model(spark, sf_dir)), listed=LISTED)


@query("f1_forecast_keys")
def f1_forecast_keys(spark, sf_dir):
    """What the model's forecast must hold whatever its numbers: one row per series and future
    week, the point inside its band."""
    return FC.forecast_rows(_model(spark, sf_dir)).select(
        "SalesOrderDate", "Material", "MaterialGroup",
        F.col("predicted_qty").between(F.col("predicted_qty_lower"), F.col("predicted_qty_upper")).alias("in_band"))


@query("a9_forecast_summary")
def a9_forecast_summary(spark, sf_dir):
    """A9 of the model's forecast rows."""
    return H.run_summary(FC.forecast_rows(_model(spark, sf_dir)), "SalesOrderDate", "Material")


@query("f11_naive_metrics")
def f11_naive_metrics(spark, sf_dir):
    """The naive half of F11: errors of the year-over-year repeat on the test window."""
    return _scored(_naive_forecast_rows(spark, sf_dir), _actuals(spark, sf_dir))


@query("f11_skill")
def f11_skill(spark, sf_dir):
    """Model vs naive year-over-year on the test window (MAE and MAPE against actuals)."""
    actual = store(_actuals(spark, sf_dir), "actuals")
    naive = EV.naive_yoy_forecast(_stored_history(spark, sf_dir), CFG.horizon)
    return EV.skill_vs_naive(_scored(FC.forecast_rows(_model(spark, sf_dir)), actual), _scored(_naive_rows(naive), actual))


# --- profiles and listings -------------------------------------------------------------

@query("s7_table_profile")
def s7_table_profile(spark, sf_dir):
    """Row count and first three keys of each business table built from the test tables."""
    orders, _, docs = _billing(spark, sf_dir)
    items = _items(spark, sf_dir)
    tables = [("salesorder", orders, ["SalesOrder"]), ("salesorderitem", items, ["SalesOrder", "SalesOrderItem"]),
              ("billingdocument", docs, ["BillingDocument"]),
              ("billingdocumentitem", B.billing_items(docs, items), ["BillingDocument", "BillingDocumentItem"]),
              ("cashflow", _cash_rows(spark, sf_dir), ["BillingDocument"]),
              ("weather", X.weather(spark, sf_dir), ["station_id", "year", "month"])]
    parts = [table_profile(df, key).select(F.lit(n).alias("table_name"), "rows", "sample") for n, df, key in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("o5_sorted_keys")
def o5_sorted_keys(spark, sf_dir):
    return H.sorted_keys(_history(spark, sf_dir))


@query("o3_first_rows")
def o3_first_rows(spark, sf_dir):
    """O3: the first five history rows in (Material, week) order - the limit is the feature."""
    return _history(spark, sf_dir).orderBy("Material", "week_start").limit(5)


@query("w6_first_items")
def w6_first_items(spark, sf_dir):
    items = X.sales_order_items(spark, sf_dir, header=X.billing_orders(spark, sf_dir), first=2)
    return B.first_items(items, 2).select("SalesOrder", "SalesOrderItem", "Material", "OrderQuantity")


@query("x6_season")
def x6_season(spark, sf_dir):
    """Season of each weather month, with the station-months per season and year."""
    from cashcast.functions.calendar import season
    wx = X.weather(spark, sf_dir)
    return wx.groupBy("year", season("month").alias("season")).agg(F.count(F.lit(1)).alias("station_months"))


@query("f1_model_input")
def f1_model_input(spark, sf_dir):
    """F1's input: history (A16) + future weeks (U3, F2), regressors filled over the training
    rows and over training + future rows (F3 twice). SQL-checkable part of the model."""
    inp = FC.model_input(_history(spark, sf_dir), _monthly(spark, sf_dir), CFG.horizon, CFG.fallback,
                         min_rows=CFG.min_rows)
    cols = ["avg_temp_c_full", "temp_anomaly_c_full", "avg_temp_c_train", "temp_anomaly_c_train"]
    return inp.select("Material", "ds", "MaterialGroup", "y", "is_train", *_r6(*cols))
