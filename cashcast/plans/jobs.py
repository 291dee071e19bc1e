"""End-to-end jobs that write the business tables, one per pipeline stage:
billing documents and items, cash postings and cash forecast, and the forecast result.

Each job keeps the work on the executors from scan to write; the only driver-side
results are row counts of written tables and the outcome of the key checks. A table's
plan runs once: its rows are staged in the shared checkpoint folder, checked on the way
there (null and repeated keys) and written from there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from cashcast.config import DEFAULT, ForecastConfig
from cashcast.operators import billing as B
from cashcast.operators import cash as CS
from cashcast.operators import demand as D
from cashcast.operators import evaluate as EV
from cashcast.operators import forecast as FC
from cashcast.operators import history as H
from cashcast.session import release, store
from cashcast.sources import fixtures as X
from cashcast.sources.tables import ensure_schema, with_required, write_table

FORECAST_RESULT_COLUMNS = [
    "SalesOrderDate", "predicted_qty", "predicted_qty_lower", "predicted_qty_upper", "Material",
    "MaterialGroup", "actual_qty", "gap_actual_vs_forecast", "pct_error",
]


def _write(df: DataFrame, name: str, keys: list[str], fmt: str, root: str | None,
           bucket_by: tuple[int, list[str]] | None = None) -> int:
    """Stage ``df``, check its keys (V9, V10) and write it (S3, S6); returns the number of rows.

    The plan runs once: rows are dealt into ranges of their key, and while they are written
    Spark counts them, those with a null in the key, and the second row of every repeated key
    (equal keys stand together in a range). The final table is written from the staged one.
    """
    spark, seen = df.sparkSession, Observation()
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys], F.lit(False))
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys)) if keys else F.lit(1)  # a table without a key
    ranged = (df.repartitionByRange(*keys) if keys else df).withColumn("_nth", nth).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(missing).alias("nulls"), F.count_if(F.col("_nth") == 2).alias("repeated"))
    staged = store(ranged.drop("_nth"), "staged")
    found = seen.get
    failed = [f"{check} {name}: {found[c]}" for check, c in (("V9 null key", "nulls"), ("V10 duplicate key", "repeated")) if found[c]]
    if failed:
        raise ValueError("; ".join(failed))
    path = None if root is None else f"{root.rstrip('/')}/{name.replace('.', '/')}"
    write_table(with_required(staged, keys), name, fmt, path=path, bucket_by=bucket_by if root is None else None)
    release(staged)
    return found["rows"]


def order_job(spark: SparkSession, sf_dir: str, schema: str = "salesorder", fmt: str = "parquet",
              root: str | None = None, buckets: int = 8) -> dict[str, int]:
    """The full order and item tables. In the catalog both are bucketed and
    sorted by the order's key, so J1, J9 and J15 on them need no exchange."""
    if root is None:
        ensure_schema(spark, schema)
    orders = X.sales_orders(spark, sf_dir)
    lines = X.sales_order_items(spark, sf_dir, header=orders, carry=("SalesOrderDate", "TransactionCurrency", "p_retailprice"))
    headers, items = D.order_tables(orders, lines)
    by_order = (buckets, ["SalesOrder"])
    return {
        "salesorder": _write(headers, f"{schema}.salesorder", ["SalesOrder"], fmt, root, by_order),
        "salesorderitem": _write(items, f"{schema}.salesorderitem", ["SalesOrder", "SalesOrderItem"], fmt, root, by_order),
    }


def billing_job(spark: SparkSession, sf_dir: str, schema: str = "billingdocument", fmt: str = "parquet",
                root: str | None = None, buckets: int = 8) -> dict[str, int]:
    """Billing documents and their items, keys checked non-null on write (S6); in the
    catalog both are bucketed by document."""
    if root is None:
        ensure_schema(spark, schema)
    orders = X.billing_orders(spark, sf_dir)
    keys = B.eligible_orders(X.order_keys(spark, sf_dir))
    numbers = B.document_numbers(keys)
    docs = B.cancellation_pairs(B.billing_documents(orders, X.item_amounts(spark, sf_dir)), numbers)
    items = X.sales_order_items(spark, sf_dir, header=orders)
    out = {
        "billingdocument": _write(docs.select(*B.DOCUMENT_COLUMNS), f"{schema}.billingdocument",
                                  ["BillingDocument"], fmt, root, (buckets, ["BillingDocument"])),
        "billingdocumentitem": _write(B.billing_items(B.document_keys(keys, numbers), items), f"{schema}.billingdocumentitem",
                                      ["BillingDocument", "BillingDocumentItem"], fmt, root, (buckets, ["BillingDocument"])),
    }
    return out


def cash_job(spark: SparkSession, sf_dir: str, cfg: ForecastConfig = DEFAULT, schema: str = "cashflow",
             fmt: str = "parquet", root: str | None = None) -> dict[str, int]:
    """Cash postings from open billing documents, then the daily cash forecast."""
    if root is None:
        ensure_schema(spark, schema)
    orders = X.billing_orders(spark, sf_dir)
    numbers = B.document_numbers(B.eligible_orders(X.order_keys(spark, sf_dir)))
    docs = B.cancellation_pairs(B.billing_documents(orders, X.item_amounts(spark, sf_dir)), numbers)
    tiers = X.customers(spark, sf_dir).filter(F.col("Tier").isNotNull()).select("Customer", "Tier")
    terms = CS.payment_terms(docs, tiers, X.customer_dunning(spark, sf_dir))
    postings = CS.cash_postings(X.cash_draws(terms))
    n_cash = _write(postings, f"{schema}.cashflow", ["CashFlowID", "CshFlwValdtyStrtDteTmeVal"], fmt, root)
    stored = (spark.table(f"{schema}.cashflow") if root is None
              else spark.read.format(fmt).load(f"{root.rstrip('/')}/{schema}/cashflow"))
    index = CS.seasonal_index(stored, *cfg.cash_years)
    fc = CS.cash_forecast(index, cfg.cash_forecast_start, cfg.cash_forecast_months)
    n_fc = _write(fc, f"{schema}.cashflowforecast", ["CashFlowID", "CshFlwValdtyStrtDteTmeVal"], fmt, root)
    return {"cashflow": n_cash, "cashflowforecast": n_fc}


def forecast_job(spark: SparkSession, sf_dir: str, cfg: ForecastConfig = DEFAULT, schema: str = "forecasts",
                 fmt: str = "parquet", root: str | None = None) -> dict[str, int]:
    """F5 -> F4/F3 -> F1 -> F6 -> F7: one model per material, compared with weekly actuals,
    written ordered by material and week; the models' coefficients (with the run's record of
    each fit); the per-series status table (F9); and the lines whose date cannot be read (P2)."""
    if root is None:
        ensure_schema(spark, schema)
    lines, rejected = H.split_dates(X.order_lines(spark, sf_dir), "SalesOrderDate")
    history = store(H.weekly_history(H.daily_feature(lines), cfg.training_end, cfg.materials), "history")
    monthly = store(H.monthly_regressors(X.weather(spark, sf_dir), cfg.countries), "monthly")
    inp = FC.model_input(history, monthly, cfg.horizon, cfg.fallback, min_rows=cfg.min_rows)
    models = FC.fit_models(inp)
    scored = FC.forecast_by_key(history, monthly, cfg.horizon, cfg.fallback, min_rows=cfg.min_rows, models=models)
    orders = X.read_table(spark, "orders", sf_dir).select(
        F.col("o_orderkey").alias("OrderKey"), F.col("o_orderdate").alias("SalesOrderDate"))
    actuals = H.weekly_actuals(X.item_lines(spark, sf_dir), orders, cfg.training_end, cfg.materials, key="OrderKey")
    result = EV.forecast_vs_actual(FC.forecast_rows(scored), actuals).select(*FORECAST_RESULT_COLUMNS)
    status = EV.series_status(history, cfg.min_rows, cfg.horizon, "avg_temp_c, temp_anomaly_c",
                              fit_status=FC.fit_errors(scored), listed=cfg.materials)
    return {
        "forecast_salesorderquantity_material": _write(
            result, f"{schema}.forecast_salesorderquantity_material", ["Material", "SalesOrderDate"], fmt, root),
        "series_model": _write(models, f"{schema}.series_model", ["Material"], fmt, root),
        "series_status": _write(status, f"{schema}.series_status", ["Material"], fmt, root),
        "rejected_dates": _write(rejected, f"{schema}.rejected_dates", [], fmt, root),
    }
