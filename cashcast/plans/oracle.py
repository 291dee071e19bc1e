"""SQL twins of the registered queries (DuckDB dialect, ANSI where possible)."""

from __future__ import annotations

from cashcast.config import DEFAULT as CFG
from cashcast.operators.forecast import ModelSpec
from cashcast.plans.sql_fixtures import _LINE_ORDER, sql_case, sql_list, sql_with

ORACLE: dict[str, str] = {}

_MATS = sql_list(CFG.materials)
_END = f"TIMESTAMP '{CFG.training_end} 00:00:00'"

_EXTRA = {
    "feature": (["order_lines"], """
SELECT SalesOrderDate, Material, MaterialGroup, SUM(OrderQuantity) AS Sum_OrderQuantity
FROM order_lines GROUP BY SalesOrderDate, Material, MaterialGroup"""),
    "history": (["feature"], f"""
SELECT CAST(date_trunc('week', CAST(SalesOrderDate AS TIMESTAMP)) AS DATE) AS week_start, Material, MaterialGroup,
       CAST(COALESCE(SUM(Sum_OrderQuantity), 0) AS BIGINT) AS qty
FROM feature
WHERE CAST(SalesOrderDate AS TIMESTAMP) <= {_END} AND Material IN ({_MATS})
  AND Material IS NOT NULL AND MaterialGroup IS NOT NULL
GROUP BY 1, 2, 3"""),
    "regressors": (["weather"], f"""
SELECT make_date(year, month, 1) AS month_start,
       CAST(SUM(CAST(avg_temp_c AS DECIMAL(12,2))) AS DOUBLE) / CAST(COUNT(avg_temp_c) AS DOUBLE) AS avg_temp_c,
       CAST(SUM(CAST(temp_anomaly_c AS DECIMAL(12,2))) AS DOUBLE) / CAST(COUNT(temp_anomaly_c) AS DOUBLE) AS temp_anomaly_c
FROM weather WHERE country IN ({sql_list(CFG.countries)}) GROUP BY year, month"""),
}


def w(names, body):
    return sql_with(names, body, _EXTRA)


ORACLE["a17_daily_feature"] = w(["feature"], "SELECT SalesOrderDate, Material, MaterialGroup, CAST(Sum_OrderQuantity AS BIGINT) AS Sum_OrderQuantity FROM feature")

ORACLE["f5_weekly_history"] = w(["history"], "SELECT * FROM history")

ORACLE["f6_weekly_actuals"] = w(["order_lines"], f"""
SELECT CAST(date_trunc('week', CAST(o.o_orderdate AS TIMESTAMP)) AS DATE) AS SalesOrderDate, l.MaterialGroup, l.Material,
       CAST(SUM(l.OrderQuantity) AS BIGINT) AS actual_qty
FROM order_lines l JOIN orders o ON l.SalesOrder = CAST(o.o_orderkey AS VARCHAR)
WHERE CAST(o.o_orderdate AS TIMESTAMP) > {_END} AND l.Material IN ({_MATS})
GROUP BY 1, 2, 3""")

ORACLE["f4_monthly_regressors"] = w(["regressors"], """
SELECT month_start, round(avg_temp_c, 6) AS avg_temp_c, round(temp_anomaly_c, 6) AS temp_anomaly_c FROM regressors""")

ORACLE["a8_history_profile"] = w(["history"], """
SELECT Material, CAST(COUNT(qty) AS BIGINT) AS count, round_even(AVG(qty), 0) AS mean,
       round_even(STDDEV_SAMP(qty), 0) AS std, round_even(CAST(MIN(qty) AS DOUBLE), 0) AS min,
       round_even(quantile_cont(qty, 0.25), 0) AS p25, round_even(quantile_cont(qty, 0.5), 0) AS p50,
       round_even(quantile_cont(qty, 0.75), 0) AS p75, round_even(CAST(MAX(qty) AS DOUBLE), 0) AS max
FROM history GROUP BY Material""")

ORACLE["a9_run_summary"] = w(["history"], """
SELECT CAST(COUNT(*) AS BIGINT) AS rows, MIN(week_start) AS first_date, MAX(week_start) AS last_date,
       CAST(COUNT(DISTINCT Material) AS BIGINT) AS series,
       CAST(CASE WHEN COUNT(DISTINCT Material) > 0 THEN COUNT(*) // COUNT(DISTINCT Material) END AS BIGINT) AS rows_per_series
FROM history""")

ORACLE["a9_weather_summary"] = w(["weather"], """
SELECT CAST(COUNT(*) AS BIGINT) AS rows, MIN(make_date(year, month, 1)) AS first_date, MAX(make_date(year, month, 1)) AS last_date,
       CAST(COUNT(DISTINCT station_id) AS BIGINT) AS series,
       CAST(CASE WHEN COUNT(DISTINCT station_id) > 0 THEN COUNT(*) // COUNT(DISTINCT station_id) END AS BIGINT) AS rows_per_series
FROM weather""")

ORACLE["f12_split"] = w(["feature"], f"""
SELECT split, Material, CAST(COUNT(*) AS BIGINT) AS days, CAST(SUM(Sum_OrderQuantity) AS BIGINT) AS qty FROM (
  SELECT 'train' AS split, * FROM feature WHERE SalesOrderDate <= DATE '{CFG.training_end}'
  UNION ALL
  SELECT 'test' AS split, * FROM feature WHERE SalesOrderDate > DATE '{CFG.training_end}' AND SalesOrderDate <= DATE '{CFG.test_end}'
) x GROUP BY split, Material""")


# --- regressors, spine, naive forecast, evaluation -------------------------------------

_EXTRA.update({
    "heads": (["history"], """
SELECT Material, MAX(week_start) AS last_week, COUNT(*) AS training_rows,
       first(MaterialGroup ORDER BY week_start, MaterialGroup) AS MaterialGroup
FROM history GROUP BY Material"""),
    "future": (["heads"], f"""
SELECT h.Material, h.MaterialGroup, h.last_week + CAST(7 * t.k AS INTEGER) AS ds
FROM heads h CROSS JOIN range(1, {CFG.horizon + 1}) t(k)"""),
    "weekly": (["history"], "SELECT Material, week_start, SUM(qty) AS qty FROM history GROUP BY Material, week_start"),
    "naive": (["future", "weekly"], """
SELECT f.Material, f.MaterialGroup, f.ds, CAST(h.qty AS DOUBLE) AS predicted_qty
FROM future f LEFT JOIN weekly h ON h.Material = f.Material AND h.week_start = f.ds - 364"""),
    "actuals": (["order_lines"], f"""
SELECT CAST(date_trunc('week', CAST(o.o_orderdate AS TIMESTAMP)) AS DATE) AS SalesOrderDate, l.MaterialGroup, l.Material,
       CAST(SUM(l.OrderQuantity) AS BIGINT) AS actual_qty
FROM order_lines l JOIN orders o ON l.SalesOrder = CAST(o.o_orderkey AS VARCHAR)
WHERE CAST(o.o_orderdate AS TIMESTAMP) > {_END} AND l.Material IN ({_MATS})
GROUP BY 1, 2, 3"""),
    "insample": (["weekly"], """
SELECT c.Material, c.week_start AS ds, CAST(c.qty AS DOUBLE) AS y, CAST(p.qty AS DOUBLE) AS yhat
FROM weekly c JOIN weekly p ON p.Material = c.Material AND p.week_start = c.week_start - 364"""),
})

ORACLE["f3_regressor_fill"] = w(["history", "regressors"], f"""
SELECT ds, Material,
       round(COALESCE(last_value(t IGNORE NULLS) OVER fwd, first_value(t IGNORE NULLS) OVER bwd, {CFG.fallback[0]}), 6) AS avg_temp_c,
       round(COALESCE(last_value(a IGNORE NULLS) OVER fwd, first_value(a IGNORE NULLS) OVER bwd, {CFG.fallback[1]}), 6) AS temp_anomaly_c
FROM (SELECT h.week_start AS ds, h.Material, h.MaterialGroup, r.avg_temp_c AS t, r.temp_anomaly_c AS a
      FROM history h LEFT JOIN regressors r ON CAST(date_trunc('month', h.week_start) AS DATE) = r.month_start) x
WINDOW fwd AS (PARTITION BY Material ORDER BY ds, MaterialGroup ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       bwd AS (PARTITION BY Material ORDER BY ds, MaterialGroup ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""")

ORACLE["f2_future_weeks"] = w(["future"], "SELECT Material, MaterialGroup, ds FROM future")

ORACLE["f10_naive_yoy"] = w(["naive"], "SELECT * FROM naive")

ORACLE["f7_forecast_vs_actual"] = w(["naive", "actuals"], """
SELECT f.ds AS SalesOrderDate, f.Material, f.MaterialGroup, f.predicted_qty,
       CAST(NULL AS DOUBLE) AS predicted_qty_lower, CAST(NULL AS DOUBLE) AS predicted_qty_upper,
       CAST(a.actual_qty AS DOUBLE) AS actual_qty, a.actual_qty - f.predicted_qty AS gap_actual_vs_forecast,
       CASE WHEN a.actual_qty IS NOT NULL
            THEN round(abs(a.actual_qty - f.predicted_qty) / NULLIF(CAST(a.actual_qty AS DOUBLE), 0) * 100, 2) END AS pct_error
FROM naive f LEFT JOIN actuals a
  ON a.SalesOrderDate = f.ds AND a.Material = f.Material AND a.MaterialGroup = f.MaterialGroup
ORDER BY f.Material, f.ds""")

ORACLE["f8_fit_metrics"] = w(["insample"], """
SELECT Material, CAST(COUNT(*) AS BIGINT) AS n, round(AVG(abs(y - yhat)), 2) AS mae,
       round(AVG(abs(y - yhat) / greatest(y, 1.0)) * 100, 2) AS mape_pct
FROM insample GROUP BY Material""")

ORACLE["f9_series_status"] = w(["history"], f"""
SELECT m.Material, CAST(COUNT(h.week_start) AS BIGINT) AS training_rows, MAX(week_start) AS training_end,
       CASE WHEN COUNT(h.week_start) < {CFG.min_rows} THEN 'skipped' ELSE 'ok' END AS status,
       CASE WHEN COUNT(h.week_start) < {CFG.min_rows} THEN printf('only %d rows', COUNT(h.week_start)) END AS reason,
       {CFG.horizon} AS forecast_horizon_weeks, 'multiplicative' AS seasonality_mode,
       'avg_temp_c, temp_anomaly_c' AS weather_regressors
FROM (SELECT unnest([{_MATS}, 'UNLISTED']) AS Material) m LEFT JOIN history h ON h.Material = m.Material GROUP BY m.Material""")
# the fits all succeed, so the model's status table is the same
ORACLE["f9_model_status"] = ORACLE["f9_series_status"]

ORACLE["f1_forecast_keys"] = w(["future", "heads"], f"""
SELECT f.ds AS SalesOrderDate, f.Material, f.MaterialGroup, true AS in_band
FROM future f JOIN heads h ON h.Material = f.Material WHERE h.training_rows >= {CFG.min_rows}""")

ORACLE["f1_model_record"] = w(["history"], f"""
SELECT Material, CAST(COUNT(*) AS BIGINT) AS training_rows, MAX(week_start) AS training_end, 2 AS n_trend,
       {2 * ModelSpec().fourier_order} AS n_season, 2 AS n_regressors, true AS scores_agree
FROM history GROUP BY Material HAVING COUNT(*) >= {CFG.min_rows}""")

ORACLE["f1_band_widths"] = w(["history"], f"""
SELECT Material, CAST({CFG.horizon} AS BIGINT) AS weeks, true AS wider FROM history GROUP BY Material HAVING COUNT(*) >= {CFG.min_rows}""")

ORACLE["a9_forecast_summary"] = w(["future", "heads"], f"""
SELECT CAST(COUNT(*) AS BIGINT) AS rows, MIN(f.ds) AS first_date, MAX(f.ds) AS last_date, CAST(COUNT(DISTINCT f.Material) AS BIGINT) AS series,
       CAST(CASE WHEN COUNT(DISTINCT f.Material) > 0 THEN COUNT(*) // COUNT(DISTINCT f.Material) END AS BIGINT) AS rows_per_series
FROM future f JOIN heads h ON h.Material = f.Material WHERE h.training_rows >= {CFG.min_rows}""")

ORACLE["f11_naive_metrics"] = w(["naive", "actuals"], """
SELECT f.Material, CAST(COUNT(*) AS BIGINT) AS n, round(AVG(abs(a.actual_qty - f.predicted_qty)), 2) AS mae,
       round(AVG(abs(a.actual_qty - f.predicted_qty) / greatest(CAST(a.actual_qty AS DOUBLE), 1.0)) * 100, 2) AS mape_pct
FROM naive f JOIN actuals a ON a.SalesOrderDate = f.ds AND a.Material = f.Material AND a.MaterialGroup = f.MaterialGroup
WHERE f.predicted_qty IS NOT NULL GROUP BY f.Material""")

ORACLE["a16_min_history"] = w(["history"], f"""
SELECT * FROM history WHERE Material IN (SELECT Material FROM history GROUP BY Material HAVING COUNT(*) >= {CFG.min_rows})""")


# --- billing ---------------------------------------------------------------------------

_EXTRA.update({
    "item_tot": (["sales_order_items"], """
SELECT SalesOrder, MIN(PayerParty) AS _payer, SUM(NetAmount) AS _net, SUM(TaxAmount) AS _tax
FROM sales_order_items GROUP BY SalesOrder"""),
    "f2": (["billing_orders", "item_tot"], """
SELECT o.OrderKey, o.SalesOrder, CAST(o.CreationDate + o.lag_days AS DATE) AS bill, o.SalesOrganization,
       COALESCE(t._net, 0) AS _net, COALESCE(t._tax, 0) AS _tax, o.TransactionCurrency, o.CustomerPaymentTerms,
       t._payer AS PayerParty, o.SoldToParty, o.IncotermsClassification, o.PaymentMethod, o.is_cancelled
FROM billing_orders o LEFT JOIN item_tot t ON o.SalesOrder = t.SalesOrder
WHERE o.OverallSDProcessStatus IN ('B', 'C') AND o.OverallSDDocumentRejectionSts <> 'C'"""),
    "docs": (["f2"], """
SELECT f2.*, v.s1, row_number() OVER (ORDER BY f2.OrderKey, v.s1) AS rn
FROM f2 JOIN (SELECT 0 AS s1 UNION ALL SELECT 1 AS s1) v ON v.s1 = 0 OR f2.is_cancelled"""),
    "billing_documents": (["docs"], """
SELECT printf('BD-%06d', rn) AS BillingDocument,
       CASE WHEN s1 = 1 THEN 'S1' ELSE 'F2' END AS BillingDocumentType,
       'M' AS BillingDocumentCategory, bill AS CreationDate, bill AS BillingDocumentDate, SalesOrganization,
       CAST(_net * CASE WHEN s1 = 1 THEN -1 ELSE 1 END AS DOUBLE) AS TotalNetAmount,
       CAST(_tax * CASE WHEN s1 = 1 THEN -1 ELSE 1 END AS DOUBLE) AS TotalTaxAmount,
       TransactionCurrency, CustomerPaymentTerms, PayerParty, SoldToParty, 'CC01' AS CompanyCode,
       IncotermsClassification, PaymentMethod,
       CASE WHEN s1 = 1 THEN false ELSE is_cancelled END AS BillingDocumentIsCancelled,
       CASE WHEN s1 = 1 THEN printf('BD-%06d', rn - 1) END AS CancelledBillingDocument,
       CASE WHEN s1 = 1 THEN 'C' WHEN is_cancelled THEN 'A' ELSE 'C' END AS AccountingPostingStatus,
       CAST(year(bill) AS VARCHAR) AS FiscalYear, lpad(CAST(month(bill) AS VARCHAR), 2, '0') AS FiscalPeriod,
       SalesOrder
FROM docs"""),
    "billing_items": (["billing_documents", "sales_order_items"], """
SELECT d.BillingDocument, i.SalesOrderItem AS BillingDocumentItem, i.Material, i.Product, i.Plant, i.MaterialGroup,
       i.ProductHierarchyNode, CAST(i.NetAmount * d.sg AS DOUBLE) AS NetAmount,
       CAST(i.NetAmount * d.sg + i.TaxAmount * d.sg AS DOUBLE) AS GrossAmount,
       CAST(i.TaxAmount * d.sg AS DOUBLE) AS TaxAmount, CAST(i.NetAmount * d.sg AS DOUBLE) AS EligibleAmountForCashDiscount,
       i.SalesOrderItemCategory AS SalesDocumentItemCategory, i.SalesOrganization
FROM (SELECT BillingDocument, SalesOrder, CASE WHEN BillingDocumentType = 'S1' THEN -1 ELSE 1 END AS sg
      FROM billing_documents) d JOIN sales_order_items i ON d.SalesOrder = i.SalesOrder"""),
})

ORACLE["w9_preferred_row"] = w(["preferred_area"], "SELECT * EXCLUDE (CustKey) FROM preferred_area")

ORACLE["a11_header_totals"] = w(["sales_orders", "sales_order_items"], """
SELECT o.SalesOrder, o.SoldToParty, o.TransactionCurrency, CAST(t.net AS DOUBLE) AS TotalNetAmount
FROM sales_orders o LEFT JOIN (SELECT SalesOrder, SUM(NetAmount) AS net FROM sales_order_items GROUP BY SalesOrder) t
  ON o.SalesOrder = t.SalesOrder""")

ORACLE["b1_eligible"] = w(["sales_orders"], """
SELECT SalesOrder, CreationDate, OverallSDProcessStatus, OverallSDDocumentRejectionSts FROM sales_orders
WHERE OverallSDProcessStatus IN ('B', 'C') AND OverallSDDocumentRejectionSts <> 'C'""")

ORACLE["b2_documents"] = w(["billing_documents"], "SELECT * FROM billing_documents WHERE BillingDocumentType = 'F2'")
ORACLE["b3_pairs"] = w(["billing_documents"], "SELECT * FROM billing_documents")
ORACLE["b4_items"] = w(["billing_items"], "SELECT * FROM billing_items")
ORACLE["b5_totals"] = w(["billing_items"], """
SELECT BillingDocument, CAST(round(SUM(CAST(NetAmount AS DECIMAL(16,2))), 2) AS DOUBLE) AS TotalNetAmount,
       CAST(round(SUM(CAST(TaxAmount AS DECIMAL(16,2))), 2) AS DOUBLE) AS TotalTaxAmount
FROM billing_items GROUP BY BillingDocument""")


# --- cash ------------------------------------------------------------------------------

from cashcast import config as _C  # noqa: E402

_TERMS = ", ".join(f"('{t}', {m}, {s}, CAST({lo:.2f} AS DECIMAL(5,2)), CAST({hi:.2f} AS DECIMAL(5,2)))"
                   for t, m, s, lo, hi in _C.TIER_TERMS)
_DUN = ", ".join(f"({lv}, {d}, CAST({m:.2f} AS DECIMAL(5,2)))" for lv, d, m in _C.DUNNING_TERMS)
_FX = ", ".join(f"('{c}', CAST({r} AS DECIMAL(10,4)))" for c, r in _C.FX_RATES)
_KEY = "CAST(SalesOrder AS BIGINT)"

_EXTRA.update({
    "tiers": (["customers"], "SELECT Customer, Tier FROM customers WHERE Tier IS NOT NULL"),
    "terms_dim": ([], f"SELECT * FROM (VALUES {_TERMS}) t(Tier, dso_mean, dso_std, rate_lo, rate_hi)"),
    "dunning_dim": ([], f"SELECT * FROM (VALUES {_DUN}) t(DunningLevel, adj_days, mult)"),
    "fx_dim": ([], f"SELECT * FROM (VALUES {_FX}) t(TransactionCurrency, fx_rate)"),
    "dun": (["customer_dunning"], "SELECT Customer, MAX(DunningLevel) AS DunningLevel FROM customer_dunning GROUP BY Customer"),
    "pay_terms": (["billing_documents", "tiers", "dun", "terms_dim", "dunning_dim"], """
SELECT d.*, t.Tier, COALESCE(dn.DunningLevel, 0) AS DunningLevel, tm.dso_mean, tm.rate_lo,
       COALESCE(dd.adj_days, 0) AS adj_days, COALESCE(dd.mult, CAST(1 AS DECIMAL(5,2))) AS mult
FROM billing_documents d JOIN tiers t ON d.PayerParty = t.Customer
LEFT JOIN dun dn ON d.PayerParty = dn.Customer
JOIN terms_dim tm ON tm.Tier = t.Tier
LEFT JOIN dunning_dim dd ON dd.DunningLevel = COALESCE(dn.DunningLevel, 0)
WHERE d.BillingDocumentIsCancelled = false AND d.BillingDocumentType = 'F2'"""),
    "cash_rows": (["pay_terms"], f"""
SELECT p.*, {_KEY} AS OrderKey, CAST(dso_mean + {_KEY} % 11 - 5 AS INTEGER) AS base_dso,
       CAST({_KEY} % 7 - 3 AS INTEGER) AS noise,
       CAST(rate_lo + ({_KEY} % 4) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(5,2)) AS base_rate
FROM pay_terms p"""),
    "cash_calc": (["cash_rows"], """
SELECT *, CAST(greatest(1, least(greatest(1, base_dso) + adj_days + noise, 180)) AS INTEGER) AS total_dso,
       CAST(round_even(CAST(TotalNetAmount AS DECIMAL(20,2)) * base_rate * mult, 4) AS DECIMAL(34,4)) AS amount
FROM cash_rows"""),
    "cash_postings": (["cash_calc", "fx_dim"], """
SELECT printf('CF-%06d', row_number() OVER (ORDER BY a.OrderKey, a.BillingDocument)) AS CashFlowID,
       CAST(CAST((a.BillingDocumentDate + a.total_dso) - DATE '1970-01-01' AS BIGINT) * 86400 AS DECIMAL(21,7)) AS CshFlwValdtyStrtDteTmeVal,
       'CC01' AS CompanyCode, a.BillingDocumentDate + a.total_dso AS TransactionDate,
       a.BillingDocumentDate + a.total_dso AS PostingDate, a.TransactionCurrency,
       a.amount AS AmountInTransactionCurrency, 'EUR' AS CompanyCodeCurrency,
       CAST(round_even(a.amount * fx.fx_rate, 4) AS DECIMAL(34,4)) AS AmountInCompanyCodeCurrency,
       'EUR' AS GlobalCurrency,
       CAST(round_even(a.amount * fx.fx_rate, 4) AS DECIMAL(34,4)) AS AmountInGlobalCurrency,
       CASE WHEN a.TransactionCurrency = 'EUR' THEN 'BANK001' ELSE 'BANK002' END AS BankAccountInternalID,
       a.BillingDocument
FROM cash_calc a LEFT JOIN fx_dim fx ON a.TransactionCurrency = fx.TransactionCurrency"""),
    "seasonal": (["cash_postings"], f"""
SELECT *, CASE WHEN overall_mean <> 0 THEN mean_amount / overall_mean ELSE 1.0 END AS seasonal_index FROM (
  SELECT *, AVG(mean_amount) OVER () AS overall_mean FROM (
    SELECT CAST(weekofyear(PostingDate) AS INTEGER) AS iso_week, CAST(SUM(AmountInCompanyCodeCurrency) AS DOUBLE) / CAST(COUNT(AmountInCompanyCodeCurrency) AS DOUBLE) AS mean_amount,
           COUNT(*) - COUNT(AmountInCompanyCodeCurrency) AS n_skipped
    FROM cash_postings WHERE year(PostingDate) BETWEEN {CFG.cash_years[0]} AND {CFG.cash_years[1]}
    GROUP BY 1) w) x"""),
})


def _dbl(cols):
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)


ORACLE["j8_dunning_default"] = w(["customers", "dun"], """
SELECT c.Customer, COALESCE(d.DunningLevel, 0) AS DunningLevel FROM customers c LEFT JOIN dun d ON c.Customer = d.Customer""")

ORACLE["c1_payment_terms"] = w(["pay_terms"], f"""
SELECT BillingDocument, PayerParty, Tier, DunningLevel, dso_mean, adj_days, {_dbl(['mult', 'rate_lo'])} FROM pay_terms""")

ORACLE["c2_posting_date"] = w(["cash_calc"], """
SELECT BillingDocument, BillingDocumentDate, base_dso, adj_days, noise, total_dso,
       BillingDocumentDate + total_dso AS PostingDate FROM cash_calc""")

ORACLE["c3_collected_amount"] = w(["cash_calc"], f"SELECT BillingDocument, {_dbl(['base_rate', 'mult', 'amount'])} FROM cash_calc")

ORACLE["c4_postings"] = w(["cash_postings"], f"""
SELECT CashFlowID, {_dbl(['CshFlwValdtyStrtDteTmeVal'])}, CompanyCode, TransactionDate, PostingDate, TransactionCurrency,
       {_dbl(['AmountInTransactionCurrency'])}, CompanyCodeCurrency, {_dbl(['AmountInCompanyCodeCurrency'])},
       GlobalCurrency, {_dbl(['AmountInGlobalCurrency'])}, BankAccountInternalID, BillingDocument
FROM cash_postings""")

ORACLE["c5_seasonal_index"] = w(["seasonal"], "SELECT iso_week, mean_amount, round(seasonal_index, 6) AS seasonal_index, n_skipped FROM seasonal")

_FC_START = f"DATE '{CFG.cash_forecast_start}'"
ORACLE["c6_cash_forecast"] = w(["seasonal"], f"""
SELECT printf('FCF-%06d', CAST(d - {_FC_START} AS BIGINT) + 1) AS CashFlowID,
       CAST(CAST(d - DATE '1970-01-01' AS BIGINT) * 86400 AS DOUBLE) AS CshFlwValdtyStrtDteTmeVal,
       'CC01' AS CompanyCode, d AS TransactionDate, d AS PostingDate, 'EUR' AS TransactionCurrency,
       v AS AmountInTransactionCurrency, 'EUR' AS CompanyCodeCurrency, v AS AmountInCompanyCodeCurrency,
       'EUR' AS GlobalCurrency, v AS AmountInGlobalCurrency
FROM (
  SELECT s.d, CAST(CAST(round_even(COALESCE(s.overall_mean, 0.0) / 7 * COALESCE(x.seasonal_index, 1.0)
                                   * {_C.CASH_GROWTH} * 1.0, 4) AS DECIMAL(34,4)) AS DOUBLE) AS v
  FROM (SELECT (SELECT MAX(overall_mean) FROM seasonal) AS overall_mean,
               CAST(unnest(generate_series({_FC_START}, CAST({_FC_START} + INTERVAL {CFG.cash_forecast_months} MONTH AS DATE) - 1,
                                           INTERVAL 1 DAY)) AS DATE) AS d) s
  LEFT JOIN seasonal x ON x.iso_week = weekofyear(s.d)) y""")


# --- weather and demand ----------------------------------------------------------------

def _d(x) -> str:
    return f"CAST({x} AS DOUBLE)"


def _seasonal_sql(m: str, y: str, g: str, base_year: int) -> str:
    off = _d(0.0)
    for months, o in _C.SEASONAL_OFFSETS:
        off = f"({off} + CASE WHEN {m} IN ({', '.join(map(str, months))}) THEN {_d(o)} ELSE {_d(0.0)} END)"
    off = f"CASE WHEN {g} IN ('L001', 'L004') THEN {off} ELSE {_d(0.0)} END"
    swing = "CASE " + " ".join(f"WHEN {g} = '{k}' THEN {_d(v)}" for k, v in _C.GROUP_SWING) + f" ELSE {_d(1.0)} END"
    return f"(({_d(1.0)} + {off} * {swing}) * ({_d(1.0)} + {_d(_C.YOY_GROWTH)} * ({y} - {base_year})))"


def _weather_mult_sql(t: str, a: str, g: str) -> str:
    ramp = (f"CASE WHEN {t} > {_d(_C.HEAT_RAMP_START_C)} THEN {_d(_C.HEAT_RAMP_MAX)} * "
            f"least(({t} - {_d(_C.HEAT_RAMP_START_C)}) / {_d(_C.HEAT_RAMP_WIDTH_C)}, {_d(1.0)}) ELSE {_d(0.0)} END")
    hot = f"CASE WHEN {t} > {_d(_C.HOT_THRESHOLD_C)} THEN {_d(_C.HOT_BONUS)} ELSE {_d(0.0)} END"
    mult = (f"least((({_d(1.0)} + {ramp}) + {hot}) + {_d(_C.ANOMALY_BONUS)} * greatest({_d(0.0)}, {a}), "
            f"{_d(_C.WEATHER_CAP)})")
    return (f"CASE WHEN {g} = 'P001' THEN {_d(1.0)} + ({mult} - {_d(1.0)}) * {_d(_C.P001_WEATHER_SHARE)} "
            f"ELSE {mult} END")


def _det3_sql(a, b, c, d, e, f, g, h, i) -> str:
    return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"


_TH = f"{_d(2.0)} * pi() * (CAST(month AS DOUBLE) - {_d(1.0)}) / {_d(12.0)}"
_DET = _det3_sql("n", "sc", "ss", "sc", "scc", "scs", "ss", "scs", "sss")
_OK = f"abs({_DET}) > {_d(1e-9)} * greatest({_d(1.0)}, n * n * n)"
_TH7 = f"{_d(2.0)} * pi() * ({_d(7)} - {_d(1.0)}) / {_d(12.0)}"

_heat = " OR ".join(
    f"(country = '{cty}' AND month IN ({', '.join(map(str, ms))}) AND year IN ({', '.join(map(str, ys))}))"
    for cty, ms, ys in CFG.heat_windows) or "false"

_EXTRA.update({
    "harm": (["weather"], f"""
SELECT station_id,
       CASE WHEN {_OK} THEN {_det3_sql('sv', 'sc', 'ss', 'svc', 'scc', 'scs', 'svs', 'scs', 'sss')} / {_DET} END AS a0,
       CASE WHEN {_OK} THEN {_det3_sql('n', 'sv', 'ss', 'sc', 'svc', 'scs', 'ss', 'svs', 'sss')} / {_DET} END AS a1,
       CASE WHEN {_OK} THEN {_det3_sql('n', 'sc', 'sv', 'sc', 'scc', 'svc', 'ss', 'scs', 'svs')} / {_DET} END AS b1
FROM (SELECT station_id, CAST(COUNT(*) AS DOUBLE) AS n, SUM(cos(th)) AS sc, SUM(sin(th)) AS ss,
             SUM(cos(th) * cos(th)) AS scc, SUM(cos(th) * sin(th)) AS scs, SUM(sin(th) * sin(th)) AS sss,
             SUM(v) AS sv, SUM(v * cos(th)) AS svc, SUM(v * sin(th)) AS svs
      FROM (SELECT station_id, {_TH} AS th, CAST(avg_temp_c AS DOUBLE) AS v FROM weather WHERE avg_temp_c IS NOT NULL) x
      GROUP BY station_id) s"""),
    "wbase": (["weather", "harm"], f"""
SELECT w.*, h.a0 + h.a1 * cos({_TH.replace('month', 'w.month')}) + h.b1 * sin({_TH.replace('month', 'w.month')}) AS baseline_c,
       h.a0 + h.a1 * cos({_TH7}) + h.b1 * sin({_TH7}) AS july_baseline_c
FROM weather w LEFT JOIN harm h ON w.station_id = h.station_id"""),
    "features": (["sales_orders", "sales_order_items", "weather"], f"""
SELECT i.SalesOrder, i.SalesOrderItem, i.Material, i.MaterialGroup, i.OrderQuantity,
       COALESCE(w.avg_temp_c, {_d(CFG.fallback[0])}) AS avg_temp_c,
       COALESCE(w.temp_anomaly_c, {_d(CFG.fallback[1])}) AS temp_anomaly_c,
       {_seasonal_sql('month(o.SalesOrderDate)', 'year(o.SalesOrderDate)', 'i.MaterialGroup', CFG.base_year)} AS seasonal_weight,
       {_weather_mult_sql(f"COALESCE(w.avg_temp_c, {_d(CFG.fallback[0])})", f"COALESCE(w.temp_anomaly_c, {_d(CFG.fallback[1])})", 'i.MaterialGroup')} AS weather_mult
FROM sales_order_items i JOIN sales_orders o ON i.SalesOrder = o.SalesOrder
LEFT JOIN weather w ON o.Country = w.country AND o.Region = w.region
     AND year(o.SalesOrderDate) = w.year AND month(o.SalesOrderDate) = w.month"""),
    "priced": (["sales_orders"], f"""
SELECT l.l_orderkey AS OrderKey, l.l_quantity, p.p_partkey, month(o.SalesOrderDate) AS month, o.TransactionCurrency,
       CAST(CAST(p.p_retailprice AS DECIMAL(15,2))
            * CASE WHEN month(o.SalesOrderDate) IN ({', '.join(map(str, _C.SUMMER_MONTHS))})
                    AND {sql_case('p.p_type', _C.MATERIAL_GROUPS)} <> 'P001'
                   THEN CAST({_C.SUMMER_SURGE} AS DECIMAL(4,2)) ELSE CAST(1 AS DECIMAL(4,2)) END
            * CASE WHEN month(o.SalesOrderDate) IN ({', '.join(map(str, _C.SURGE_MONTHS))}) AND s.surge_rate IS NOT NULL
                   THEN CAST(1 AS DECIMAL(4,2)) + s.surge_rate ELSE CAST(1 AS DECIMAL(4,2)) END AS DECIMAL(24,6)) AS unit_price
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN sales_orders o ON l.l_orderkey = o.OrderKey
LEFT JOIN (SELECT * FROM (VALUES {', '.join(f"('{k}', CAST({r} AS DECIMAL(4,2)))" for k, r in _C.SURGE_SKUS)}) t(sku, surge_rate)) s
  ON p.p_type = s.sku"""),
})

ORACLE["h1_harmonic"] = w(["harm"], "SELECT station_id, round(a0, 6) AS a0, round(a1, 6) AS a1, round(b1, 6) AS b1 FROM harm")

ORACLE["h3_anomaly"] = w(["wbase"], f"""
SELECT station_id, year, month, step, round(baseline_c, 6) AS baseline_c,
       round(avg_temp_c - baseline_c - {_d(_C.WARMING_TREND_PER_MONTH)} * step, 6) AS anomaly_c
FROM (SELECT *, (year * 12 + month - 1) - MIN(year * 12 + month - 1) OVER (PARTITION BY station_id) AS step FROM wbase) x""")

ORACLE["h4_extreme_heat"] = w(["wbase"], f"""
SELECT station_id, year, month,
       ({_heat}) AND COALESCE(avg_temp_c > july_baseline_c + {_d(_C.EXTREME_HEAT_MARGIN_C)}, false) AS extreme_heat_flag
FROM wbase""")

ORACLE["d1_seasonal_weight"] = w(["order_lines"], f"""
SELECT year, month, MaterialGroup, lines, round({_seasonal_sql('month', 'year', 'MaterialGroup', CFG.base_year)}, 6) AS seasonal_weight
FROM (SELECT year(SalesOrderDate) AS year, month(SalesOrderDate) AS month, MaterialGroup, COUNT(*) AS lines
      FROM order_lines GROUP BY 1, 2, 3) x""")

ORACLE["d2_weather_mult"] = w(["history", "regressors"], f"""
SELECT ds, Material, round({_weather_mult_sql('t', 'a', 'MaterialGroup')}, 6) AS weather_mult FROM (
  SELECT ds, Material, MaterialGroup,
         COALESCE(last_value(t IGNORE NULLS) OVER fwd, first_value(t IGNORE NULLS) OVER bwd, {_d(CFG.fallback[0])}) AS t,
         COALESCE(last_value(a IGNORE NULLS) OVER fwd, first_value(a IGNORE NULLS) OVER bwd, {_d(CFG.fallback[1])}) AS a
  FROM (SELECT h.week_start AS ds, h.Material, h.MaterialGroup, r.avg_temp_c AS t, r.temp_anomaly_c AS a
        FROM history h LEFT JOIN regressors r ON CAST(date_trunc('month', h.week_start) AS DATE) = r.month_start) x
  WINDOW fwd AS (PARTITION BY Material ORDER BY ds, MaterialGroup ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         bwd AS (PARTITION BY Material ORDER BY ds, MaterialGroup ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) y""")

ORACLE["d3_expected_qty"] = w(["features"], """
SELECT SalesOrder, SalesOrderItem, OrderQuantity,
       CAST(greatest(1, round_even(OrderQuantity * seasonal_weight * weather_mult, 0)) AS BIGINT) AS expected_qty
FROM features""")

ORACLE["d7_features"] = w(["features"], """
SELECT SalesOrder, SalesOrderItem, Material, MaterialGroup, round(avg_temp_c, 6) AS avg_temp_c,
       round(temp_anomaly_c, 6) AS temp_anomaly_c, round(seasonal_weight, 6) AS seasonal_weight,
       round(weather_mult, 6) AS weather_mult FROM features""")

ORACLE["j10_weather_lookup"] = w(["sales_orders", "weather"], f"""
SELECT o.SalesOrder, o.Country, o.Region, round(COALESCE(w.avg_temp_c, {_d(CFG.fallback[0])}), 6) AS avg_temp_c,
       round(COALESCE(w.temp_anomaly_c, {_d(CFG.fallback[1])}), 6) AS temp_anomaly_c
FROM sales_orders o LEFT JOIN weather w ON o.Country = w.country AND o.Region = w.region
     AND year(o.SalesOrderDate) = w.year AND month(o.SalesOrderDate) = w.month""")

ORACLE["d4_price"] = w(["priced"], "SELECT p_partkey, month, CAST(MAX(unit_price) AS DOUBLE) AS unit_price FROM priced GROUP BY 1, 2")

ORACLE["d5_amounts"] = w(["priced"], f"""
SELECT CAST(OrderKey AS VARCHAR) AS SalesOrder, CAST(SUM(net) AS DOUBLE) AS net, CAST(SUM(tax) AS DOUBLE) AS tax FROM (
  SELECT OrderKey, net, CAST(CASE WHEN TransactionCurrency = 'EUR' THEN round(net * CAST({_C.VAT_RATE} AS DECIMAL(4,2)), 2)
                                  ELSE 0 END AS DECIMAL(20,2)) AS tax
  FROM (SELECT OrderKey, TransactionCurrency,
               CAST(round(CAST(l_quantity AS DECIMAL(18,2)) * unit_price, 2) AS DECIMAL(20,2)) AS net FROM priced) a) b
GROUP BY OrderKey""")

_EXTRA["full_items"] = (["sales_orders", "priced"], f"""
SELECT h.OrderKey, h.SalesOrder,
       printf('%06d', row_number() OVER (PARTITION BY l.l_orderkey ORDER BY {_LINE_ORDER}) * 10) AS SalesOrderItem,
       p.p_type AS Material, p.p_type AS Product, CASE WHEN h.DistributionChannel = '10' THEN 'PLANT1' ELSE 'PLANT2' END AS Plant,
       {sql_case('p.p_type', _C.MATERIAL_GROUPS)} AS MaterialGroup, p.p_brand AS ProductHierarchyNode,
       CAST(l.l_quantity AS INTEGER) AS OrderQuantity, 'CS' AS OrderQuantityUnit,
       CAST(greatest(CAST(l.l_quantity AS BIGINT) + 1,
                     round_even(CAST(l.l_quantity AS DECIMAL(18,2))
                                * (CAST(1.05 AS DECIMAL(6,2)) + (h.OrderKey % 11) * CAST(0.01 AS DECIMAL(6,2))), 0)) AS BIGINT) AS RequestedQuantity,
       'CS' AS RequestedQuantityUnit, CAST(round(pr.unit_price, 2) AS DECIMAL(24,2)) AS NetPriceAmount,
       CAST(round(CAST(l.l_quantity AS DECIMAL(18,2)) * pr.unit_price, 2) AS DECIMAL(20,2)) AS NetAmount,
       CAST(CASE WHEN h.TransactionCurrency = 'EUR'
                 THEN round(CAST(round(CAST(l.l_quantity AS DECIMAL(18,2)) * pr.unit_price, 2) AS DECIMAL(20,2)) * CAST({_C.VAT_RATE} AS DECIMAL(4,2)), 2)
                 ELSE 0 END AS DECIMAL(20,2)) AS TaxAmount,
       'TAN' AS SalesOrderItemCategory, CASE WHEN h.OverallSDDocumentRejectionSts = 'C' THEN 'Z1' ELSE '' END AS SalesDocumentRjcnReason,
       'C' AS DeliveryStatus, '' AS BillingBlockStatus,
       CASE h.Tier WHEN 'A' THEN '1' WHEN 'B' THEN '5' ELSE '9' END AS DeliveryPriority,
       p.p_brand AS InternationalArticleNumber, h.SalesOrganization, h.DistributionChannel, h.SoldToParty, h.SoldToParty AS PayerParty
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN sales_orders h ON l.l_orderkey = h.OrderKey
JOIN (SELECT p_partkey, month, MAX(unit_price) AS unit_price FROM priced GROUP BY 1, 2) pr
  ON pr.p_partkey = p.p_partkey AND pr.month = month(h.SalesOrderDate)""")
ORACLE["t_salesorderitem"] = w(["full_items"], """
SELECT * EXCLUDE (OrderKey) REPLACE (CAST(NetPriceAmount AS DOUBLE) AS NetPriceAmount, CAST(NetAmount AS DOUBLE) AS NetAmount,
                                     CAST(TaxAmount AS DOUBLE) AS TaxAmount) FROM full_items""")
ORACLE["t_salesorder"] = w(["sales_orders", "full_items"], """
SELECT o.* EXCLUDE (OrderKey, Country, Region, Tier), CAST(t.net AS DOUBLE) AS TotalNetAmount
FROM sales_orders o LEFT JOIN (SELECT OrderKey, SUM(NetAmount) AS net FROM full_items GROUP BY OrderKey) t ON o.OrderKey = t.OrderKey""")

_PH = " OR ".join(f"(Material = '{k}' AND SalesOrderDate >= DATE '{d}')" for k, d in CFG.phased_out)
ORACLE["d6_phase_out"] = w(["order_lines"], f"""
SELECT Material, COUNT(*) AS rows_in, COUNT(*) FILTER (WHERE NOT ({_PH})) AS rows_kept FROM order_lines GROUP BY Material""")

ORACLE["d8_requested"] = w(["sales_orders", "sales_order_items"], """
SELECT i.SalesOrder, i.SalesOrderItem, i.OrderQuantity,
       CAST(greatest(CAST(i.OrderQuantity AS BIGINT) + 1,
                     round_even(CAST(i.OrderQuantity AS DECIMAL(18,2))
                                * (CAST(1.05 AS DECIMAL(6,2)) + (i.OrderKey % 11) * CAST(0.01 AS DECIMAL(6,2))), 0)) AS BIGINT) AS requested_qty,
       o.CreationDate + CAST(i.OrderKey % 17 + 5 AS INTEGER) AS requested_date
FROM sales_order_items i JOIN sales_orders o ON i.SalesOrder = o.SalesOrder""")


# --- quality ---------------------------------------------------------------------------

def _offset_sql(m: str) -> str:
    off = _d(0.0)
    for months, o in _C.SEASONAL_OFFSETS:
        off = f"({off} + CASE WHEN {m} IN ({', '.join(map(str, months))}) THEN {_d(o)} ELSE {_d(0.0)} END)"
    return off


def _zero(name: str, from_where: str) -> str:
    return (f"SELECT '{name}' AS \"check\", '= 0' AS expected, CAST(COUNT(*) AS DOUBLE) AS observed, "
            f"COUNT(*) = 0 AS passed FROM {from_where}")


_ALL_MATS = sql_list([m for m, _ in _C.MATERIAL_GROUPS])
_heat_years = [y for _, _, ys in CFG.heat_windows for y in ys]
_v6 = "\nUNION ALL\n".join(
    f"""SELECT 'V6 heat-wave anomaly {y}' AS "check", '> {floor}' AS expected, round(MAX(m), 6) AS observed,
       COALESCE(MAX(m) > {floor}, false) AS passed
FROM (SELECT CAST(SUM(CAST(temp_anomaly_c AS DECIMAL(12,2))) AS DOUBLE) / CAST(COUNT(temp_anomaly_c) AS DOUBLE) AS m
      FROM weather WHERE ({_heat}) AND year = {y}) h"""
    for y, floor in zip(_heat_years, _C.HEAT_ANOMALY_FLOORS))
_ya, _yb = CFG.uplift_years
_grp = sql_list(CFG.uplift_groups)
_sm = ", ".join(map(str, _C.SUMMER_MONTHS))
_EXTRA["uplift"] = (["order_lines"], f"""
SELECT AVG(CASE WHEN year(SalesOrderDate) = {_ya} THEN CAST(OrderQuantity AS DOUBLE) END) AS mean_a,
       AVG(CASE WHEN year(SalesOrderDate) = {_yb} THEN CAST(OrderQuantity AS DOUBLE) END) AS mean_b
FROM order_lines WHERE MaterialGroup IN ({_grp}) AND month(SalesOrderDate) IN ({_sm})""")
_ulo, _uhi = _C.UPLIFT_RANGE

ORACLE["v_integrity"] = w(["sales_orders", "sales_order_items", "order_lines", "billing_documents", "cash_postings",
                           "customers", "weather", "uplift"], "\nUNION ALL\n".join([
    _zero("V1 order customer unknown", "sales_orders o WHERE NOT EXISTS (SELECT 1 FROM customers c WHERE c.Customer = o.SoldToParty)"),
    _zero("V2 item material unknown", f"sales_order_items WHERE Material NOT IN ({_ALL_MATS}) OR Material IS NULL"),
    _zero("V3 phased-out material ordered", f"order_lines WHERE {_PH}"),
    _zero("V4 billing payer unknown", "billing_documents d WHERE NOT EXISTS (SELECT 1 FROM customers c WHERE c.Customer = d.PayerParty)"),
    _zero("V5 posting before billing date", "cash_postings c JOIN billing_documents d ON c.BillingDocument = d.BillingDocument "
          "WHERE c.PostingDate < d.BillingDocumentDate"),
    _zero("V5b posting in a currency without rate", "cash_postings WHERE AmountInCompanyCodeCurrency IS NULL AND AmountInTransactionCurrency IS NOT NULL"),
    _v6,
    f"""SELECT 'V7 summer uplift {_ya} vs {_yb}' AS "check", 'between {_ulo} and {_uhi}' AS expected,
       round(mean_a / mean_b, 6) AS observed, COALESCE(mean_a / mean_b BETWEEN {_ulo} AND {_uhi}, false) AS passed FROM uplift""",
]))

_ilo, _ihi = _C.ITEMS_PER_ORDER
_et, _etol = _C.ELIGIBLE_SHARE_TARGET
_ct, _ctol = _C.CANCELLED_SHARE_TARGET
ORACLE["v_cardinality"] = w(["sales_orders", "sales_order_items", "billing_documents", "billing_items",
                             "cash_postings", "pay_terms"], "\nUNION ALL\n".join([
    _zero(f"V8 orders without {_ilo}-{_ihi} items",
          f"(SELECT SalesOrder, COUNT(*) AS n FROM sales_order_items GROUP BY 1) x WHERE NOT (n BETWEEN {_ilo} AND {_ihi})"),
    _zero("V8 orders without items", "sales_orders o WHERE NOT EXISTS (SELECT 1 FROM sales_order_items i WHERE i.SalesOrder = o.SalesOrder)"),
    _zero("V8 items without order", "sales_order_items i WHERE NOT EXISTS (SELECT 1 FROM sales_orders o WHERE i.SalesOrder = o.SalesOrder)"),
    _zero("V8 eligible orders without exactly one F2",
          "sales_orders o LEFT JOIN (SELECT SalesOrder, COUNT(*) AS n FROM billing_documents WHERE BillingDocumentType = 'F2' "
          "GROUP BY 1) f ON o.SalesOrder = f.SalesOrder WHERE o.OverallSDProcessStatus IN ('B', 'C') "
          "AND o.OverallSDDocumentRejectionSts <> 'C' AND COALESCE(f.n, 0) <> 1"),
    _zero("V8 F2 with more than one S1",
          "(SELECT CancelledBillingDocument, COUNT(*) AS n FROM billing_documents WHERE BillingDocumentType = 'S1' GROUP BY 1) x WHERE n > 1"),
    _zero("V8 open F2 without exactly one cash row",
          "pay_terms p LEFT JOIN (SELECT BillingDocument, COUNT(*) AS n FROM cash_postings GROUP BY 1) c "
          "ON p.BillingDocument = c.BillingDocument WHERE COALESCE(c.n, 0) <> 1"),
    f"""SELECT 'V11 eligible share of orders' AS "check", '{_et} +/- {_etol}' AS expected, s AS observed,
       COALESCE(abs(s - {_et}) <= {_etol}, false) AS passed FROM (
  SELECT round(CAST(COUNT(*) FILTER (WHERE OverallSDProcessStatus IN ('B', 'C') AND OverallSDDocumentRejectionSts <> 'C') AS DOUBLE)
               / CAST(COUNT(*) AS DOUBLE), 6) AS s FROM sales_orders) x""",
    f"""SELECT 'V11 cancelled share of F2' AS "check", '{_ct} +/- {_ctol}' AS expected, s AS observed,
       COALESCE(abs(s - {_ct}) <= {_ctol}, false) AS passed FROM (
  SELECT round(CAST(COUNT(*) FILTER (WHERE BillingDocumentIsCancelled) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE), 6) AS s
  FROM billing_documents WHERE BillingDocumentType = 'F2') x""",
    _zero("V12 S1 amounts not minus their F2",
          "billing_documents s LEFT JOIN billing_documents f ON s.CancelledBillingDocument = f.BillingDocument "
          "AND f.BillingDocumentType = 'F2' WHERE s.BillingDocumentType = 'S1' AND (NOT (s.TotalNetAmount = -f.TotalNetAmount) "
          "OR NOT (s.TotalTaxAmount = -f.TotalTaxAmount) OR f.TotalNetAmount IS NULL)"),
    _zero("V13 header total differs from item sum",
          "billing_documents d JOIN (SELECT BillingDocument, SUM(CAST(NetAmount AS DECIMAL(16,2))) AS n, "
          "SUM(CAST(TaxAmount AS DECIMAL(16,2))) AS t FROM billing_items GROUP BY 1) s ON d.BillingDocument = s.BillingDocument "
          "WHERE CAST(d.TotalNetAmount AS DECIMAL(16,2)) <> s.n OR CAST(d.TotalTaxAmount AS DECIMAL(16,2)) <> s.t"),
]))


def _keys_sql(name: str, table: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return "\nUNION ALL\n".join([
        _zero(f"V9 null key {name}", f"{table} WHERE " + " OR ".join(f"{c} IS NULL" for c in keys)),
        _zero(f"V10 duplicate key {name}", f"(SELECT {k}, COUNT(*) AS n FROM {table} GROUP BY {k}) x WHERE n > 1"),
    ])


ORACLE["v_keys"] = w(["billing_documents", "billing_items", "cash_postings", "sales_order_items", "sales_orders", "weather"], "\nUNION ALL\n".join([
    _keys_sql("billingdocument", "billing_documents", ["BillingDocument"]),
    _keys_sql("billingdocumentitem", "billing_items", ["BillingDocument", "BillingDocumentItem"]),
    _keys_sql("cashflow", "cash_postings", ["CashFlowID", "CshFlwValdtyStrtDteTmeVal"]),
    _keys_sql("salesorderitem", "sales_order_items", ["SalesOrder", "SalesOrderItem"]),
    _keys_sql("salesorder", "sales_orders", ["SalesOrder"]),
    _keys_sql("cashflowforecast", "(" + ORACLE["c6_cash_forecast"] + ")", ["CashFlowID", "CshFlwValdtyStrtDteTmeVal"]),
    _keys_sql("weather", "weather", ["station_id", "year", "month"]),
]))

_vols = ", ".join(f"('{v}', '{t}', {n})" for v, tables in _C.VOLUME_TARGETS for t, n in tables)
_tables = {"weather": "weather", "salesorder": "sales_orders", "salesorderitem": "sales_order_items", "billingdocument": "billing_documents",
           "billingdocumentitem": "billing_items", "cashflow": "cash_postings", "cashflowforecast": "(" + ORACLE["c6_cash_forecast"] + ")"}
ORACLE["v_targets"] = w(["weather", "sales_orders", "sales_order_items", "billing_documents", "billing_items", "cash_postings"], f"""
SELECT t.volume, t.table_name, c.rows, CAST(t.n AS BIGINT) AS expected_rows, abs(c.rows - t.n) <= {_d(_C.VOLUME_TOLERANCE)} * t.n AS passed,
       round(CAST(c.rows AS DOUBLE) / b.rows, 6) AS per_order, round(CAST(t.n AS DOUBLE) / tb.n, 6) AS expected_per_order,
       abs(CAST(c.rows AS DOUBLE) / b.rows - CAST(t.n AS DOUBLE) / tb.n) <= {_d(_C.VOLUME_TOLERANCE)} * (CAST(t.n AS DOUBLE) / tb.n) AS quotient_passed
FROM (VALUES {_vols}) t(volume, table_name, n)
JOIN (""" + " UNION ALL ".join(f"SELECT '{k}' AS table_name, CAST(COUNT(*) AS BIGINT) AS rows FROM {v} x" for k, v in _tables.items()) + f""") c ON c.table_name = t.table_name
JOIN (SELECT COUNT(*) AS rows FROM sales_orders) b ON true
JOIN (VALUES {_vols}) tb(volume, table_name, n) ON tb.volume = t.volume AND tb.table_name = 'salesorder'""")

ORACLE["a12_customer_share"] = w(["sales_order_items"], """
SELECT SoldToParty, CAST(revenue AS DOUBLE) AS revenue,
       round(CAST(revenue AS DOUBLE) / CAST(SUM(revenue) OVER () AS DOUBLE), 6) AS share
FROM (SELECT COALESCE(SoldToParty, 'none') AS SoldToParty, SUM(NetAmount) AS revenue FROM sales_order_items GROUP BY 1) x""")

ORACLE["a12_tier_share"] = w(["sales_orders", "sales_order_items"], """
SELECT Tier, CAST(revenue AS DOUBLE) AS revenue,
       round(CAST(revenue AS DOUBLE) / CAST(SUM(revenue) OVER () AS DOUBLE), 6) AS share
FROM (SELECT COALESCE(o.Tier, 'none') AS Tier, SUM(i.NetAmount) AS revenue
      FROM sales_order_items i JOIN sales_orders o ON i.SalesOrder = o.SalesOrder GROUP BY 1) x""")

_EXTRA["funnel"] = (["sales_orders", "billing_documents", "cash_postings"], """
  SELECT 0 AS step, 'orders' AS stage, CAST(COUNT(*) AS BIGINT) AS rows, CAST(NULL AS VARCHAR) AS base_stage FROM sales_orders
  UNION ALL SELECT 1, 'status_ok', CAST(COUNT(*) FILTER (WHERE OverallSDProcessStatus IN ('B', 'C')) AS BIGINT), 'orders' FROM sales_orders
  UNION ALL SELECT 2, 'not_rejected', CAST(COUNT(*) FILTER (WHERE OverallSDProcessStatus IN ('B', 'C')
                                                            AND OverallSDDocumentRejectionSts <> 'C') AS BIGINT), 'status_ok' FROM sales_orders
  UNION ALL SELECT 3, 'f2', CAST(COUNT(*) FILTER (WHERE BillingDocumentType = 'F2') AS BIGINT), 'not_rejected' FROM billing_documents
  UNION ALL SELECT 4, 'cancelled', CAST(COUNT(*) FILTER (WHERE BillingDocumentType = 'F2' AND BillingDocumentIsCancelled) AS BIGINT), 'f2' FROM billing_documents
  UNION ALL SELECT 5, 's1', CAST(COUNT(*) FILTER (WHERE BillingDocumentType = 'S1') AS BIGINT), 'cancelled' FROM billing_documents
  UNION ALL SELECT 6, 'open_f2', CAST(COUNT(*) FILTER (WHERE BillingDocumentType = 'F2' AND BillingDocumentIsCancelled = false) AS BIGINT), 'f2' FROM billing_documents
  UNION ALL SELECT 7, 'cash', CAST(COUNT(*) AS BIGINT), 'open_f2' FROM cash_postings""")
ORACLE["a13_funnel"] = w(["funnel"], """
SELECT f.step, f.stage, f.rows, f.base_stage, round(CAST(f.rows AS DOUBLE) / CAST(b.rows AS DOUBLE), 6) AS pass_rate
FROM funnel f LEFT JOIN funnel b ON f.base_stage = b.stage""")

ORACLE["a14_heat_anomaly"] = w(["weather"], f"""
SELECT year, round(CAST(SUM(CAST(temp_anomaly_c AS DECIMAL(12,2))) AS DOUBLE) / CAST(COUNT(temp_anomaly_c) AS DOUBLE), 6) AS mean_anomaly
FROM weather WHERE {_heat} GROUP BY year""")

ORACLE["a15_uplift"] = w(["uplift"], "SELECT round(mean_a, 6) AS mean_a, round(mean_b, 6) AS mean_b, round(mean_a / mean_b, 6) AS uplift FROM uplift")

ORACLE["a18_month_volume"] = w(["sales_orders"], f"""
SELECT year, month, orders, round(wt, 6) AS weight, round(CAST(orders AS DOUBLE) / wt, 6) AS orders_per_weight FROM (
  SELECT year, month, orders,
         {_d(1.0)} + {_offset_sql('month')} * ({_d(1.0)} + {_d(_C.YOY_GROWTH)} * (year - {CFG.base_year})) AS wt
  FROM (SELECT year(SalesOrderDate) AS year, month(SalesOrderDate) AS month, CAST(COUNT(*) AS BIGINT) AS orders
        FROM sales_orders GROUP BY 1, 2) x) y""")


# --- profiles and listings -------------------------------------------------------------

def _profile_sql(name: str, table: str, keys: list[str]) -> str:
    k = " || '/' || ".join(f"CAST({c} AS VARCHAR)" for c in keys)
    return (f"SELECT '{name}' AS table_name, CAST(COUNT(*) AS BIGINT) AS rows, "
            f"(SELECT string_agg(k, ';' ORDER BY k) FROM (SELECT {k} AS k FROM {table} ORDER BY 1 LIMIT 3) s) AS sample FROM {table}")


ORACLE["s7_table_profile"] = w(["sales_orders", "sales_order_items", "billing_documents", "billing_items",
                                "cash_postings", "weather"], "\nUNION ALL\n".join([
    _profile_sql("salesorder", "sales_orders", ["SalesOrder"]),
    _profile_sql("salesorderitem", "sales_order_items", ["SalesOrder", "SalesOrderItem"]),
    _profile_sql("billingdocument", "billing_documents", ["BillingDocument"]),
    _profile_sql("billingdocumentitem", "billing_items", ["BillingDocument", "BillingDocumentItem"]),
    _profile_sql("cashflow", "cash_postings", ["BillingDocument"]),
    _profile_sql("weather", "weather", ["station_id", "year", "month"]),
]))

ORACLE["o5_sorted_keys"] = w(["history"], "SELECT DISTINCT Material FROM history ORDER BY Material")

ORACLE["o3_first_rows"] = w(["history"], "SELECT * FROM history ORDER BY Material, week_start LIMIT 5")

ORACLE["w6_first_items"] = w(["sales_order_items"], """
SELECT SalesOrder, SalesOrderItem, Material, OrderQuantity FROM sales_order_items WHERE CAST(SalesOrderItem AS INTEGER) <= 20""")

ORACLE["x6_season"] = w(["weather"], """
SELECT year, CASE WHEN month IN (12, 1, 2) THEN 'winter' WHEN month IN (3, 4, 5) THEN 'spring'
                  WHEN month IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season,
       CAST(COUNT(*) AS BIGINT) AS station_months
FROM weather GROUP BY 1, 2""")


# --- model input ---------------------------------------------------------------------

def _fill_sql(frame: str) -> str:
    return f"""
SELECT Material, ds, MaterialGroup,
       COALESCE(last_value(t IGNORE NULLS) OVER fwd, first_value(t IGNORE NULLS) OVER bwd, {_d(CFG.fallback[0])}) AS t,
       COALESCE(last_value(a IGNORE NULLS) OVER fwd, first_value(a IGNORE NULLS) OVER bwd, {_d(CFG.fallback[1])}) AS a
FROM (SELECT x.*, r.avg_temp_c AS t, r.temp_anomaly_c AS a
      FROM {frame} x LEFT JOIN regressors r ON CAST(date_trunc('month', x.ds) AS DATE) = r.month_start) j
WINDOW fwd AS (PARTITION BY Material ORDER BY ds, MaterialGroup ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       bwd AS (PARTITION BY Material ORDER BY ds, MaterialGroup ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""


_EXTRA.update({
    "mi_hist": (["history"], f"""
SELECT week_start AS ds, Material, MaterialGroup, CAST(qty AS DOUBLE) AS y FROM history
WHERE Material IN (SELECT Material FROM history GROUP BY Material HAVING COUNT(*) >= {CFG.min_rows})"""),
    "mi_full": (["mi_hist", "future"], """
SELECT ds, Material, MaterialGroup, y FROM mi_hist
UNION ALL
SELECT ds, Material, MaterialGroup, CAST(NULL AS DOUBLE) AS y FROM future WHERE Material IN (SELECT Material FROM mi_hist)"""),
    "mi_fill_train": (["mi_hist", "regressors"], _fill_sql("mi_hist")),
    "mi_fill_full": (["mi_full", "regressors"], _fill_sql("mi_full")),
})

ORACLE["f1_model_input"] = w(["mi_full", "mi_fill_train", "mi_fill_full"], """
SELECT f.Material, f.ds, f.MaterialGroup, m.y, m.y IS NOT NULL AS is_train,
       round(f.t, 6) AS avg_temp_c_full, round(f.a, 6) AS temp_anomaly_c_full,
       round(tr.t, 6) AS avg_temp_c_train, round(tr.a, 6) AS temp_anomaly_c_train
FROM mi_fill_full f JOIN mi_full m ON f.Material = m.Material AND f.ds = m.ds
LEFT JOIN mi_fill_train tr ON tr.Material = f.Material AND tr.ds = f.ds""")
