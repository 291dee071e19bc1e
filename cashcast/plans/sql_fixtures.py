"""SQL twins of ``cashcast.sources.fixtures`` as named CTEs (ANSI SQL that DuckDB runs).

``sql_with(["weather"], body)`` prepends the CTE and everything it depends on.
"""

from __future__ import annotations

from cashcast import config as C


def sql_case(expr: str, pairs, default=None) -> str:
    whens = " ".join(f"WHEN {expr} = '{k}' THEN '{v}'" for k, v in pairs)
    tail = f" ELSE '{default}'" if default is not None else ""
    return f"CASE {whens}{tail} END"


def sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


_LINE_ORDER = ("l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice, "
               "l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus, l.l_shipdate")
_NET = ("CAST(ROUND(CAST(l.l_extendedprice AS DECIMAL(15,2)) * "
        "(1 - CAST(l.l_discount AS DECIMAL(15,2))), 2) AS DECIMAL(15,2))")

CTES: dict[str, tuple[list[str], str]] = {
    "geo": ([], """
SELECT n.n_nationkey, n.n_name, r.r_name
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""),
    "customers": (["geo"], f"""
SELECT CAST(c.c_custkey AS VARCHAR) AS Customer, c.c_custkey AS CustKey, g.r_name AS Country,
       g.n_name AS Region, c.c_mktsegment AS Segment,
       {sql_case('c.c_mktsegment', C.SEGMENT_TIERS)} AS Tier,
       {sql_case('g.r_name', C.REGION_CURRENCY, C.OTHER_REGION_CURRENCY)} AS Currency
FROM customer c LEFT JOIN geo g ON c.c_nationkey = g.n_nationkey"""),
    "customer_dunning": ([], """
SELECT CAST(c_custkey AS VARCHAR) AS Customer,
       CAST(CASE WHEN c_custkey % 5 = 4 THEN NULL ELSE c_custkey % 5 END AS INTEGER) AS DunningLevel
FROM customer"""),
    "sales_area": (["customers"], f"""
SELECT Customer, CustKey, DistributionChannel,
       {sql_case('Tier', C.TIER_PAYMENT_TERMS, C.OTHER_PAYMENT_TERMS)} AS CustomerPaymentTerms,
       CASE WHEN DistributionChannel = '10' THEN 'EXW' ELSE 'FCA' END AS IncotermsClassification,
       Currency,
       CASE WHEN CustKey % 4 = 0 THEN NULL ELSE 'KG0' || CAST(CustKey % 3 + 2 AS VARCHAR) END AS CustomerGroup
FROM (SELECT *, UNNEST(CASE WHEN CustKey % 3 = 0 THEN ['10', '20'] ELSE ['20'] END) AS DistributionChannel
      FROM customers) x"""),
    "preferred_area": (["sales_area"], """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY Customer
                               ORDER BY DistributionChannel <> '10', DistributionChannel) AS rn
  FROM sales_area) x WHERE rn = 1"""),
    "customer_dim": (["customers", "preferred_area"], """
SELECT c.*, a.DistributionChannel, a.CustomerPaymentTerms, a.IncotermsClassification, a.CustomerGroup
FROM customers c LEFT JOIN preferred_area a ON c.CustKey = a.CustKey"""),
    "sales_orders": (["customer_dim"], f"""
SELECT o.o_orderkey AS OrderKey, CAST(o.o_orderkey AS VARCHAR) AS SalesOrder, 'OR' AS SalesOrderType,
       CAST(o.o_orderdate AS DATE) AS CreationDate, CAST(o.o_orderdate AS DATE) AS SalesOrderDate,
       CAST(o.o_custkey AS VARCHAR) AS SoldToParty, '{C.SALES_ORGANIZATION}' AS SalesOrganization,
       COALESCE(d.DistributionChannel, '{C.DEFAULT_CHANNEL}') AS DistributionChannel,
       '01' AS OrganizationDivision, 'SG01' AS SalesGroup, 'SO01' AS SalesOffice,
       d.Currency AS TransactionCurrency, d.CustomerPaymentTerms,
       CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 17 + 5 AS INTEGER) AS RequestedDeliveryDate,
       d.IncotermsClassification, '' AS DeliveryBlockReason, '' AS HeaderBillingBlockReason,
       {sql_case('o.o_orderstatus', C.ORDER_STATUS)} AS OverallSDProcessStatus,
       CASE WHEN o.o_orderpriority = '{C.REJECTED_PRIORITY}' THEN 'C' ELSE '' END AS OverallSDDocumentRejectionSts,
       CAST(year(o.o_orderdate) AS VARCHAR) AS FiscalYear,
       lpad(CAST(month(o.o_orderdate) AS VARCHAR), 2, '0') AS FiscalPeriod,
       '{C.COMPANY_CODE}' AS BillingCompanyCode, 'T' AS PaymentMethod,
       COALESCE(d.CustomerGroup, '{C.DEFAULT_CUSTOMER_GROUP}') AS AdditionalCustomerGroup1,
       d.Country, d.Region, d.Tier
FROM orders o LEFT JOIN customer_dim d ON o.o_custkey = d.CustKey"""),
    "order_lines": ([], f"""
SELECT CAST(l.l_orderkey AS VARCHAR) AS SalesOrder, CAST(o.o_orderdate AS DATE) AS SalesOrderDate,
       p.p_type AS Material, {sql_case('p.p_type', C.MATERIAL_GROUPS)} AS MaterialGroup,
       CAST(l.l_quantity AS INTEGER) AS OrderQuantity
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey"""),
    "sales_order_items": (["sales_orders"], f"""
SELECT l.l_orderkey AS OrderKey, CAST(l.l_orderkey AS VARCHAR) AS SalesOrder,
       printf('%06d', row_number() OVER (PARTITION BY l.l_orderkey ORDER BY {_LINE_ORDER}) * 10) AS SalesOrderItem,
       p.p_type AS Material, p.p_type AS Product,
       CASE WHEN h.DistributionChannel = '10' THEN 'PLANT1' ELSE 'PLANT2' END AS Plant,
       {sql_case('p.p_type', C.MATERIAL_GROUPS)} AS MaterialGroup,
       p.p_brand AS ProductHierarchyNode, CAST(l.l_quantity AS INTEGER) AS OrderQuantity,
       'CS' AS OrderQuantityUnit, {_NET} AS NetAmount,
       CASE WHEN h.TransactionCurrency = 'EUR' THEN CAST(ROUND({_NET} * 0.19, 2) AS DECIMAL(15,2))
            ELSE CAST(0 AS DECIMAL(15,2)) END AS TaxAmount,
       'TAN' AS SalesOrderItemCategory,
       CASE WHEN h.OverallSDDocumentRejectionSts = 'C' THEN 'Z1' ELSE '' END AS SalesDocumentRjcnReason,
       'C' AS DeliveryStatus, '' AS BillingBlockStatus,
       CASE h.Tier WHEN 'A' THEN '1' WHEN 'B' THEN '5' WHEN 'C' THEN '9' ELSE '9' END AS DeliveryPriority,
       p.p_brand AS InternationalArticleNumber, h.SalesOrganization, h.DistributionChannel,
       h.SoldToParty, h.SoldToParty AS PayerParty
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN sales_orders h ON l.l_orderkey = h.OrderKey"""),
    "weather_parts": ([], """
SELECT l_suppkey, year(l_shipdate) AS year, month(l_shipdate) AS month,
       SUM(l_quantity) AS q, SUM(round(l_discount * 100)) AS d, SUM(round(l_tax * 1000)) AS t,
       COUNT(*) AS n
FROM lineitem GROUP BY l_suppkey, year(l_shipdate), month(l_shipdate)"""),
    "weather": (["weather_parts", "geo"], """
SELECT 'ST_' || CAST(g.n_nationkey AS VARCHAR) AS station_id, g.n_name AS station_name,
       g.r_name AS country, g.n_name AS region,
       CAST(w.year AS INTEGER) AS year, CAST(w.month AS INTEGER) AS month,
       CAST((CAST(SUM(w.q) AS BIGINT) * 200 + CAST(SUM(w.n) AS BIGINT)) // (CAST(SUM(w.n) AS BIGINT) * 2) AS DOUBLE) / 100.0 AS avg_temp_c,
       CAST((CAST(SUM(w.d) AS BIGINT) * 200 + CAST(SUM(w.n) AS BIGINT)) // (CAST(SUM(w.n) AS BIGINT) * 2) - 500 AS DOUBLE) / 100.0 AS temp_anomaly_c,
       CAST((CAST(SUM(w.t) AS BIGINT) * 20 + CAST(SUM(w.n) AS BIGINT)) // (CAST(SUM(w.n) AS BIGINT) * 2) AS DOUBLE) / 10.0 AS precipitation_mm,
       false AS extreme_heat_flag
FROM weather_parts w JOIN supplier s ON w.l_suppkey = s.s_suppkey JOIN geo g ON s.s_nationkey = g.n_nationkey
GROUP BY g.n_nationkey, g.n_name, g.r_name, w.year, w.month"""),
}


def _order(names: list[str], extra: dict[str, tuple[list[str], str]]) -> list[str]:
    all_ctes = {**CTES, **extra}
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for dep in all_ctes[n][0]:
            visit(dep)
        out.append(n)

    for n in names:
        visit(n)
    return out


def sql_with(names: list[str], body: str, extra: dict[str, tuple[list[str], str]] | None = None) -> str:
    """Prefix ``body`` with the named CTEs (and their dependencies), in dependency order."""
    extra = extra or {}
    all_ctes = {**CTES, **extra}
    parts = [f"{n} AS ({all_ctes[n][1].strip()})" for n in _order(names, extra)]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()

CTES["billing_orders"] = (["sales_orders"], """
SELECT *, CAST(3 + OrderKey % 8 AS INTEGER) AS lag_days, OrderKey % 10 = 0 AS is_cancelled FROM sales_orders""")
