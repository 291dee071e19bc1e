"""Data-quality checks (V1-V13) and business aggregates.

Every check is one row ``(check, expected, observed, passed)`` computed by an aggregate;
a report is the union of its checks, so each check is a distributed count or mean -
nothing is collected to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cashcast import config as C
from cashcast.functions.numeric import exact_mean


def _row(one: DataFrame, name: str, expected: str, passed: Column) -> DataFrame:
    return one.select(F.lit(name).alias("check"), F.lit(expected).alias("expected"),
                      F.col("observed").cast("double").alias("observed"),
                      F.coalesce(passed, F.lit(False)).alias("passed"))


def zero_check(df: DataFrame, name: str) -> DataFrame:
    """Rows of ``df`` are violations: expected 0."""
    one = df.agg(F.count(F.lit(1)).alias("observed"))
    return _row(one, name, "= 0", F.col("observed") == 0)


def value_check(one: DataFrame, name: str, expected: str, passed: Column) -> DataFrame:
    """``one`` is a one-row frame with an ``observed`` column."""
    return _row(one, name, expected, passed)


def report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


# --- V1-V7: integrity of the business data ---------------------------------------------

def unknown_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """V1: orders whose sold-to party is not a known customer."""
    return orders.join(customers.select(F.col("Customer").alias("SoldToParty")), "SoldToParty", "left_anti")


def unknown_materials(items: DataFrame, materials) -> DataFrame:
    """V2: items whose material is not in the material list."""
    return items.filter(~F.col("Material").isin(list(materials)) | F.col("Material").isNull())


def phased_out_orders(lines: DataFrame, phased_out) -> DataFrame:
    """V3: lines of a phased-out material on or after its date."""
    cond = F.lit(False)
    for sku, since in phased_out:
        cond = cond | ((F.col("Material") == sku) & (F.col("SalesOrderDate") >= F.lit(str(since)).cast("date")))
    return lines.filter(cond)


def unknown_payers(docs: DataFrame, customers: DataFrame) -> DataFrame:
    """V4: billing documents whose payer is not a known customer (a null payer counts)."""
    return docs.join(customers.select(F.col("Customer").alias("PayerParty")), "PayerParty", "left_anti")


def early_postings(cash: DataFrame, docs: DataFrame) -> DataFrame:
    """V5: cash rows posted before their billing date."""
    d = docs.select("BillingDocument", "BillingDocumentDate")
    return cash.join(d, "BillingDocument").filter(F.col("PostingDate") < F.col("BillingDocumentDate"))


def heat_anomaly(weather: DataFrame, windows) -> DataFrame:
    """Mean temperature anomaly per heat year over the window's country and months."""
    parts = []
    for country, months, years in windows:
        parts.append(weather.filter((F.col("country") == country) & F.col("month").isin(list(months))
                                    & F.col("year").isin(list(years))))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy("year").agg(exact_mean("temp_anomaly_c", 12).alias("mean_anomaly"))


def period_uplift(lines: DataFrame, groups, year_a: int, year_b: int, months=C.SUMMER_MONTHS) -> DataFrame:
    """Mean order quantity in the summer months of ``year_a`` over that of ``year_b``."""
    d = F.col("SalesOrderDate")
    in_years = [(d >= F.make_date(F.lit(y), F.lit(1), F.lit(1))) & (d <= F.make_date(F.lit(y), F.lit(12), F.lit(31)))
                for y in (year_a, year_b)]
    base = lines.filter((in_years[0] | in_years[1]) & F.col("MaterialGroup").isin(list(groups)) & F.month(d).isin(list(months)))
    qa = F.when(F.year(d) == year_a, F.col("OrderQuantity").cast("double"))
    qb = F.when(F.year(d) == year_b, F.col("OrderQuantity").cast("double"))
    one = base.agg(F.avg(qa).alias("mean_a"), F.avg(qb).alias("mean_b"))
    return one.withColumn("uplift", F.try_divide(F.col("mean_a"), F.col("mean_b")))


def integrity_report(orders, items, lines, docs, cash, customers, weather, materials, phased_out,
                     windows, uplift_groups, uplift_years) -> DataFrame:
    """V1-V7."""
    checks = [
        zero_check(unknown_customers(orders, customers), "V1 order customer unknown"),
        zero_check(unknown_materials(items, materials), "V2 item material unknown"),
        zero_check(phased_out_orders(lines, phased_out), "V3 phased-out material ordered"),
        zero_check(unknown_payers(docs, customers), "V4 billing payer unknown"),
        zero_check(early_postings(cash, docs), "V5 posting before billing date"),
    ]
    heat = heat_anomaly(weather, windows)
    years = [y for _, _, ys in windows for y in ys]
    for year, floor in zip(years, C.HEAT_ANOMALY_FLOORS):
        one = heat.filter(F.col("year") == year).agg(F.max("mean_anomaly").alias("observed"))
        checks.append(value_check(one, f"V6 heat-wave anomaly {year}", f"> {floor}", F.col("observed") > floor))
    checks.append(zero_check(cash.filter(F.col("AmountInCompanyCodeCurrency").isNull() & F.col("AmountInTransactionCurrency").isNotNull()),
                             "V5b posting in a currency without rate"))
    lo, hi = C.UPLIFT_RANGE
    up = period_uplift(lines, uplift_groups, *uplift_years).select(F.col("uplift").alias("observed"))
    checks.append(value_check(up, f"V7 summer uplift {uplift_years[0]} vs {uplift_years[1]}",
                              f"between {lo} and {hi}", F.col("observed").between(lo, hi)))
    return report(*checks)


# --- V8, V11-V13: cardinalities and totals ---------------------------------------------

def _as_rows(one: DataFrame, checks: list[tuple[str, str, Column, Column]]) -> DataFrame:
    """The one row of a report's aggregates as a row for each (check, expected, observed, passed)."""
    made = F.array(*[F.struct(F.lit(name).alias("check"), F.lit(expected).alias("expected"),
                              observed.cast("double").alias("observed"), F.coalesce(passed, F.lit(False)).alias("passed"))
                     for name, expected, observed, passed in checks])
    return one.select(F.inline(made))


def _zero(name: str, observed: str) -> tuple[str, str, Column, Column]:
    """A number of violations: expected 0."""
    n = F.coalesce(F.col(observed), F.lit(0))
    return name, "= 0", n, n == 0


def _near(name: str, observed: Column, target: float, tolerance: float) -> tuple[str, str, Column, Column]:
    return name, f"{target} +/- {tolerance}", observed, F.abs(observed - target) <= tolerance


def _share(part: str, whole: str) -> Column:
    return F.round(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), 6)


def _stacked(key: str, *sides: tuple[DataFrame, Column, dict[str, Column]]) -> DataFrame:
    """The sides' rows under one key column, a column of one side null in the others: with the
    aggregate over the key a full outer join of them all, in one exchange."""
    parts = [df.select(k.cast("string").alias(key), *[c.alias(n) for n, c in cols.items()]) for df, k, cols in sides]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


#: Rows under one key column that a task aggregates.
KEY_ROWS = 500_000


def key_partitions(docs: DataFrame, items: DataFrame) -> int:
    """Partitions for all rows of documents, their items and what refers to them: more tables' rows are more
    tasks, not larger ones. A Parquet table is counted from its footers."""
    rows = 4 * docs.count() + 2 * items.count()
    return max(docs.sparkSession.sparkContext.defaultParallelism, rows // KEY_ROWS + 1)


def order_checks(orders: DataFrame, items: DataFrame, docs: DataFrame, partitions: int) -> DataFrame:
    """V8 and V11 by order: each table is scanned once and meets the others under the order's key."""
    lo, hi = C.ITEMS_PER_ORDER
    one = F.lit(1)
    eligible = F.when(F.col("OverallSDProcessStatus").isin("B", "C") & (F.col("OverallSDDocumentRejectionSts") != "C"), 1)
    key = F.col("SalesOrder")
    per = (_stacked("k", (orders, key, {"o": one, "e": eligible}), (items, key, {"i": one}),
                    (docs.filter(F.col("BillingDocumentType") == "F2"), key, {"f": one, "c": F.when(F.col("BillingDocumentIsCancelled"), 1)}))
           .repartition(partitions, "k").groupBy("k").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("o", "e", "i", "f", "c")]))
    apart = F.col("k").isNull()  # a null key meets nothing
    of = per.agg(
        F.count_if((F.col("i") > 0) & ~F.col("i").between(lo, hi)).alias("span"),
        F.sum(F.when(apart | (F.col("i") == 0), F.col("o"))).alias("bare"),
        F.sum(F.when(apart | (F.col("o") == 0), F.col("i"))).alias("orphan"),
        F.sum(F.when(apart | (F.col("f") != 1), F.col("e"))).alias("unbilled"),
        *[F.sum(c).alias(f"n_{c}") for c in ("o", "e", "f", "c")])
    return _as_rows(of, [
        _zero(f"V8 orders without {lo}-{hi} items", "span"), _zero("V8 orders without items", "bare"),
        _zero("V8 items without order", "orphan"), _zero("V8 eligible orders without exactly one F2", "unbilled"),
        _near("V11 eligible share of orders", _share("n_e", "n_o"), *C.ELIGIBLE_SHARE_TARGET),
        _near("V11 cancelled share of F2", _share("n_c", "n_f"), *C.CANCELLED_SHARE_TARGET),
    ])


def document_checks(docs: DataFrame, doc_items: DataFrame, cash: DataFrame, open_known: DataFrame, partitions: int) -> DataFrame:
    """V8, V12 and V13 by document, an S1 under the document that it cancels as well. Where an F2
    has several S1, or an id several documents (V10), one that is wrong counts them all. Rows are
    dealt out by key first: sums made before that would be a wide row for nearly every row read,
    held by the task that reads, whatever its size."""
    one, key = F.lit(1), F.col("BillingDocument")
    money = lambda c: F.col(c).cast("decimal(16,2)")
    f2 = F.col("BillingDocumentType") == "F2"
    heads = {"n_docs": one, "head_net": money("TotalNetAmount"), "head_tax": money("TotalTaxAmount"), "n_f2": F.when(f2, 1),
             "f2_net": F.when(f2, F.col("TotalNetAmount")), "f2_tax": F.when(f2, F.col("TotalTaxAmount"))}
    minus = {"n_s1": one, "s1_net": -F.col("TotalNetAmount"), "s1_tax": -F.col("TotalTaxAmount")}
    s1 = docs.filter(F.col("BillingDocumentType") == "S1")
    rows = _stacked("k", (docs, key, heads), (s1, F.col("CancelledBillingDocument"), minus),
                    (doc_items, key, {"item_net": money("NetAmount"), "item_tax": money("TaxAmount")}),
                    (cash, key, {"n_cash": one}), (open_known, key, {"n_open": one}))
    counts = ("n_docs", "n_f2", "n_s1", "n_cash", "n_open", "item_net", "item_tax")
    ends = ("head_net", "head_tax", "f2_net", "f2_tax", "s1_net", "s1_tax")
    per = rows.repartition(partitions, "k").groupBy("k").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts],
                                *[g(c).alias(f"{n}_{c}") for c in ends for n, g in (("lo", F.min), ("hi", F.max))])
    differs = lambda a, b: F.coalesce((F.col(f"lo_{a}") != b) | (F.col(f"hi_{a}") != b), F.lit(False))
    apart = F.col("k").isNull()
    wrong = (apart | F.col("lo_f2_net").isNull() | differs("s1_net", F.col("lo_f2_net")) | differs("s1_tax", F.col("lo_f2_tax"))
             | differs("s1_net", F.col("hi_f2_net")) | differs("s1_tax", F.col("hi_f2_tax")))
    none = F.lit(0).cast("decimal(16,2)")
    net, tax = (F.when(apart, none).otherwise(F.col(c)) for c in ("item_net", "item_tax"))
    of = per.agg(F.count_if(F.col("n_s1") > 1).alias("twice"),
                 F.sum(F.when(apart | (F.col("n_cash") != 1), F.col("n_open"))).alias("unpaid"),
                 F.sum(F.when(wrong, F.col("n_s1"))).alias("unlike"),
                 F.sum(F.when(differs("head_net", net) | differs("head_tax", tax), F.col("n_docs"))).alias("unequal"))
    return _as_rows(of, [
        _zero("V8 F2 with more than one S1", "twice"), _zero("V8 open F2 without exactly one cash row", "unpaid"),
        _zero("V12 S1 amounts not minus their F2", "unlike"), _zero("V13 header total differs from item sum", "unequal"),
    ])


def cardinality_report(orders, items, docs, doc_items, cash, open_known) -> DataFrame:
    """V8 (items per order, orphans both ways, one F2 per eligible order, at most one S1
    per F2, one cash row per open F2 of a known payer), V11 (shares near target),
    V12 (S1 mirrors its F2), V13 (header totals equal item sums): two aggregates, one over
    order keys and one over document keys."""
    partitions = key_partitions(docs, items)
    return report(order_checks(orders, items, docs, partitions), document_checks(docs, doc_items, cash, open_known, partitions))


# --- V11: volumes ----------------------------------------------------------------------

def volume_targets(spark: SparkSession, targets=C.VOLUME_TARGETS, tolerance: float = C.VOLUME_TOLERANCE) -> DataFrame:
    """The targets dimension (S2): volume, table_name, expected_rows, tolerance."""
    rows = [(volume, name, n, tolerance) for volume, tables in targets for name, n in tables]
    return spark.createDataFrame(rows, "volume string, table_name string, expected_rows long, tolerance double")


def table_counts(tables: list[tuple[str, DataFrame]]) -> DataFrame:
    """(table_name, rows) of each table; a Parquet table answers from its footers."""
    return report(*[df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, df in tables])


def volume_report(counts: DataFrame, targets: DataFrame, base: str = "salesorder") -> DataFrame:
    """Each table's rows against every volume's target, and, whatever the volume, its rows
    for each row of the table ``base`` against the same quotient of the targets.

    A table without rows in ``counts`` has 0; one without a target is left out. Both sides have
    a row per table.
    """
    j = targets.join(F.broadcast(counts), "table_name", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    of = Window.partitionBy("volume")
    based = lambda c: F.max(F.when(F.col("table_name") == base, F.col(c))).over(of)
    near = lambda a, b: F.coalesce(F.abs(a - b) <= F.col("tolerance") * b, F.lit(False))
    j = j.withColumns({"per_base": F.try_divide(F.col("rows").cast("double"), based("rows").cast("double")),
                       "expected_per_base": F.try_divide(F.col("expected_rows").cast("double"), based("expected_rows").cast("double"))})
    return j.select("volume", "table_name", "rows", "expected_rows", near(F.col("rows"), F.col("expected_rows")).alias("passed"),
                    F.round("per_base", 6).alias("per_order"), F.round("expected_per_base", 6).alias("expected_per_order"),
                    near(F.col("per_base"), F.col("expected_per_base")).alias("quotient_passed"))


# --- V9-V10: keys ----------------------------------------------------------------------

def key_checks(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """V9 (rows with a null in any key column) and V10 (key values that occur more than once) of
    one table, from one aggregate over its keys."""
    n, missing = F.col("_n"), reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    of = per.agg(F.sum(F.when(missing, n)).alias("nulls"), F.count_if(n > 1).alias("repeated"))
    return _as_rows(of, [_zero(f"V9 null key {name}", "nulls"), _zero(f"V10 duplicate key {name}", "repeated")])


def key_report(tables: list[tuple[str, DataFrame, list[str]]]) -> DataFrame:
    return report(*[key_checks(df, keys, name) for name, df, keys in tables])


# --- A12, A13, A18 ---------------------------------------------------------------------

def revenue_share(items: DataFrame, by: str = "Tier") -> DataFrame:
    """Net revenue per tier, customer, ... and its share of the total. ``items`` carry
    the column ``by`` of their order; the total is an aggregate of its own."""
    g = items.groupBy(F.coalesce(F.col(by), F.lit("none")).alias(by)).agg(F.sum("NetAmount").alias("revenue"))
    total = items.agg(F.sum("NetAmount")).scalar()
    return g.select(by, F.col("revenue").cast("double").alias("revenue"),
                    F.round(F.try_divide(F.col("revenue").cast("double"), total.cast("double")), 6).alias("share"))


FUNNEL = [  # (stage, the stage its pass rate is measured against)
    ("orders", None), ("status_ok", "orders"), ("not_rejected", "status_ok"), ("f2", "not_rejected"),
    ("cancelled", "f2"), ("s1", "cancelled"), ("open_f2", "f2"), ("cash", "open_f2"),
]


def eligibility_funnel(orders: DataFrame, docs: DataFrame, cash: DataFrame) -> DataFrame:
    """Orders -> status ok -> not rejected -> F2 -> cancelled -> S1, and F2 -> open
    F2 -> cash, each with its pass rate against its base stage. One aggregate per source
    table, computed once; their one-row results are one row of eight counts. ``docs`` are the
    F2 documents before numbering (B2); a cancelled one has its S1."""
    ok = F.col("OverallSDProcessStatus").isin("B", "C")
    o = orders.agg(F.count(F.lit(1)).alias("orders"), F.count_if(ok).alias("status_ok"),
                   F.count_if(ok & (F.col("OverallSDDocumentRejectionSts") != "C")).alias("not_rejected"))
    d = docs.agg(F.count(F.lit(1)).alias("f2"), F.count_if(F.col("BillingDocumentIsCancelled")).alias("cancelled"),
                 F.count_if(F.col("BillingDocumentIsCancelled")).alias("s1"),
                 F.count_if(F.col("BillingDocumentIsCancelled") == F.lit(False)).alias("open_f2"))
    c = cash.agg(F.count(F.lit(1)).alias("cash"))
    names = [n for n, _ in FUNNEL]
    sides = [one.select(*[F.col(n).cast("bigint").alias(n) if n in one.columns else F.lit(None).cast("bigint").alias(n) for n in names])
             for one in (o, d, c)]
    row = report(*sides).agg(*[F.max(n).alias(n) for n in names])
    stages = F.array(*[F.struct(
        F.lit(i).alias("step"), F.lit(n).alias("stage"), F.col(n).alias("rows"), F.lit(base).cast("string").alias("base_stage"),
        (F.round(F.try_divide(F.col(n).cast("double"), F.col(base).cast("double")), 6) if base
         else F.lit(None).cast("double")).alias("pass_rate")) for i, (n, base) in enumerate(FUNNEL)])
    return row.select(F.inline(stages))


def month_volume(orders: DataFrame, base_year: int) -> DataFrame:
    """Orders per calendar month against the documented density weight
    1 + seasonal offset(month) x (1 + 0.03 (year - base_year))."""
    d = F.col("SalesOrderDate")
    g = orders.groupBy(F.year(d).alias("year"), F.month(d).alias("month")).agg(F.count(F.lit(1)).alias("orders"))
    off = F.lit(0.0)
    for months, o in C.SEASONAL_OFFSETS:
        off = off + F.when(F.col("month").isin(*months), F.lit(o)).otherwise(F.lit(0.0))
    weight = F.lit(1.0) + off * (F.lit(1.0) + F.lit(C.YOY_GROWTH) * (F.col("year") - F.lit(base_year)))
    return g.withColumn("weight", F.round(weight, 6)).withColumn(
        "orders_per_weight", F.round(F.try_divide(F.col("orders").cast("double"), weight), 6))
