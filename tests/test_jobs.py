import os
import tempfile

from pyspark.sql import functions as F

from cashcast.operators import billing as B
from cashcast.plans import jobs
from cashcast.sources.tables import clone_empty, table_profile, with_required

SF = "/root/testdata/sf0.001"


def test_jobs_write_and_count(spark):
    root = tempfile.mkdtemp(prefix="cashcast-tables-")
    b = jobs.billing_job(spark, SF, root=root)
    c = jobs.cash_job(spark, SF, root=root)
    f = jobs.forecast_job(spark, SF, root=root)
    assert b["billingdocument"] > 0 and b["billingdocumentitem"] > 0
    assert c["cashflow"] > 0 and c["cashflowforecast"] == 182
    assert f["series_status"] == 5 and f["forecast_salesorderquantity_material"] > 0
    models = spark.read.parquet(os.path.join(root, "forecasts", "series_model"))
    assert f["series_model"] == models.filter("size(season) = 20 AND train_mae > 0").count() > 0 and f["rejected_dates"] == 0
    docs = spark.read.parquet(os.path.join(root, "billingdocument", "billingdocument"))
    assert docs.columns[0] == "BillingDocument" and len(docs.columns) == 20


def test_with_required_rejects_null_keys(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    import pytest
    with pytest.raises(Exception):
        with_required(df, ["k"]).collect()
    good = with_required(df.filter(F.col("k").isNotNull()), ["k"])
    assert good.count() == 1 and not good.schema["k"].nullable
    kinds = spark.createDataFrame([(1, 2, None)], "a long, b int, c string").selectExpr(
        "a", "b", "CAST(a AS DECIMAL(21,7)) AS d", "DATE '2020-01-01' AS e", "TIMESTAMP '2020-01-01 00:00:00' AS f")
    typed = with_required(kinds, kinds.columns)
    assert typed.dtypes == kinds.dtypes and typed.collect() == kinds.collect()


def test_jobs_refuse_repeated_keys(spark):
    import pytest
    df = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(ValueError, match="V10"):
        jobs._write(df, "t.k", ["k"], "parquet", tempfile.mkdtemp(prefix="cashcast-tables-"))


def test_jobs_refuse_null_keys_and_count_rows(spark):
    import pytest
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 3), ("b", 4)], "k string, v int")
    root = tempfile.mkdtemp(prefix="cashcast-tables-")
    with pytest.raises(ValueError, match="V9 null key t.k: 2; V10 duplicate key t.k: 1"):
        jobs._write(df, "t.k", ["k"], "parquet", root)
    assert not os.path.exists(os.path.join(root, "t", "k"))
    assert jobs._write(df.filter("k IS NOT NULL"), "t.k", ["k"], "parquet", root) == 2
    assert jobs._write(df.limit(0), "t.e", ["k"], "parquet", root) == 0


def test_jobs_run_a_plan_once(spark):
    """The rows of a written table are computed once: counting, key checks and the write share a pass."""
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    # an exchange below the range partitioning, so that its sampling reads shuffled rows
    df = spark.range(1000).mapInArrow(seen, "id long").groupBy("id").count()
    assert jobs._write(df, "t.once", ["id"], "parquet", tempfile.mkdtemp(prefix="cashcast-tables-")) == 1000
    assert runs.value == 1000


def test_bucketed_tables_join_without_an_exchange(spark):
    """J1, J9, J15 and B5 on the catalog's tables."""
    out = jobs.order_job(spark, SF, schema="cashcast_orders", buckets=4)
    bill = jobs.billing_job(spark, SF, schema="cashcast_bills", buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders, items = spark.table("cashcast_orders.salesorder"), spark.table("cashcast_orders.salesorderitem")
        heads = orders.select("SalesOrder", "SalesOrderDate", "TotalNetAmount")
        joined = items.join(heads, "SalesOrder")
        totals = items.groupBy("SalesOrder").agg(F.sum("NetAmount").alias("net")).join(heads, "SalesOrder")
        doc_items = spark.table("cashcast_bills.billingdocumentitem")
        docs = spark.table("cashcast_bills.billingdocument").select("BillingDocument", "TotalNetAmount")
        sums = B.document_totals(doc_items).withColumnRenamed("TotalNetAmount", "net").join(docs, "BillingDocument")
        for df in (joined, totals, sums):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == out["salesorderitem"] and orders.count() == out["salesorder"]
        assert totals.filter("net <> TotalNetAmount").count() == 0
        assert sums.filter("abs(net - TotalNetAmount) > 0.001").count() == 0 and doc_items.count() == bill["billingdocumentitem"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP SCHEMA cashcast_orders CASCADE")
        spark.sql("DROP SCHEMA cashcast_bills CASCADE")


def test_clone_keeps_the_structure(spark):
    """Nullability, comments and partitioning, as DESCRIBE shows them."""
    spark.sql("CREATE SCHEMA IF NOT EXISTS cashcast_clone")
    spark.sql("CREATE TABLE cashcast_clone.src (id BIGINT NOT NULL COMMENT 'the key', amount DECIMAL(12,2) COMMENT 'net', y INT) "
              "USING parquet PARTITIONED BY (y)")
    spark.sql("INSERT INTO cashcast_clone.src VALUES (1, 2.50, 2024), (2, 3.50, 2025)")
    for _ in range(2):  # again over an earlier clone
        clone_empty(spark, "cashcast_clone.src", "cashcast_clone.dst")
    describe = [spark.sql(f"DESCRIBE cashcast_clone.{t}").collect() for t in ("src", "dst")]
    assert describe[0] == describe[1] and spark.table("cashcast_clone.dst").schema == spark.table("cashcast_clone.src").schema
    assert spark.table("cashcast_clone.dst").count() == 0 and spark.table("cashcast_clone.src").count() == 2
    spark.sql("DROP SCHEMA cashcast_clone CASCADE")


def test_job_on_the_catalog(spark):
    """Schema creation, saveAsTable, and reads back through the catalog."""
    out = jobs.cash_job(spark, SF, schema="cashcast_cash")
    assert spark.table("cashcast_cash.cashflow").count() == out["cashflow"] > 0
    assert spark.table("cashcast_cash.cashflowforecast").count() == 182
    spark.sql("DROP SCHEMA cashcast_cash CASCADE")


def test_clone_empty_and_profile(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS cashcast_test")
    spark.createDataFrame([(1, "x"), (2, "y")], "id int, s string").write.mode("overwrite").saveAsTable("cashcast_test.src")
    clone_empty(spark, "cashcast_test.src", "cashcast_test.dst")
    assert spark.table("cashcast_test.dst").count() == 0
    assert spark.table("cashcast_test.dst").schema == spark.table("cashcast_test.src").schema
    r = table_profile(spark.table("cashcast_test.src"), ["id", "s"], 1).first()
    assert (r.rows, r.sample) == (2, "1/x")
