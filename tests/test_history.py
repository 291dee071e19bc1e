import datetime as dt

from pyspark.sql import functions as F

from cashcast.operators import history as H


def test_weekly_history_cutoff_nulls_and_gaps(spark):
    rows = [
        ("2025-12-31 00:00:00", "M1", "G", 5),    # last day at midnight: in
        ("2025-12-31 10:00:00", "M1", "G", 100),  # last day at 10:00: out (timestamp compare)
        ("2025-12-29 00:00:00", "M1", "G", None),  # null quantity adds 0
        ("2025-12-30 00:00:00", "M1", None, 7),    # null group dropped
        ("2025-12-08 00:00:00", "M1", "G", 3),     # week 2025-12-15 missing: not filled
        ("2025-12-22 00:00:00", "M2", "G", 9),     # not a listed material
    ]
    df = spark.createDataFrame(rows, "SalesOrderDate string, Material string, MaterialGroup string, Sum_OrderQuantity int")
    df = df.withColumn("SalesOrderDate", F.to_timestamp("SalesOrderDate"))
    out = {(r.week_start, r.Material): r.qty for r in H.weekly_history(df, "2025-12-31", ["M1"]).collect()}
    assert out == {(dt.date(2025, 12, 29), "M1"): 5, (dt.date(2025, 12, 8), "M1"): 3}


def test_weekly_actuals_straddling_week(spark):
    items = spark.createDataFrame([("1", "M1", "G", 4), ("2", "M1", "G", 6)],
                                  "SalesOrder string, Material string, MaterialGroup string, OrderQuantity int")
    orders = spark.createDataFrame([("1", dt.date(2026, 1, 1)), ("2", dt.date(2026, 1, 5))],
                                   "SalesOrder string, SalesOrderDate date")
    out = {r.SalesOrderDate: r.actual_qty for r in H.weekly_actuals(items, orders, "2025-12-31", ["M1"]).collect()}
    # 1 Jan 2026 is truncated to Monday 2025-12-29, which has no forecast row downstream
    assert out == {dt.date(2025, 12, 29): 4, dt.date(2026, 1, 5): 6}


def test_monthly_regressors_mean_over_countries(spark):
    w = spark.createDataFrame([("DE", 2024, 7, 20.0, 1.0), ("DE", 2024, 7, 22.0, 3.0), ("FR", 2024, 7, 40.0, 9.0)],
                              "country string, year int, month int, avg_temp_c double, temp_anomaly_c double")
    r = H.monthly_regressors(w, ["DE"]).collect()
    assert [(x.month_start, x.avg_temp_c, x.temp_anomaly_c) for x in r] == [(dt.date(2024, 7, 1), 21.0, 2.0)]


def test_history_profile_quartiles(spark):
    h = spark.createDataFrame([("M", float(v)) for v in (1, 2, 3, 4, 10)], "Material string, qty double")
    r = H.history_profile(h).collect()[0]
    assert (r["count"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]) == (5, 1.0, 2.0, 3.0, 4.0, 10.0)
    assert r["mean"] == 4.0


def test_split_by_date(spark):
    df = spark.createDataFrame([(dt.date(2025, 12, 31),), (dt.date(2026, 1, 1),), (dt.date(2026, 7, 1),)], "d date")
    train, complete = H.split_by_date(df, "d", "2025-12-31", "2026-06-30")
    assert train.count() == 1 and complete.count() == 2
    assert H.test_window(df, "d", "2025-12-31", "2026-06-30").count() == 1


def test_drop_partial_weeks(spark):
    rows = [("2025-12-31 00:00:00", "M1", "G", 5), ("2025-12-22 00:00:00", "M1", "G", 3)]
    df = spark.createDataFrame(rows, "SalesOrderDate string, Material string, MaterialGroup string, Sum_OrderQuantity int")
    df = df.withColumn("SalesOrderDate", F.to_timestamp("SalesOrderDate"))
    kept = {r.week_start for r in H.weekly_history(df, "2025-12-31", ["M1"], drop_partial_weeks=True).collect()}
    assert kept == {dt.date(2025, 12, 22)}   # the week of Wed 31 Dec is partial
    full = {r.week_start for r in H.weekly_history(df, "2025-12-28", ["M1"], drop_partial_weeks=True).collect()}
    assert full == {dt.date(2025, 12, 22)}   # Sunday end: nothing partial
    items = spark.createDataFrame([("1", "M1", "G", 4), ("2", "M1", "G", 6)],
                                  "SalesOrder string, Material string, MaterialGroup string, OrderQuantity int")
    orders = spark.createDataFrame([("1", dt.date(2026, 1, 1)), ("2", dt.date(2026, 1, 5))], "SalesOrder string, SalesOrderDate date")
    act = {r.SalesOrderDate for r in H.weekly_actuals(items, orders, "2025-12-31", ["M1"], drop_partial_weeks=True).collect()}
    assert act == {dt.date(2026, 1, 5)}


def test_dates_in_several_formats_and_rejects(spark):
    """Three written formats, a typed-looking null and one value that is no date."""
    rows = [("2025-01-06", 1), (" 06.01.2025", 2), ("20250106", 3), ("2025-01-06 10:30:00", 4), ("tomorrow", 5), (None, 6), ("2025-02-30", 7)]
    df = spark.createDataFrame(rows, "SalesOrderDate string, n int")
    read, rejected = H.split_dates(df, "SalesOrderDate")
    got = {r.n: r.SalesOrderDate for r in read.collect()}
    day = dt.datetime(2025, 1, 6)
    assert got == {1: day, 2: day, 3: day, 4: day.replace(hour=10, minute=30), 6: None}
    assert {r.n: r.reason for r in rejected.collect()} == {5: "SalesOrderDate: no date in 'tomorrow'", 7: "SalesOrderDate: no date in '2025-02-30'"}
    assert rejected.columns == ["SalesOrderDate", "n", "reason"] and {r.SalesOrderDate for r in rejected.collect()} == {"tomorrow", "2025-02-30"}
    typed = df.select(F.lit(dt.date(2025, 1, 6)).alias("SalesOrderDate"), "n")
    assert H.split_dates(typed, "SalesOrderDate")[1].count() == 0 and H.parsed_dates(typed, "SalesOrderDate").first()[0] == day
    feature = df.select("SalesOrderDate", F.lit("M").alias("Material"), F.lit("G").alias("MaterialGroup"),
                                                          F.col("n").alias("Sum_OrderQuantity"))
    assert [r.qty for r in H.weekly_history(feature, "2025-12-31", ["M"]).collect()] == [10]  # text is read as it is
    items = df.select(F.col("n").cast("string").alias("SalesOrder"), F.lit("M").alias("Material"), F.lit("G").alias("MaterialGroup"), F.col("n").alias("OrderQuantity"))
    orders = df.select(F.col("n").cast("string").alias("SalesOrder"), "SalesOrderDate")
    assert [r.actual_qty for r in H.weekly_actuals(items, orders, "2024-12-31", ["M"]).collect()] == [10]
