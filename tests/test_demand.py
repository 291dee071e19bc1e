import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from cashcast.operators import demand as D


def test_seasonal_weight(spark):
    df = spark.createDataFrame([(7, 2023, "L001"), (7, 2023, "L004"), (7, 2023, "P001"), (1, 2024, "L001")],
                               "m int, y int, g string")
    out = [round(r.w, 6) for r in df.select(D.seasonal_weight(F.col("m"), F.col("y"), F.col("g"), 2023).alias("w")).collect()]
    assert out == [1.4, 1.2, 1.0, 0.824]


def test_weather_multiplier(spark):
    df = spark.createDataFrame([(20.0, 0.0, "L001"), (24.5, 0.0, "L001"), (27.0, 0.0, "L001"),
                                (27.0, 10.0, "L001"), (27.0, 0.0, "P001")], "t double, a double, g string")
    out = [round(r.m, 6) for r in df.select(D.weather_multiplier(F.col("t"), F.col("a"), F.col("g")).alias("m")).collect()]
    assert out == [1.0, 1.25, 1.8, 3.0, 1.24]


def test_expected_and_requested_quantity(spark):
    df = spark.createDataFrame([(10, 1.25, 1.0, Decimal("1.05")), (1, 0.1, 1.0, Decimal("1.15"))],
                               "q int, s double, w double, f decimal(6,2)")
    r = df.select(D.expected_quantity(F.col("q"), F.col("s"), F.col("w")).alias("e"),
                  D.requested_quantity(F.col("q"), F.col("f")).alias("r")).collect()
    assert [(x.e, x.r) for x in r] == [(12, 11), (1, 2)]  # 12.5 rounds half-even to 12


def test_price_surge_and_amounts(spark):
    df = spark.createDataFrame([(10.0, 7, "L001", "SMALL", 2, "EUR"), (10.0, 10, "P001", "STANDARD", 3, "USD"),
                                (10.0, 7, "P001", "ECONOMY", 1, "EUR")],
                               "base double, month int, g string, sku string, q int, ccy string")
    p = D.price_with_surge(df, "base", "month", "g", "sku")
    net, tax = D.line_amounts(F.col("q"), F.col("unit_price"), F.col("ccy"))
    out = [(float(r.unit_price), float(r.net), float(r.tax)) for r in p.select("unit_price", net.alias("net"), tax.alias("tax")).orderBy("sku").collect()]
    assert out == [(10.0, 10.0, 1.9), (10.5, 21.0, 3.99), (10.7, 32.1, 0.0)]


def test_phase_out_and_weather_lookup(spark):
    lines = spark.createDataFrame([("PROMO", dt.date(1999, 12, 31)), ("PROMO", dt.date(2000, 1, 1)), ("SMALL", dt.date(2000, 1, 1))],
                                  "Material string, SalesOrderDate date")
    kept = D.phase_out_filter(lines, [("PROMO", dt.date(2000, 1, 1))])
    assert kept.count() == 2
    orders = spark.createDataFrame([("1", dt.date(2024, 7, 3), "DE", "BY"), ("2", dt.date(2024, 7, 3), "FR", "IDF")],
                                   "SalesOrder string, SalesOrderDate date, Country string, Region string")
    wx = spark.createDataFrame([("DE", "BY", 2024, 7, 25.0, 2.0)],
                               "country string, region string, year int, month int, avg_temp_c double, temp_anomaly_c double")
    out = {r.SalesOrder: (r.avg_temp_c, r.temp_anomaly_c) for r in D.weather_lookup(orders, wx).collect()}
    assert out == {"1": (25.0, 2.0), "2": (10.0, 0.0)}
