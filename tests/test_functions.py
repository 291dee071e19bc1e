import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from cashcast.functions import calendar as K
from cashcast.functions import numeric as N


def test_calendar(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 12, 31, 10, 0), 2024, 7)], "ts timestamp, y int, m int")
    r = df.select(
        K.week_start("ts").alias("w"), K.month_start_from_parts("y", "m").alias("ms"), K.month_floor("ts").alias("mf"),
        K.iso_week(F.lit(dt.date(2026, 1, 1))).alias("iw1"), K.iso_week(F.lit(dt.date(2023, 1, 1))).alias("iw2"),
        K.season(F.lit(12)).alias("s"),
        K.fiscal_year(F.lit(dt.date(2025, 3, 4))).alias("fy"), K.fiscal_period(F.lit(dt.date(2025, 3, 4))).alias("fp"),
    ).first()
    assert r.w == dt.date(2025, 12, 29)          # Monday
    assert (r.ms, r.mf) == (dt.date(2024, 7, 1), dt.date(2025, 12, 1))
    assert (r.iw1, r.iw2) == (1, 52)
    assert r.s == "winter"
    assert (r.fy, r.fp) == ("2025", "03")


def test_numeric(spark):
    df = spark.createDataFrame([(Decimal("2.5"), 1000000, -20.0, 0.0, 80.0)], "d decimal(10,2), n long, g double, z double, a double")
    r = df.select(
        N.clamp(F.lit(500), 1, 180).alias("c"),
        N.padded_id("BD-", "n").alias("id"), N.padded(F.lit(10)).alias("p"),
        N.safe_pct("g", "z").alias("p0"), N.safe_pct("g", "a").alias("p1"),
        F.round(F.cos(N.month_angle(F.lit(7))), 9).alias("cos7"),
    ).first()
    assert r.c == 180
    assert r.id == "BD-1000000" and r.p == "000010"   # wide numbers are never truncated
    assert r.p0 is None and r.p1 == 25.0
    assert r.cos7 == -1.0


def test_exact_mean_is_order_free(spark):
    vals = [0.1, 0.2, 0.3, 10.07, -3.33] * 40
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    a = df.repartition(1).agg(N.exact_mean("v").alias("m")).first().m
    b = df.repartition(7).agg(N.exact_mean("v").alias("m")).first().m
    assert a == b == float(sum(Decimal(str(v)) for v in vals)) / len(vals)
