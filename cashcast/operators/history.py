"""Demand history: daily feature (A17), weekly history (F5, A1), weekly actuals (F6, A2),
monthly weather regressors (F4, A3), date split (F12), profiles (A8, A9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashcast.functions.calendar import month_start_from_parts, week_start
from cashcast.functions.numeric import exact_mean


def _end_ts(end) -> Column:
    """The training end as a timestamp literal; '1999-12-31' means midnight of that day."""
    return F.lit(str(end)).cast("timestamp")


#: How dates are written that are not typed.
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd.MM.yyyy", "yyyyMMdd")


def as_timestamp(df: DataFrame, column: str, formats=DATE_FORMATS) -> Column:
    """``column`` as a timestamp by the first of the formats that reads it; null where none
    does, never an error. A typed column is only cast, so its filters reach the scan."""
    if df.schema[column].dataType.typeName() != "string":
        return F.col(column).cast("timestamp")
    text = F.trim(F.col(column))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def parsed_dates(df: DataFrame, column: str, formats=DATE_FORMATS) -> DataFrame:
    """``df`` with ``column`` as a timestamp (``as_timestamp``)."""
    return df.withColumn(column, as_timestamp(df, column, formats))


def split_dates(df: DataFrame, column: str, formats=DATE_FORMATS) -> tuple[DataFrame, DataFrame]:
    """(rows whose date is null or read, rejected rows as they are with a ``reason``), for a
    side table; both are filters over one scan each, nothing is collected."""
    raw = "_raw_date"
    read = parsed_dates(df.withColumn(raw, F.col(column)), column, formats)
    bad = F.col(raw).isNotNull() & F.col(column).isNull()
    reason = F.concat(F.lit(f"{column}: no date in '"), F.col(raw).cast("string"), F.lit("'"))
    rejected = read.filter(bad).withColumn("reason", reason).withColumn(column, F.col(raw)).drop(raw)
    return read.filter(~bad).drop(raw), rejected


def daily_feature(lines: DataFrame) -> DataFrame:
    """Order quantity per (date, material, group) - the material-level feature table."""
    return (lines.groupBy("SalesOrderDate", "Material", "MaterialGroup")
            .agg(F.sum("OrderQuantity").alias("Sum_OrderQuantity")))


def _partial_week_start(end) -> Column:
    """Monday of the week that contains ``end`` when that week runs past ``end``."""
    d = F.lit(str(end)).cast("date")
    return F.when(F.dayofweek(d) != 1, week_start(d))  # dayofweek: 1 = Sunday


def weekly_history(feature: DataFrame, end, materials, drop_partial_weeks: bool = False) -> DataFrame:
    """P2-P5 + A1.

    Rows up to ``end`` (compared as a timestamp, so a row at 10:00 on the last day is
    out), for the listed materials, summed per (Monday, material, group). Null group
    keys and dates that cannot be read (``split_dates`` has them) are dropped, null quantities add 0, and missing weeks stay missing.
    The last week is cut by ``end`` unless ``end`` is a Sunday; ``drop_partial_weeks``
    leaves that week out (the default keeps it, as the original does).
    """
    ts = as_timestamp(feature, "SalesOrderDate")
    out = (feature
            .filter(ts <= _end_ts(end))
            .filter(F.col("Material").isin(list(materials)))
            .filter(F.col("Material").isNotNull() & F.col("MaterialGroup").isNotNull())
            .groupBy(week_start(ts).alias("week_start"), "Material", "MaterialGroup")
            .agg(F.coalesce(F.sum("Sum_OrderQuantity"), F.lit(0)).cast("bigint").alias("qty")))
    if drop_partial_weeks:
        out = out.filter(F.coalesce(F.col("week_start") != _partial_week_start(end), F.lit(True)))
    return out


def weekly_actuals(items: DataFrame, orders: DataFrame, end, materials, drop_partial_weeks: bool = False,
                   key: str = "SalesOrder") -> DataFrame:
    """J1 + P4 + P5 + A2 - order quantity per week after the training end.

    Orders of the days after ``end`` in a week that started before it land on that
    week's Monday (which has no forecast row); ``drop_partial_weeks`` leaves it out."""
    hdr = orders.select(key, as_timestamp(orders, "SalesOrderDate").alias("_ts"))
    out = (items.select(key, "Material", "MaterialGroup", "OrderQuantity")
            .join(hdr, key)
            .filter(F.col("_ts") > _end_ts(end))
            .filter(F.col("Material").isin(list(materials)))
            .groupBy(week_start("_ts").alias("SalesOrderDate"), "MaterialGroup", "Material")
            .agg(F.sum("OrderQuantity").cast("bigint").alias("actual_qty")))
    if drop_partial_weeks:
        out = out.filter(F.coalesce(F.col("SalesOrderDate") != _partial_week_start(end), F.lit(True)))
    return out


def monthly_regressors(weather: DataFrame, countries) -> DataFrame:
    """P5 + A3 + X2 - mean temperature and anomaly per calendar month over the countries.

    Readings carry two decimals, so each mean is an exact decimal sum over the count:
    the same value however the rows are split over partitions. Nulls are skipped.
    """
    return (weather.filter(F.col("country").isin(list(countries)))
            .groupBy("year", "month")
            .agg(exact_mean("avg_temp_c", 12).alias("avg_temp_c"), exact_mean("temp_anomaly_c", 12).alias("temp_anomaly_c"))
            .select(month_start_from_parts("year", "month").alias("month_start"), "avg_temp_c", "temp_anomaly_c"))


def split_by_date(df: DataFrame, date_col: str, train_end, test_end) -> tuple[DataFrame, DataFrame]:
    """(train, complete) by date only. train: date <= train_end; complete: date <= test_end."""
    d = F.col(date_col).cast("date")
    return (df.filter(d <= F.lit(str(train_end)).cast("date")),
            df.filter(d <= F.lit(str(test_end)).cast("date")))


def test_window(df: DataFrame, date_col: str, train_end, test_end) -> DataFrame:
    """Rows strictly after the training end and up to the test end."""
    d = F.col(date_col).cast("date")
    return df.filter((d > F.lit(str(train_end)).cast("date")) & (d <= F.lit(str(test_end)).cast("date")))


def history_profile(history: DataFrame, key: str = "Material", value: str = "qty") -> DataFrame:
    """Count, mean, std, min, quartiles, max per series, rounded half-even to 0 digits.

    Quartiles use linear interpolation (``percentile``), like a pandas describe.
    The series are pre-aggregated weekly rows, so each group is small.
    """
    v = F.col(value).cast("double")
    q = F.percentile(v, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    agg = history.groupBy(key).agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), q.alias("_q"), F.max(v).alias("max"))
    return agg.select(
        key, F.col("count").cast("bigint").alias("count"),
        *[F.bround(F.col(c), 0).alias(c) for c in ("mean", "std", "min")],
        F.bround(F.col("_q")[0], 0).alias("p25"), F.bround(F.col("_q")[1], 0).alias("p50"),
        F.bround(F.col("_q")[2], 0).alias("p75"), F.bround(F.col("max"), 0).alias("max"))


def run_summary(history: DataFrame, date_col: str = "week_start", key: str = "Material") -> DataFrame:
    """Rows, first and last date, series count, rows per series (integer division), sorted keys."""
    return history.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(date_col).alias("first_date"),
        F.max(date_col).alias("last_date"),
        F.countDistinct(key).alias("series"),
    ).select(
        "rows", "first_date", "last_date", "series",
        F.when(F.col("series") > 0, F.floor(F.col("rows") / F.col("series"))).cast("bigint").alias("rows_per_series"),
    )


def sorted_keys(history: DataFrame, key: str = "Material") -> DataFrame:
    """Sorted distinct list of series keys (one row per key)."""
    return history.select(key).distinct().orderBy(key)
