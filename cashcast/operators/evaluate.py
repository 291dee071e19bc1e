"""Forecast evaluation: future weeks (F2), naive year-over-year forecast (F10),
forecast vs actual (F7), fit metrics (F8, A10), skill vs naive (F11), series status (F9, A16)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cashcast.functions.numeric import safe_pct


def series_heads(history: DataFrame, key: str = "Material", ds: str = "week_start",
                 group: str = "MaterialGroup") -> DataFrame:
    """Per series: last week, row count, and the group of its first (earliest) row."""
    return history.groupBy(key).agg(
        F.max(ds).alias("last_week"),
        F.count(F.lit(1)).alias("training_rows"),
        F.min_by(F.col(group), F.struct(F.col(ds), F.col(group))).alias(group),
    )


def future_weeks(history: DataFrame, horizon: int, key: str = "Material", ds: str = "week_start",
                 group: str = "MaterialGroup") -> DataFrame:
    """the next ``horizon`` Mondays strictly after each series' own last week."""
    heads = series_heads(history, key, ds, group)
    spine = F.sequence(F.date_add("last_week", 7), F.date_add("last_week", 7 * horizon), F.expr("INTERVAL 7 DAYS"))
    return heads.select(key, group, F.explode(spine).alias("ds"))


def weekly_totals(history: DataFrame, key: str = "Material", ds: str = "week_start", value: str = "qty") -> DataFrame:
    """One row per series and week: the sum over the groups the series has in that week."""
    return history.groupBy(key, ds).agg(F.sum(value).alias(value))


def naive_yoy_forecast(history: DataFrame, horizon: int, key: str = "Material", ds: str = "week_start",
                       value: str = "qty", group: str = "MaterialGroup") -> DataFrame:
    """F10 (W8): each future week repeats the value of the same week 52 weeks earlier.

    A self-join on ``week - 364 days`` (not ``lag(52)``: weeks may be missing); null
    when there was no row a year earlier. A week's value is the sum over its groups.
    """
    fut = future_weeks(history, horizon, key, ds, group)
    past = weekly_totals(history, key, ds, value).select(F.col(key).alias("_k"), F.col(ds).alias("_past"), F.col(value).alias("_v"))
    j = fut.join(past, (fut[key] == past["_k"]) & (F.date_sub(fut["ds"], 364) == past["_past"]), "left")
    return j.select(key, group, "ds", F.col("_v").cast("double").alias("predicted_qty"))


def naive_in_sample(history: DataFrame, key: str = "Material", ds: str = "week_start",
                    value: str = "qty") -> DataFrame:
    """In-sample naive fit: y and the value 364 days earlier, where both exist."""
    total = weekly_totals(history, key, ds, value)
    cur = total.select(key, F.col(ds).alias("ds"), F.col(value).cast("double").alias("y"))
    past = total.select(F.col(key).alias("_k"), F.col(ds).alias("_past"), F.col(value).cast("double").alias("yhat"))
    return (cur.join(past, (cur[key] == past["_k"]) & (F.date_sub(cur["ds"], 364) == past["_past"]))
            .select(key, "ds", "y", "yhat"))


def forecast_vs_actual(forecast: DataFrame, actuals: DataFrame) -> DataFrame:
    """J6 left join of forecast rows to weekly actuals, gap and guarded percent error, ordered.

    Both date keys are compared as dates. pct_error is null when the actual is null
    or 0 (``try_divide``: plain division raises under ANSI).
    """
    f = forecast.withColumn("SalesOrderDate", F.col("SalesOrderDate").cast("date"))
    a = actuals.withColumn("SalesOrderDate", F.col("SalesOrderDate").cast("date"))
    j = f.join(a, ["SalesOrderDate", "Material", "MaterialGroup"], "left")
    gap = (F.col("actual_qty") - F.col("predicted_qty")).alias("gap_actual_vs_forecast")
    out = j.select(
        "SalesOrderDate", "Material", "MaterialGroup", "predicted_qty", "predicted_qty_lower",
        "predicted_qty_upper", F.col("actual_qty").cast("double").alias("actual_qty"), gap)
    pct = F.when(F.col("actual_qty").isNotNull(), safe_pct(F.col("gap_actual_vs_forecast"), F.col("actual_qty")))
    return out.withColumn("pct_error", pct).orderBy("Material", "SalesOrderDate")


def fit_metrics(fit: DataFrame, key: str = "Material", y: str = "y", yhat: str = "yhat") -> DataFrame:
    """F8 / A10: MAE = mean|y - yhat|; MAPE = 100 * mean(|y - yhat| / max(y, 1)); both rounded to 2."""
    err = F.abs(F.col(y) - F.col(yhat))
    return fit.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(err), 2).alias("mae"),
        F.round(F.avg(err / F.greatest(F.col(y), F.lit(1.0))) * 100, 2).alias("mape_pct"),
    )


def skill_vs_naive(model: DataFrame, naive: DataFrame, key: str = "Material") -> DataFrame:
    """model error over naive error per series (below 1 means the model beats the naive)."""
    m = model.select(key, F.col("mae").alias("model_mae"), F.col("mape_pct").alias("model_mape_pct"))
    n = naive.select(key, F.col("mae").alias("naive_mae"), F.col("mape_pct").alias("naive_mape_pct"))
    return m.join(n, key, "full").select(
        key, "model_mae", "naive_mae", "model_mape_pct", "naive_mape_pct",
        F.round(F.try_divide(F.col("model_mae"), F.col("naive_mae")), 4).alias("mae_skill"),
        (F.col("model_mae") < F.col("naive_mae")).alias("beats_naive"))


def with_min_history(history: DataFrame, min_rows: int, key: str = "Material") -> DataFrame:
    """Keep series with at least ``min_rows`` rows (count over the series window)."""
    w = Window.partitionBy(key)
    return history.withColumn("_n", F.count(F.lit(1)).over(w)).filter(F.col("_n") >= min_rows).drop("_n")


def series_status(history: DataFrame, min_rows: int, horizon: int, regressors: str,
                  key: str = "Material", ds: str = "week_start", fit_status: DataFrame | None = None,
                  listed=()) -> DataFrame:
    """per series - rows, training end, status (ok / skipped / failed) and reason, plus run parameters.

    A ``listed`` series without any history is skipped with 0 rows.

    ``fit_status`` (key, error) from the model stage turns 'ok' into 'failed' when the fit raised.
    """
    heads = history.groupBy(key).agg(F.count(F.lit(1)).alias("training_rows"), F.max(ds).alias("training_end"))
    if fit_status is not None:
        heads = heads.join(fit_status.select(key, "error"), key, "left")
    else:
        heads = heads.withColumn("error", F.lit(None).cast("string"))
    if listed:
        names = history.sparkSession.createDataFrame([(v,) for v in sorted(set(listed))], f"{key} {history.schema[key].dataType.simpleString()}")
        heads = names.join(heads, key, "full").withColumn("training_rows", F.coalesce("training_rows", F.lit(0)))
    short = F.col("training_rows") < min_rows
    return heads.select(
        key, F.col("training_rows").cast("bigint").alias("training_rows"), "training_end",
        F.when(short, "skipped").when(F.col("error").isNotNull(), "failed").otherwise("ok").alias("status"),
        F.when(short, F.format_string("only %d rows", F.col("training_rows")))
        .when(F.col("error").isNotNull(), F.col("error")).alias("reason"),
        F.lit(horizon).alias("forecast_horizon_weeks"),
        F.lit("multiplicative").alias("seasonality_mode"),
        F.lit(regressors).alias("weather_regressors"),
    )
