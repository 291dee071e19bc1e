"""one forecast model per series, fitted on the executors (grouped map), stored as a table
of coefficients and scored by column expressions.

Model form (Taylor & Letham, "Forecasting at Scale", 2018, multiplicative mode):

    y(t) = g(t) * (1 + s(t) + r(t)) + e

g is a piecewise-linear trend with ridge-penalised changepoints, s a yearly Fourier
series and r a linear term in the standardised regressors. Both halves are linear
given the other, so the fit alternates two ridge least-squares solves.

The band is yhat +/- z * sd, z the normal quantile of the interval width. The variance is that of
the residuals (over the degrees of freedom that the penalised fit leaves) plus that of trend
changes to come: as often as in the history, of the mean size of the fitted ones (the paper's
generative trend model), so a change at u moves week t by change * (t - u) and the variance
rises with the cube of the distance from the last training week.

Parallelism is across series: rows are pre-aggregated to weekly points before the
``groupBy(key).applyInPandas``, so a group holds at most one row per week of the
calendar, whatever the data volume. The grouped map returns one row per series. A series
that raises, hangs or kills its worker yields an error row instead of failing the job (F9
reports it).
"""

from __future__ import annotations

import os
import pickle
import select
import signal
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cashcast import config as C
from cashcast.functions.calendar import month_floor
from cashcast.session import ship_package, store

YEAR_DAYS = 365.25
EPOCH = "1970-01-01"
#: Seconds that the fit of one series may take.
TIME_LIMIT = 120.0

#: One row per series: what its forecasts follow from, and the run's record of the training window.
MODEL_COLUMNS = ("MaterialGroup string, training_rows long, training_end date, origin date, span_days double, scale double, "
                 "trend array<double>, changepoints array<double>, changes array<double>, season array<double>, "
                 "reg_mean array<double>, reg_scale array<double>, reg_effect array<double>, sigma double, change_scale double, "
                 "train_mae double, train_mape_pct double, error string")


@dataclass(frozen=True)
class ModelSpec:
    """Defaults follow the paper's published defaults where it gives them."""
    fourier_order: int = 10
    n_changepoints: int = 25
    changepoint_range: float = 0.8
    changepoint_penalty: float = 10.0
    seasonality_penalty: float = 0.1
    regressor_penalty: float = 0.1
    iterations: int = 25
    interval_width: float = C.INTERVAL_WIDTH


def _fourier(days: np.ndarray, order: int) -> np.ndarray:
    w = 2.0 * np.pi * days[:, None] * np.arange(1, order + 1)[None, :] / YEAR_DAYS
    return np.hstack([np.cos(w), np.sin(w)])


def _trend_design(t: np.ndarray, cps: np.ndarray) -> np.ndarray:
    return np.hstack([np.ones((len(t), 1)), t[:, None], np.maximum(t[:, None] - cps[None, :], 0.0)])


def _ridge(X: np.ndarray, y: np.ndarray, pen: np.ndarray) -> np.ndarray:
    lhs = X.T @ X + np.diag(pen)
    return np.linalg.lstsq(lhs, X.T @ y, rcond=None)[0]


def _days(ds: pd.Series, origin) -> np.ndarray:
    return (pd.to_datetime(ds) - pd.Timestamp(origin)).dt.days.to_numpy(dtype=float)


def fit_series(train: pd.DataFrame, reg_cols: list[str], spec: ModelSpec) -> dict:
    """Fit one series (ds, y, regressors); the coefficients under the names of ``MODEL_COLUMNS``."""
    origin = train["ds"].min()
    span = max((train["ds"].max() - origin).days, 1)
    t = _days(train["ds"], origin) / span
    y = train["y"].to_numpy(dtype=float)
    scale = max(float(np.abs(y).max()), 1e-9)
    ys = y / scale

    n_cp = min(spec.n_changepoints, max(len(t) - 2, 0))
    cps = np.quantile(t[t <= spec.changepoint_range], np.linspace(0, 1, n_cp + 2)[1:-1]) if n_cp else np.zeros(0)
    mu = train[reg_cols].mean().to_numpy(dtype=float)
    sd = train[reg_cols].std(ddof=0).replace(0, 1).fillna(1).to_numpy(dtype=float)
    reg = (train[reg_cols].to_numpy(dtype=float) - mu) / sd
    X = np.hstack([_fourier(_days(train["ds"], EPOCH), spec.fourier_order), reg])
    A = _trend_design(t, cps)
    pen_trend = np.r_[0.0, 0.0, np.full(len(cps), spec.changepoint_penalty)]
    pen_season = np.r_[np.full(2 * spec.fourier_order, spec.seasonality_penalty),
                       np.full(len(reg_cols), spec.regressor_penalty)]

    beta = np.zeros(X.shape[1])
    theta = _ridge(A, ys, pen_trend)
    for _ in range(spec.iterations):
        g = A @ theta
        beta = _ridge(X * g[:, None], ys - g, pen_season)
        theta = _ridge(A * (1.0 + X @ beta)[:, None], ys, pen_trend)
    fit = scale * (A @ theta) * (1.0 + X @ beta)

    # degrees of freedom of the penalised fit, linear around the solution
    J = np.hstack([A * (1.0 + X @ beta)[:, None], X * (A @ theta)[:, None]])
    lhs = J.T @ J
    used = float(np.trace(np.linalg.lstsq(lhs + np.diag(np.r_[pen_trend, pen_season]), lhs, rcond=None)[0]))
    off = np.abs(y - fit)
    sigma = float(np.sqrt((off ** 2).sum() / max(len(y) - used, 1.0)))
    order = spec.fourier_order
    return {"training_rows": len(y), "training_end": train["ds"].max(), "origin": origin, "span_days": float(span), "scale": scale,
            "trend": theta[:2], "changepoints": cps, "changes": theta[2:], "season": beta[:2 * order], "reg_mean": mu, "reg_scale": sd,
            "reg_effect": beta[2 * order:], "sigma": sigma, "change_scale": float(np.abs(theta[2:]).mean()) if len(cps) else 0.0,
            "train_mae": round(float(off.mean()), 2), "train_mape_pct": round(float((off / np.maximum(y, 1.0)).mean() * 100), 2)}


@contextmanager
def _alarm(seconds: float):
    """Raise TimeoutError in this process when the block takes longer."""
    def late(*_):
        raise TimeoutError(f"no result in {seconds:g} s")
    before = signal.signal(signal.SIGALRM, late)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        yield
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


def _in_child(work: Callable[[], dict], seconds: float) -> dict:
    """``work`` in a process of its own, so that its death, or a hang that no signal ends, is an error here."""
    out, into = os.pipe()
    pid = os.fork()
    if not pid:
        try:
            try:
                answer = (True, work())
            except Exception as exc:  # noqa: BLE001 - told to the parent
                answer = (False, f"{type(exc).__name__}: {exc}")
            with os.fdopen(into, "wb") as f:
                pickle.dump(answer, f)
        finally:
            os._exit(0)
    os.close(into)
    got = b""
    try:
        while True:
            ready, _, _ = select.select([out], [], [], seconds)
            if not ready:
                raise TimeoutError(f"no result in {seconds:g} s")
            part = os.read(out, 1 << 16)
            if not part:
                break
            got += part
    finally:
        os.close(out)
        os.kill(pid, signal.SIGKILL)
        os.waitpid(pid, 0)
    if not got:
        raise ChildProcessError("the fit's process died")
    ok, answer = pickle.loads(got)
    if not ok:
        raise RuntimeError(answer)
    return answer


def _series_model(key: str, reg_cols: list[str], spec: ModelSpec, fit, limit: float, apart: bool):
    columns = [c.split()[0] for c in MODEL_COLUMNS.split(", ")]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["ds", "MaterialGroup"]).reset_index(drop=True)
        train = pdf[pdf["is_train"]].rename(columns={f"{c}_train": c for c in reg_cols})[["ds", "y", *reg_cols]]
        row = dict.fromkeys(columns) | {key: pdf[key].iloc[0], "MaterialGroup": pdf["MaterialGroup"].iloc[0]}
        try:
            if apart:
                row |= _in_child(lambda: fit(train, reg_cols, spec), limit)
            else:
                with _alarm(limit):
                    row |= fit(train, reg_cols, spec)
        except Exception as exc:  # noqa: BLE001 - one bad series must not fail the others
            row["error"] = f"{type(exc).__name__}: {exc}"
        return pd.DataFrame([row])[[key, *columns]]

    return run


def model_input(history: DataFrame, monthly: DataFrame, horizon: int, fallback=C.WEATHER_FALLBACK,
                reg_cols=("avg_temp_c", "temp_anomaly_c"), min_rows: int = C.MIN_HISTORY_ROWS,
                key: str = "Material") -> DataFrame:
    """History (A16: series with at least ``min_rows`` rows) plus its future weeks (F2), with
    regressors filled twice as in the reference: over the training rows alone (for the fit)
    and over training + future rows (for prediction) (F3).

    A series is one ``key``; it may hold rows of several groups in a week, all of which are
    trained on, and has one future row per week under its first row's group. History and
    weather are read once: the future weeks are exploded from each series' last row, and
    both fills are windows over the one frame.
    """
    reg_cols = list(reg_cols)
    whole = Window.partitionBy(key)
    by_date = whole.orderBy("ds", "MaterialGroup")
    hist = history.select(F.col("week_start").alias("ds"), key, "MaterialGroup", F.col("qty").cast("double").alias("y"))
    hist = hist.withColumns({
        "_n": F.count(F.lit(1)).over(whole), "_first_group": F.first("MaterialGroup").over(by_date),
        "_last": F.row_number().over(whole.orderBy(F.desc("ds"), F.desc("MaterialGroup"))) == 1,
    }).filter(F.col("_n") >= min_rows)
    weeks = F.sequence(F.date_add("ds", 7), F.date_add("ds", 7 * horizon), F.expr("INTERVAL 7 DAYS"))
    future = F.transform(weeks, lambda d: F.struct(d.alias("ds"), F.col("_first_group").alias("MaterialGroup"),
                                                   F.lit(None).cast("double").alias("y"), F.lit(False).alias("is_train")))
    own = F.array(F.struct("ds", "MaterialGroup", "y", F.lit(True).alias("is_train")))
    rows = hist.select(key, F.explode(F.when(F.col("_last"), F.concat(own, future)).otherwise(own)).alias("r")).select(key, "r.*")
    m = monthly.select(F.col("month_start").alias("_month"), *reg_cols)
    joined = rows.withColumn("_month", month_floor("ds")).join(F.broadcast(m), "_month", "left").drop("_month")
    fwd = by_date.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bwd = by_date.rowsBetween(Window.currentRow, Window.unboundedFollowing)

    def filled(c: str, fb: float, only_train: bool):
        v = F.when(F.col("is_train"), F.col(c)) if only_train else F.col(c)
        out = F.coalesce(F.last(v, ignorenulls=True).over(fwd), F.first(v, ignorenulls=True).over(bwd), F.lit(float(fb)))
        return F.when(F.col("is_train"), out) if only_train else out

    out = joined.withColumns({f"{c}_full": filled(c, fb, False) for c, fb in zip(reg_cols, fallback)}
                             | {f"{c}_train": filled(c, fb, True) for c, fb in zip(reg_cols, fallback)})
    return out.drop(*reg_cols)


def fit_models(inp: DataFrame, reg_cols=("avg_temp_c", "temp_anomaly_c"), spec: ModelSpec = ModelSpec(), key: str = "Material",
               time_limit: float = TIME_LIMIT, fit=fit_series) -> DataFrame:
    """F1's models of all series of ``inp`` (see ``model_input``), a stored table of ``MODEL_COLUMNS``.

    A series beyond ``time_limit`` seconds is tried once more in a process of its own, where
    also a hang in native code ends. If a worker dies, all series run that way. What fails
    then is a row with its ``error`` and no coefficients.
    """
    ship_package(inp.sparkSession)
    schema = f"{key} {inp.schema[key].dataType.simpleString()}, {MODEL_COLUMNS}"

    def fitted(rows: DataFrame, apart: bool) -> DataFrame:
        return store(rows.groupBy(key).applyInPandas(_series_model(key, list(reg_cols), spec, fit, time_limit, apart), schema), "models")

    try:
        models = fitted(inp, apart=False)
    except (PySparkException, Py4JJavaError, OSError):  # a worker died
        return fitted(inp, apart=True)
    late = models.filter(F.col("error").startswith("TimeoutError"))
    if late.isEmpty():
        return models
    again = fitted(inp.join(late.select(key), key, "left_semi"), apart=True)
    return store(models.join(again.select(key), key, "left_anti").unionByName(again), "models")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def score(models: DataFrame, rows: DataFrame, reg_cols=("avg_temp_c", "temp_anomaly_c"), interval_width: float = C.INTERVAL_WIDTH,
          key: str = "Material", ds: str = "ds") -> DataFrame:
    """``rows`` (key, date, regressors, ...) with yhat, yhat_lower and yhat_upper of their series'
    stored model: column expressions only, so any dates can be forecast again without a fit.

    Series without a model, or with an error, are left out.
    """
    names = [c.split()[0] for c in MODEL_COLUMNS.split(", ")]
    m = models.filter(F.col("error").isNull()).select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in names])
    p = {c: F.col(f"_{c}") for c in names}
    t = F.datediff(F.col(ds), p["origin"]) / p["span_days"]
    trend = p["trend"][0] + p["trend"][1] * t + _total(F.zip_with(p["changepoints"], p["changes"], lambda at, by: by * F.greatest(t - at, F.lit(0.0))))
    day, order = F.datediff(F.col(ds), F.lit(EPOCH).cast("date")) * F.lit(2 * np.pi / YEAR_DAYS), F.size(p["season"]) / 2
    season = _total(F.transform(p["season"], lambda b, i: b * F.when(i < order, F.cos(day * (i + 1))).otherwise(F.sin(day * (i - order + 1)))))
    effect = sum((p["reg_effect"][j] * (F.col(c) - p["reg_mean"][j]) / p["reg_scale"][j] for j, c in enumerate(reg_cols)), F.lit(0.0))
    factor = F.lit(1.0) + season + effect
    ahead = F.greatest(t - 1, F.lit(0.0))
    changed = F.size(p["changes"]) * 2 * F.pow(p["change_scale"], F.lit(2.0)) * F.pow(ahead, F.lit(3.0)) / 3
    sd = F.sqrt(F.pow(p["sigma"], F.lit(2.0)) + F.pow(p["scale"] * factor, F.lit(2.0)) * changed)
    z = NormalDist().inv_cdf(0.5 + interval_width / 2.0)
    return (rows.join(m, F.col(key) == F.col("_key"))
            .withColumns({"yhat": p["scale"] * trend * factor, "_sd": sd})
            .withColumns({"yhat_lower": F.col("yhat") - z * F.col("_sd"), "yhat_upper": F.col("yhat") + z * F.col("_sd")})
            .select(*rows.columns, "yhat", "yhat_lower", "yhat_upper"))


def forecast_by_key(history: DataFrame, monthly: DataFrame, horizon: int = C.HORIZON_WEEKS,
                    fallback=C.WEATHER_FALLBACK, reg_cols=("avg_temp_c", "temp_anomaly_c"),
                    min_rows: int = C.MIN_HISTORY_ROWS, spec: ModelSpec = ModelSpec(), key: str = "Material",
                    time_limit: float = TIME_LIMIT, fit=fit_series, models: DataFrame | None = None) -> DataFrame:
    """fit and forecast every series in parallel; rows of kind 'fit' (in-sample),
    'forecast' (after each series' own last week) or 'error'. With ``models``, the table of an
    earlier ``fit_models``, nothing is fitted."""
    inp = store(model_input(history, monthly, horizon, fallback, reg_cols, min_rows, key), "model_input")
    if models is None:
        models = fit_models(inp, reg_cols, spec, key, time_limit, fit)
    used = [F.when(F.col("is_train"), F.col(f"{c}_train")).otherwise(F.col(f"{c}_full")).alias(c) for c in reg_cols]
    rows = inp.select(key, "MaterialGroup", "ds", F.when(F.col("is_train"), "fit").otherwise("forecast").alias("kind"), "y", *used)
    scored = score(models, rows, reg_cols, spec.interval_width, key).drop(*reg_cols).withColumn("error", F.lit(None).cast("string"))
    failed = models.filter(F.col("error").isNotNull()).select(key, "MaterialGroup", F.lit("error").alias("kind"), "error")
    return scored.unionByName(failed, allowMissingColumns=True)


def forecast_rows(model_out: DataFrame) -> DataFrame:
    """The forecast table of the reference: ds and yhat renamed to business names (P10)."""
    return model_out.filter(F.col("kind") == "forecast").select(
        F.col("ds").alias("SalesOrderDate"), "Material", "MaterialGroup",
        F.col("yhat").alias("predicted_qty"), F.col("yhat_lower").alias("predicted_qty_lower"),
        F.col("yhat_upper").alias("predicted_qty_upper"))


def fit_rows(model_out: DataFrame) -> DataFrame:
    """In-sample (y, yhat) pairs for F8."""
    return model_out.filter(F.col("kind") == "fit").select("Material", "ds", "y", "yhat")


def fit_errors(model_out: DataFrame) -> DataFrame:
    """Series whose fit raised: (Material, error) for F9."""
    return model_out.filter(F.col("kind") == "error").select("Material", "error")
