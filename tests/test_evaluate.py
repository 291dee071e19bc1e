import datetime as dt

from cashcast.operators import evaluate as EV


def test_forecast_vs_actual_guarded_pct(spark):
    fc = spark.createDataFrame(
        [(dt.date(2026, 1, 5), "M", "G", 100.0, None, None), (dt.date(2026, 1, 12), "M", "G", 100.0, None, None),
         (dt.date(2026, 1, 19), "M", "G", 100.0, None, None)],
        "SalesOrderDate date, Material string, MaterialGroup string, predicted_qty double, "
        "predicted_qty_lower double, predicted_qty_upper double")
    act = spark.createDataFrame([(dt.date(2026, 1, 12), "M", "G", 0), (dt.date(2026, 1, 19), "M", "G", 80)],
                                "SalesOrderDate date, Material string, MaterialGroup string, actual_qty long")
    out = {r.SalesOrderDate: (r.gap_actual_vs_forecast, r.pct_error) for r in EV.forecast_vs_actual(fc, act).collect()}
    assert out[dt.date(2026, 1, 5)] == (None, None)      # no actual
    assert out[dt.date(2026, 1, 12)] == (-100.0, None)   # actual 0: no error raised
    assert out[dt.date(2026, 1, 19)] == (-20.0, 25.0)


def test_future_weeks_per_series(spark):
    h = spark.createDataFrame([(dt.date(2025, 12, 29), "M", "G", 1), (dt.date(2025, 6, 2), "N", "G", 1)],
                              "week_start date, Material string, MaterialGroup string, qty long")
    rows = EV.future_weeks(h, 26).collect()
    m = sorted(r.ds for r in rows if r.Material == "M")
    assert len(m) == 26 and m[0] == dt.date(2026, 1, 5) and m[-1] == dt.date(2026, 6, 29)
    n = sorted(r.ds for r in rows if r.Material == "N")
    assert n[0] == dt.date(2025, 6, 9)


def test_fit_metrics(spark):
    fit = spark.createDataFrame([("M", 0.0, 1.0), ("M", 10.0, 8.0)], "Material string, y double, yhat double")
    r = EV.fit_metrics(fit).collect()[0]
    assert (r.n, r.mae, r.mape_pct) == (2, 1.5, 60.0)


def test_naive_yoy_handles_missing_weeks(spark):
    h = spark.createDataFrame(
        [(dt.date(2025, 1, 6) + dt.timedelta(weeks=k), "M", "G", k) for k in range(52) if k != 2],
        "week_start date, Material string, MaterialGroup string, qty long")
    out = {r.ds: r.predicted_qty for r in EV.naive_yoy_forecast(h, 4).collect()}
    last = dt.date(2025, 1, 6) + dt.timedelta(weeks=51)
    assert out[last + dt.timedelta(weeks=1)] == 0.0
    assert out[last + dt.timedelta(weeks=2)] == 1.0
    assert out[last + dt.timedelta(weeks=3)] is None  # a year earlier is the missing week


def test_series_status_and_min_history(spark):
    h = spark.createDataFrame([(dt.date(2025, 1, 6) + dt.timedelta(weeks=k), "A", 1) for k in range(12)]
                              + [(dt.date(2025, 1, 6), "B", 1)], "week_start date, Material string, qty long")
    st = {r.Material: (r.status, r.reason) for r in EV.series_status(h, 10, 26, "x").collect()}
    assert st == {"A": ("ok", None), "B": ("skipped", "only 1 rows")}
    assert {r.Material for r in EV.with_min_history(h, 10).collect()} == {"A"}
    err = spark.createDataFrame([("A", "ValueError: boom")], "Material string, error string")
    st = {r.Material: r.status for r in EV.series_status(h, 10, 26, "x", fit_status=err).collect()}
    assert st == {"A": "failed", "B": "skipped"}
