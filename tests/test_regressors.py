import datetime as dt

from cashcast.operators.regressors import attach_regressors


def test_fill_order_backward_forward_fallback(spark):
    weeks = [dt.date(2024, m, 1) for m in (1, 2, 3, 4, 5)]
    df = spark.createDataFrame([(d, "M") for d in weeks] + [(dt.date(2024, 1, 1), "Z")], "ds date, Material string")
    # months 1 (start), 3 (middle) and 5 (end) are missing
    monthly = spark.createDataFrame([(dt.date(2024, 2, 1), 12.0, 1.0), (dt.date(2024, 4, 1), 14.0, 2.0)],
                                    "month_start date, avg_temp_c double, temp_anomaly_c double")
    out = {(r.Material, r.ds): (r.avg_temp_c, r.temp_anomaly_c)
           for r in attach_regressors(df, monthly, fallback=(10.0, 0.0)).collect()}
    assert out[("M", weeks[0])] == (12.0, 1.0)   # backward
    assert out[("M", weeks[2])] == (12.0, 1.0)   # forward
    assert out[("M", weeks[4])] == (14.0, 2.0)   # forward
    # series "Z" is on a month that exists only in series M's months? no: Jan is missing -> fallback
    assert out[("Z", dt.date(2024, 1, 1))] == (10.0, 0.0)
