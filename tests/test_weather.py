from cashcast.operators import weather as W


def _anchors(spark):
    readings = {"COLD": {1: 0, 4: 8, 7: 24, 10: 12}, "MILD": {1: 5, 4: 10, 7: 20, 10: 17}}
    rows = [(k, m, float(v)) for k, a in readings.items() for m, v in a.items()]
    return spark.createDataFrame(rows, "station_id string, month int, avg_temp_c double")


def test_fit_harmonic_anchor_values(spark):
    out = {r.station_id: (round(r.a0, 9), round(r.a1, 9), round(r.b1, 9)) for r in W.fit_harmonic(_anchors(spark)).collect()}
    # a0 = mean, a1 = (Jan - Jul) / 2, b1 = (Apr - Oct) / 2
    assert out["COLD"] == (11.0, -12.0, -2.0)
    assert out["MILD"] == (13.0, -7.5, -3.5)


def test_fit_harmonic_singular_is_null(spark):
    df = spark.createDataFrame([("S", 1, 3.0), ("S", 7, 9.0)], "station_id string, month int, avg_temp_c double")
    r = W.fit_harmonic(df).collect()[0]
    assert (r.a0, r.a1, r.b1) == (None, None, None)


def test_baseline_anomaly_and_heat_flag(spark):
    coeffs = W.fit_harmonic(_anchors(spark))
    wx = spark.createDataFrame(
        [("COLD", "DE", 2023, 7, 30.0), ("COLD", "DE", 2023, 8, 20.0), ("COLD", "DE", 2025, 7, 30.0)],
        "station_id string, country string, year int, month int, avg_temp_c double")
    b = W.harmonic_baseline(wx, coeffs)
    flags = {(r.year, r.month): r.extreme_heat_flag
             for r in W.extreme_heat(b, [("DE", (7, 8), (2023, 2024))]).collect()}
    # July baseline of COLD = 11 + 12 = 23 (cos pi = -1); threshold 26
    assert flags == {(2023, 7): True, (2023, 8): False, (2025, 7): False}
    an = {(r.year, r.month): (r.step, round(r.anomaly_c, 6)) for r in W.temperature_anomaly(b).collect()}
    assert an[(2023, 7)] == (0, round(30.0 - 23.0, 6))
    assert an[(2025, 7)][0] == 24
