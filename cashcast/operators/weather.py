"""Weather: harmonic fit per station (H1), baseline (H2), anomaly (H3), extreme heat (H4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cashcast import config as C
from cashcast.functions.numeric import month_angle

_EPS = 1e-9


def _det3(a, b, c, d, e, f, g, h, i) -> Column:
    """Determinant of [[a, b, c], [d, e, f], [g, h, i]]."""
    return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)


def fit_harmonic(df: DataFrame, key: str = "station_id", month: str = "month", value: str = "avg_temp_c") -> DataFrame:
    """H1: least squares ``v = a0 + a1 cos(th) + b1 sin(th)``, ``th = 2 pi (m - 1) / 12``, per key.

    One aggregate collects the sums of the 3x3 normal equations; the system is solved
    by Cramer's rule in column expressions. Fewer than 3 distinct months make it
    singular: the coefficients are then NULL.
    """
    sums = df.filter(F.col(value).isNotNull()).groupBy(key).agg(*[e.alias(n) for n, e in _normal_sums(month, value).items()])
    return sums.select(key, *_coefficients())


def _normal_sums(month: str, value: str) -> dict[str, Column]:
    """Sums of the 3x3 normal equations over the readings that are not null."""
    th, v = month_angle(F.col(month)), F.col(value).cast("double")
    there = lambda x: F.when(v.isNotNull(), x)
    c, s = there(F.cos(th)), there(F.sin(th))
    return {"n": F.sum(there(F.lit(1.0))), "sc": F.sum(c), "ss": F.sum(s), "scc": F.sum(c * c), "scs": F.sum(c * s),
            "sss": F.sum(s * s), "sv": F.sum(v), "svc": F.sum(v * c), "svs": F.sum(v * s)}


def _coefficients() -> list[Column]:
    """a0, a1, b1 from the columns of ``_normal_sums``, by Cramer's rule."""
    n, sc, ss, scc, scs, sss, sv, svc, svs = (F.col(x) for x in ("n", "sc", "ss", "scc", "scs", "sss", "sv", "svc", "svs"))
    det = _det3(n, sc, ss, sc, scc, scs, ss, scs, sss)
    ok = F.abs(det) > F.lit(_EPS) * F.greatest(F.lit(1.0), n * n * n)

    def solve(num: Column) -> Column:
        return F.when(ok, num / det)

    return [
        solve(_det3(sv, sc, ss, svc, scc, scs, svs, scs, sss)).alias("a0"),
        solve(_det3(n, sv, ss, sc, svc, scs, ss, svs, sss)).alias("a1"),
        solve(_det3(n, sc, sv, sc, scc, svc, ss, scs, svs)).alias("b1"),
    ]


def harmonic_value(month, a0="a0", a1="a1", b1="b1") -> Column:
    """H2 kernel: a0 + a1 cos(th) + b1 sin(th)."""
    th = month_angle(month if isinstance(month, Column) else F.col(month))
    return F.col(a0) + F.col(a1) * F.cos(th) + F.col(b1) * F.sin(th)


def harmonic_baseline(df: DataFrame, coeffs: DataFrame, key: str = "station_id", month: str = "month") -> DataFrame:
    """H2: baseline by month from the per-key coefficients (one row per station)."""
    return (df.join(coeffs.select(key, "a0", "a1", "b1"), key, "left")
            .withColumn("baseline_c", harmonic_value(F.col(month)))
            .withColumn("july_baseline_c", harmonic_value(F.lit(7)))
            .drop("a0", "a1", "b1"))


def fitted_baseline(df: DataFrame, key: str = "station_id", month: str = "month", value: str = "avg_temp_c") -> DataFrame:
    """H1 + H2 on the same readings: the station's fit as sums over its rows, so the readings are
    read and dealt out once. A station's rows are as many as its months."""
    w = Window.partitionBy(key)
    own = df.columns
    return (df.select(*own, *[e.over(w).alias(n) for n, e in _normal_sums(month, value).items()])
            .select(*own, *_coefficients())
            .withColumn("baseline_c", harmonic_value(F.col(month)))
            .withColumn("july_baseline_c", harmonic_value(F.lit(7)))
            .drop("a0", "a1", "b1"))


def temperature_anomaly(with_baseline: DataFrame, trend: float = C.WARMING_TREND_PER_MONTH,
                        key: str = "station_id") -> DataFrame:
    """H3: observed - baseline - trend x months since the station's first month."""
    idx = F.col("year") * 12 + F.col("month") - 1
    first = F.min(idx).over(Window.partitionBy(key))
    return (with_baseline.withColumn("step", idx - first)
            .withColumn("anomaly_c", F.col("avg_temp_c") - F.col("baseline_c") - F.lit(trend) * F.col("step")))


def extreme_heat(with_baseline: DataFrame, windows, margin: float = C.EXTREME_HEAT_MARGIN_C) -> DataFrame:
    """H4: inside a listed (country, months, years) window AND temperature above the
    July baseline + margin (no trend added to the threshold)."""
    in_window = F.lit(False)
    for country, months, years in windows:
        in_window = in_window | ((F.col("country") == country) & F.col("month").isin(list(months))
                                 & F.col("year").isin(list(years)))
    hot = F.col("avg_temp_c") > F.col("july_baseline_c") + F.lit(margin)
    return with_baseline.withColumn("extreme_heat_flag", in_window & F.coalesce(hot, F.lit(False)))
