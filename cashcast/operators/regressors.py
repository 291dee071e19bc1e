"""attach monthly regressors to a weekly series (J4 + W1 + W2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cashcast.functions.calendar import month_floor


def attach_regressors(df: DataFrame, monthly: DataFrame, cols=("avg_temp_c", "temp_anomaly_c"),
                      fallback=(10.0, 0.0), key: str = "Material", ds: str = "ds",
                      order_extra: tuple[str, ...] = ()) -> DataFrame:
    """Join each row to the regressors of its calendar month, then fill gaps per series.

    Order of fills, per column: last known value going forward in the series (W1),
    then the first known value after it (W2), then the fallback constant.
    ``monthly`` has one row per calendar month, so its size is bounded by the
    calendar and it is broadcast; the fill windows run per series over weekly rows.
    """
    cols = list(cols)
    m = monthly.select(F.col("month_start").alias("_month"), *cols)
    joined = df.withColumn("_month", month_floor(ds)).join(F.broadcast(m), "_month", "left").drop("_month")
    order = [F.col(ds), *[F.col(c) for c in order_extra]]
    fwd = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bwd = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    out = joined
    for c, fb in zip(cols, fallback):
        out = out.withColumn(c, F.coalesce(F.last(c, ignorenulls=True).over(fwd),
                                           F.first(c, ignorenulls=True).over(bwd),
                                           F.lit(float(fb))))
    return out
