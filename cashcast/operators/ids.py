"""Sequential ids over a global order, and numbers inside a key, without funnelling rows into one partition.

A window ``row_number()`` with no PARTITION BY moves every row to a single task, and one
partitioned by a key moves a hot key's rows to one. Instead, W4 range-partitions on the
ordering, sorts inside each partition, and writes the sorted rows once, each with its
partition and its place there (``monotonically_increasing_id`` holds both), to the shared
checkpoint folder. A row's number is its place plus its partition's offset - a running sum
over a table with one row per partition, broadcast back (its size is the partition count,
not the data size). Callers number the narrow key columns and join the wide rows by key.

W5 is a window over the key, one exchange that later joins on the key use again; only keys
with more rows than a task should have take the way of W4, a segmented prefix scan that
carries their counts over the borders of the ranges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cashcast.session import store

_LOW_BITS = 33
#: A key with more rows than this, and than a partition's even share, is numbered in several ranges.
HOT_ROWS = 1_000_000
_CELLS = 1 << 16


def global_row_number(df: DataFrame, order_cols: list, out_col: str = "rn",
                      num_partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = 1-based position of each row in the order of ``order_cols``.

    ``order_cols`` must be a unique key so that the numbering is deterministic. The caller's
    cache, if any, is left alone.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = store(df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
                     .withColumn("_mid", F.monotonically_increasing_id()), "numbered")
    pid = F.shiftright("_mid", _LOW_BITS)
    counts = numbered.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(pid, _LOW_BITS)
    return (numbered.join(F.broadcast(offsets), pid == F.col("_pid"))
            .withColumn(out_col, F.col("_off") + local + F.lit(1))
            .drop("_mid", "_pid", "_off"))


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"_k_{k}"]) for k in keys])


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows and than a shuffle partition's even share of them, as
    columns ``_k_<key>``; None if there is none. So there are fewer of them than partitions.

    Rows are counted first (a Parquet table answers from its footers); then in a fixed number
    of cells by the key's hash, which bounds every key from above; keys only of cells that pass.
    """
    n = df.count()
    limit = max(hot_rows, n // int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if n <= limit:
        return None
    cell = F.pmod(F.xxhash64(*keys), F.lit(_CELLS))
    full = [r[0] for r in df.groupBy(cell.alias("cell")).count().filter(F.col("count") > limit).select("cell").collect()]
    if not full:
        return None
    counted = df.filter(cell.isin(full)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    rows = counted.filter(F.col("_n") > limit).select(*[F.col(k).alias(f"_k_{k}") for k in keys]).collect()  # below n / limit
    schema = counted.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).schema
    return df.sparkSession.createDataFrame(rows, schema) if rows else None


def rank_within(df: DataFrame, key_cols: list[str], order_cols: list[str], out_col: str = "rank",
                num_partitions: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """1-based position of each row inside its key (null is one), in the order of ``order_cols``."""
    keys, order = list(key_cols), list(order_cols)
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return df.withColumn(out_col, number)
    hot = F.broadcast(hot)  # fewer rows than partitions
    cold = df.join(hot, _same(df, hot, keys), "left_anti").withColumn(out_col, number)
    split = _segmented_rank(df.join(hot, _same(df, hot, keys), "left_semi"), keys, order, out_col, num_partitions)
    return cold.unionByName(split)


def _segmented_rank(df: DataFrame, keys: list[str], order: list[str], out_col: str, num_partitions: int | None) -> DataFrame:
    """``rank_within`` of few, long keys: places inside ranges of (key, order), and for a key that
    crosses a border the rows it has in the ranges before."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = store(df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
                   .withColumn("_mid", F.monotonically_increasing_id()), "segments")
    pid = F.shiftright("_mid", _LOW_BITS)
    # a row per key and range it is in: fewer than keys plus ranges
    parts = placed.groupBy(pid.alias("_pid"), *[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*[f"_k_{k}" for k in keys]).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = F.broadcast(parts.withColumn("_carry", F.coalesce(F.sum("_cnt").over(before), F.lit(0))))
    return (placed.join(parts, (pid == F.col("_pid")) & _same(placed, parts, keys))
            .withColumn(out_col, (F.col("_mid") - F.col("_first") + F.col("_carry") + 1).cast("int"))
            .select(*df.columns, out_col))
