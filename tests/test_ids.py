from pyspark.sql import Window
from pyspark.sql import functions as F

from cashcast.operators.ids import global_row_number, hot_keys, rank_within


def test_matches_row_number_and_is_partition_independent(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"), (F.col("id") % 3).alias("j"))
    df = df.dropDuplicates(["k", "j"])
    expected = {(r.k, r.j): r.rn for r in df.withColumn(
        "rn", F.row_number().over(Window.orderBy("k", "j"))).collect()}
    for parts in (1, 3, 8):
        got = {(r.k, r.j): r.rn for r in global_row_number(df.repartition(5), ["k", "j"], num_partitions=parts).collect()}
        assert got == expected


def test_rank_within_splits_hot_and_null_keys(spark):
    # keys 0 and null are hot (a third of the rows each); the others are small
    hot = F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 37 + 1)
    df = spark.range(0, 4000).select(hot.alias("k"), (F.col("id") * 7919 % 100003).alias("o"))
    expected = {(r.k, r.o): r.rn for r in df.withColumn(
        "rn", F.row_number().over(Window.partitionBy("k").orderBy("o"))).collect()}
    for parts in (1, 4, 9):
        for hot_rows in (100, 1200, 10_000):  # all keys but the small ones are hot; none is
            got = {(r.k, r.o): r.rn for r in rank_within(df, ["k"], ["o"], "rn", parts, hot_rows).collect()}
            assert got == expected


def test_hot_keys_are_few_and_all_found(spark):
    df = spark.range(0, 4000).select(F.when(F.col("id") % 2 == 0, F.lit("a")).when(F.col("id") % 5 == 1, F.lit(None))
                                     .otherwise(F.col("id").cast("string")).alias("k"))
    assert hot_keys(df, ["k"], 5000) is None
    assert {r["_k_k"] for r in hot_keys(df, ["k"], 100).collect()} == {"a"}  # above 4,000 rows / 4 partitions
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        assert {r["_k_k"] for r in hot_keys(df, ["k"], 100).collect()} == {"a", None}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_cold_keys_take_one_exchange(spark):
    """Numbers inside a key, and a join on it afterwards, use the same exchange of the rows."""
    df = spark.range(0, 1000).select((F.col("id") % 90).alias("k"), F.col("id").alias("o"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        other = spark.range(90).select(F.col("id").alias("k"), F.lit(1).alias("v"))
        plan = rank_within(df, ["k"], ["o"]).join(other, "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning(k") == 2 and "rangepartitioning" not in plan  # one for each side


def test_caller_cache_stays(spark):
    df = spark.range(100).cache()
    df.count()
    assert global_row_number(df, ["id"]).count() == 100
    assert df.storageLevel.useMemory
    df.unpersist()


def test_empty(spark):
    assert global_row_number(spark.range(0), ["id"]).count() == 0
    assert rank_within(spark.range(0).withColumn("k", F.col("id")), ["k"], ["id"]).count() == 0
