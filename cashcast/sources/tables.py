"""Table reads, writes, schema creation, empty clones, constraints, profiles."""

from __future__ import annotations

import contextlib
import datetime as dt
import threading
from collections.abc import Iterator
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType


_SCOPE = threading.local()


@contextlib.contextmanager
def schemas_read_once() -> Iterator[None]:
    """Inside, a folder's schema is inferred by its first read only: each inference is a Spark job.
    Every read still lists the files anew and is a scan of its own."""
    outer, _SCOPE.schemas = getattr(_SCOPE, "schemas", None), {}
    try:
        yield
    finally:
        _SCOPE.schemas = outer


def read_table(spark: SparkSession, name: str, sf_dir: str | None = None) -> DataFrame:
    """Full scan of a catalog table, or of ``{sf_dir}/{name}.parquet`` when a folder is given.

    Scans stay lazy, so column pruning and filter pushdown reach the parquet reader.
    """
    if sf_dir is None:
        return spark.table(name)
    path, known = f"{sf_dir}/{name}.parquet", getattr(_SCOPE, "schemas", None)
    if known is None:
        return spark.read.parquet(path)
    if (id(spark), path) in known:
        return spark.read.schema(known[id(spark), path]).parquet(path)
    df = spark.read.parquet(path)
    known[id(spark), path] = df.schema
    return df


def ensure_schema(spark: SparkSession, schema: str) -> None:
    """Create the namespace when missing."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


def write_table(df: DataFrame, name: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, path: str | None = None,
                bucket_by: tuple[int, list[str]] | None = None) -> None:
    """S3: overwrite with schema replacement. ``path`` writes files instead of a catalog table.

    ``bucket_by`` (buckets, columns) lays a catalog table out by a key: tables that are bucketed
    alike join and aggregate on it without an exchange. Rows are dealt by the same hash before
    the write, so a bucket is one sorted file. All rows of a key are in one bucket: choose keys
    that no large share of the rows has, as ids have none.
    """
    if bucket_by:
        if path is not None:
            raise ValueError("buckets are kept by the catalog: no path")
        df = df.repartition(bucket_by[0], *bucket_by[1])
    writer = df.write.format(fmt).mode(mode).option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(bucket_by[0], *bucket_by[1]).sortBy(*bucket_by[1])
    if path is not None:
        writer.save(path)
    else:
        writer.saveAsTable(name)


def clone_empty(spark: SparkSession, src: str, dst: str) -> None:
    """An empty table ``dst`` with the structure of ``src``, replacing an earlier clone: columns
    with their nullability and comments, partitioning, buckets and format, by catalog DDL.
    ``src`` is only read."""
    spark.sql(f"DROP TABLE IF EXISTS {dst}")
    spark.sql(f"CREATE TABLE {dst} LIKE {src}")


def with_required(df: DataFrame, required: list[str]) -> DataFrame:
    """Enforce NOT NULL on key columns at write time.

    A null key fails the job (``raise_error``) instead of silently writing the row, and the
    column's type says that it holds no null; uniqueness is checked by V10 before the write.
    """
    def checked(c: str) -> Column:
        value = F.when(F.col(c).isNull(), F.raise_error(F.lit(f"null value in required column {c}"))).otherwise(F.col(c))
        # never reached, but it makes the column's type one without nulls
        return F.coalesce(value, _zero(df.schema[c].dataType))

    return df.withColumns({c: checked(c) for c in required})


def _zero(kind: DataType) -> Column:
    """A non-null literal of a key column's type."""
    values = {"date": dt.date(1970, 1, 1), "timestamp": dt.datetime(1970, 1, 1), "boolean": False, "string": "", "double": 0.0}
    if kind.typeName() in values:
        return F.lit(values[kind.typeName()])
    if isinstance(kind, DecimalType):
        return F.lit(Decimal(0).scaleb(-kind.scale))
    return F.lit(0).cast(kind)


def table_profile(df: DataFrame, key: list[str], n: int = 3) -> DataFrame:
    """One row with the row count and a sample, the first ``n`` rows by key (their keys,
    parts joined by '/', rows by ';'). The sample is a top-n, never the whole table."""
    first = df.select(F.concat_ws("/", *[F.col(k).cast("string") for k in key]).alias("k")).orderBy("k").limit(n)
    sample = first.agg(F.array_join(F.array_sort(F.collect_list("k")), ";"))
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("sample", sample.scalar())
