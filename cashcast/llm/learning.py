"""Shared by the trained operators: learn/held-out split, bounded samples, array broadcasting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as an empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n).cast("int")


def sample_by(rows: DataFrame, group: str, bound: int, key: Column) -> DataFrame:
    """About ``bound`` rows of each value of ``group``, the same in every run.

    Rows are kept whose hash of ``key`` lies under the group's threshold, which follows from
    the group's row count: one small aggregate, no shuffle of the rows.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(group).count().collect()}  # one number for each label value
    pick = F.lit(False)
    part = F.pmod(F.xxhash64(key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    for value, n in sorted(counts.items(), key=lambda x: str(x[0])):
        pick = F.when(F.col(group) == F.lit(value), part < F.lit(bound / n)).otherwise(pick)
    return rows.filter(pick)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int,
                    bound: int) -> list[tuple[str, int, float]]:
    """(text, label, weight) of about ``bound`` labelled documents of each label 0 and 1.

    Ids of the held-out fold, null ids and other labels are left out; an id labelled twice has
    its larger label, rows of one id are learned once (smallest text). The weights bring the
    sample back to the shares of the labels table.
    """
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != held))
    y = y.groupBy("doc_id").agg(F.max("label").alias("label"))
    total = {r[0]: r[1] for r in y.groupBy("label").count().collect()}
    picked = sample_by(y, "label", bound, F.col("doc_id"))  # its size is the documented bound
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = own.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: r.doc_id)
    have = {v: sum(r.label == v for r in rows) for v in (0, 1)}
    n = sum(total.values())
    return [(r.text, r.label, total[r.label] / n * len(rows) / have[r.label]) for r in rows]
