"""Shared by the joining operators: connected components and fixed-size Bloom filters."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashcast.session import release, store


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the undirected edges (a, b); component is the least node.

    Labels sink to the smallest of the neighbours' and jump to their label's label, so long
    chains halve each round. Every round is two equi-joins on tables written to the shared
    folder; nothing but the number of changed labels comes to the driver.
    """
    both = store(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = store(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "component"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")))
        step = labels.join(near, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("up"))
        jump = labels.select(F.col("node").alias("up"), F.col("component").alias("over"))
        new = store(step.join(jump, "up").select("node", F.least("up", "over").alias("component"),
                                                 (F.least("up", "over") != F.col("old")).alias("changed")), "labels")
        done = new.filter("changed").isEmpty()
        release(labels)
        labels = new
        if done:
            release(both)
            return labels.select("node", "component")


class Bloom:
    """Bloom filter of fixed size over 64-bit keys, built from a table without collecting its keys."""

    BITS = 23
    PROBES = 3

    def __init__(self, keys: DataFrame, key: Column) -> None:
        h = F.xxhash64(key)
        slots = F.array(*[F.shiftright(h, 20 * k).bitwiseAND((1 << self.BITS) - 1) for k in range(self.PROBES)])
        words = keys.select(F.explode(slots).alias("slot")).groupBy(F.shiftright("slot", 5).cast("int").alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, CAST(slot & 31 AS INT))")).alias("bits"))
        self.words = np.zeros(1 << (self.BITS - 5), np.int64)
        t = words.toPandas()  # 2^18 words at most, whatever the table
        self.words[t["word"].to_numpy(np.int64)] = t["bits"].to_numpy(np.int64)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """For xxhash64 values of keys (computed by Spark): may the key be in the table?"""
        out = np.ones(len(hashes), bool)
        for k in range(self.PROBES):
            slot = (hashes >> (20 * k)) & ((1 << self.BITS) - 1)
            out &= ((self.words[slot >> 5] >> (slot & 31)) & 1).astype(bool)
        return out
