"""Shared tables of the operators' tests: awkward rows, and the smallest test tables."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
HAVE = os.path.exists(SF)

#: Names that operators use inside; a table that has them already must not disturb anything.
CLASHES = ["row", "n", "s", "c", "h", "size", "shard", "score", "kind", "token", "component", "taken", "target",
           "n_words", "spans", "doc", "copy", "bits", "prefix", "words", "text_hash", "label", "depth"]

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(n, seed=0):
    """n words in an order of its own for each seed."""
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[(x >> 8) % len(WORDS)] + str((x >> 16) % 50))
    return " ".join(out)


LONG = prose(60_000, 5)
PASSAGE = prose(80, 9)

ROWS = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, LONG, "en", "b"),
    (5, PASSAGE, "en", "a"), (5, PASSAGE, "en", "a"), (6, PASSAGE, "de", None), (7, "three short words", "de", "b"),
    (8, "Größe über Äpfel naïve 東京", "de", "a"), (None, "a row without an id " + prose(40, 3), "en", "a"),
    (None, None, None, None), (9, prose(30, 4) + " " + PASSAGE + " " + prose(30, 6), "en", "b"), (10, "12345 !!! 678", "en", "b"),
    (11, "same same same same same same same same same same same same", "en", "b"),
]

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())])


def awkward(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit(f"x{c}") for c in CLASHES})


def empty(spark):
    return awkward(spark).limit(0)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append(r)
    return out
