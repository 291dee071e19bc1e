"""Operator 4, sharding: extendible hashing, in DataFrame operations only.

A document's key is 64 hash bits of its id and text. The directory starts with one bucket
of depth 0; only buckets above the byte limit split on the next bit, until all fit. Depths
are settled eight bits a round from byte sums per prefix, so the directory of any size
takes a few rounds over a narrow table of (bits, bytes), and hot prefixes are partial sums.

A bucket of one single key (rows equal in id and text) cannot split on any bit: it gets
overflow pages, filled separately for each input partition so that the rows of one key
never meet in one task. One text above the limit is a shard of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cashcast.session import broadcast_if_small, release, store

#: Bytes of text in a shard at most.
SHARD_BYTES = 64 << 20
KEY_BITS = 64
STEP = 8


def key_bits(doc_id: Column, text: Column) -> Column:
    """64 hash bits as a string of 0 and 1."""
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), F.coalesce(text.cast("string"), F.lit("")))
    return F.lpad(F.conv(F.substring(F.md5(whole), 1, KEY_BITS // 4), 16, 2), KEY_BITS, "0")


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text.cast("string")), F.lit(0)).cast("long")


def directory(keys: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """(prefix, depth, shard_bytes, shard_docs, single) of every bucket, from (bits, n_bytes).

    ``single`` marks a bucket above the limit that holds one key.
    """
    parts, cells_of, rows, depth = [], [], keys, 0
    while True:
        cell = F.substring("bits", 1, depth + STEP)
        cells = rows.groupBy(cell.alias("cell")).agg(
            F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("docs"),
            F.min("bits").alias("low"), F.max("bits").alias("high"))
        fits = F.lit(None)
        for d in range(depth + STEP, depth - bool(not depth), -1):  # the smallest depth that fits wins
            w = Window.partitionBy(F.substring("cell", 1, d) if d else F.lit(""))  # at most 2^STEP cells
            own = F.struct(F.lit(d).alias("depth"), F.sum("bytes").over(w).alias("bytes"), F.sum("docs").over(w).alias("docs"),
                           (F.min("low").over(w) == F.max("high").over(w)).alias("single"))
            fits = F.when((own["bytes"] <= limit) | own["single"], own).otherwise(fits)
        settled = store(cells.select("cell", fits.alias("b")), "shard_cells")
        cells_of.append(settled)
        parts.append(settled.filter("b IS NOT NULL").select(
            F.expr("substring(cell, 1, b.depth)").alias("prefix"), F.col("b.depth").alias("depth"),
            F.col("b.bytes").alias("shard_bytes"), F.col("b.docs").alias("shard_docs"),
            (F.col("b.single") & (F.col("b.bytes") > limit)).alias("single")).distinct())
        open_ = settled.filter("b IS NULL").select("cell")
        depth += STEP
        if depth >= KEY_BITS or open_.isEmpty():
            break
        rows = keys.join(open_, F.substring("bits", 1, depth) == F.col("cell"), "left_semi")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = store(out, "shard_directory")
    release(*cells_of)
    return out


def assign(rows: DataFrame, buckets: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """Join rows of (row, bits, n_bytes, ...) with their bucket and name their shard.

    The directory has one slot for each prefix of the global depth; a bucket of smaller
    depth owns several slots, as far as they are in use.
    """
    depths = sorted(r[0] for r in buckets.select("depth").distinct().collect())  # at most KEY_BITS + 1 numbers
    top = depths[-1] if depths else 0
    slot = F.substring("bits", 1, top) if top else F.lit("")
    # every slot in use asks for its prefixes of the depths that occur
    asked = rows.select(slot.alias("slot")).distinct().withColumn("depth", F.explode(F.array(*[F.lit(d) for d in depths or [0]])))
    slots = broadcast_if_small(asked.withColumn("prefix", F.expr("substring(slot, 1, depth)")).join(buckets, ["prefix", "depth"]))
    placed = rows.withColumn("slot", slot).join(slots, "slot").drop("slot")
    named = F.concat(F.lit("b"), "prefix")
    if buckets.filter("single").isEmpty():
        return placed.withColumn("shard", named).drop("single")
    # overflow pages of single-key buckets, by input partition; other buckets are one page
    part = F.shiftright("row", 33)
    per_page = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.col("n_bytes"), F.lit(1))))
    one = placed.filter(~F.col("single")).withColumn("shard", named)
    w = Window.partitionBy("bits", part).orderBy("row")
    many = placed.filter("single").withColumn("shard", F.concat(
        named, F.lit("-"), part.cast("string"), F.lit("-"),
        F.floor((F.row_number().over(w) - 1) / per_page).cast("string")))
    return one.unionByName(many).drop("single")


def shard_keys(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n_bytes, bits) of every row, written once."""
    return store(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        text_bytes(F.col("text")).alias("n_bytes"), key_bits(F.col("doc_id"), F.col("text")).alias("bits")), "shard_keys")


def shard(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, shard, depth, shard_bytes, shard_docs.

    Uses ``doc_id`` and ``text``; other columns are ignored, whatever their names. A null text
    is empty (0 bytes), a null id counts as an empty one; a text above the limit is a shard of
    its own; rows equal in id and text share a key and go to overflow pages if they exceed the
    limit together (``shard_bytes`` then is the whole key's); an empty table gives no rows.
    """
    keys = shard_keys(docs)
    return assign(keys, directory(keys, limit), limit).select(
        "doc_id", "n_bytes", "shard", F.col("depth").cast("long").alias("depth"), "shard_bytes", "shard_docs")


def sharded(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """``docs`` with a last column ``shard`` (an input column of that name is replaced).

    The text is not shuffled unless the directory is too large for Spark to broadcast.
    """
    inner = docs.select(
        F.struct(*[docs[c] for c in docs.columns if c != "shard"]).alias("doc"),
        F.monotonically_increasing_id().alias("row"), text_bytes(docs["text"]).alias("n_bytes"),
        key_bits(docs["doc_id"], docs["text"]).alias("bits"))
    buckets = directory(inner.select("bits", "n_bytes"), limit)
    return assign(inner, buckets, limit).select("doc.*", "shard")
