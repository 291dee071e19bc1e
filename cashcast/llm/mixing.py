"""Operator 2, mixing sources to target weights: weighted fair queueing.

Every source gets a target: its weight's share of the budget, at most ``max_epochs`` times
its own size, the excess going to the other sources by weight. Each source's documents
stand in a shuffled queue (repeated for further epochs); a copy's virtual finish time is
the source's words up to and including it, divided by the source's target. All copies are
sorted by finish time over the whole corpus and taken until the budget is spent; the copy
that crosses the budget is cut.

Both running sums are split by ranges, so neither a hot source nor the global order meets
in one task: a queue is cut into ranges of the shuffle key, the global order into ranges of
virtual time. Each source sends at a steady rate in virtual time, so equal ranges of time
hold about equal numbers of words, without sampling. The shuffle key is a hash of id and text,
so rows without id spread like others; only repeated rows share a key, and a range that they
make too long is cut again, by key and by pieces of the rows of one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cashcast.session import release, store

MAX_EPOCHS = 3
#: Ranges that a queue, and the global order, are cut into; more ranges, smaller tasks.
RANGES = 4096
WORD = r"[^\x20\x09-\x0D]+"
_HEX = 3
#: A range of a queue with more rows than this, and than so many times the mean, is cut again into
#: so many pieces of each key.
HOT_ROWS = 1_000_000
HOT_TIMES = 8
PIECES = 4096


def doc_size(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, max_epochs: float = MAX_EPOCHS, budget: float | None = None) -> DataFrame:
    """Add ``target`` to rows of (source, source_size, weight).

    The level (words per weight) rises by rounds: sources above ``max_epochs`` times their
    size are held there and the rest share what is left by weight, until none is above. A
    round is one small aggregate; only two numbers come to the driver.
    """
    cap = F.col("source_size") * float(max_epochs)
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    budget = float(total) if budget is None else min(float(budget), float(max_epochs) * float(total))
    level, held = 0.0, -1
    while True:
        over = cap <= F.lit(level) * F.col("weight")
        r = sizes.agg(F.sum(F.when(over, cap).otherwise(0.0)), F.sum(F.when(over, 0).otherwise(F.col("weight"))),
                      F.sum(F.when(over, 1).otherwise(0))).first()
        fixed, weight, n = r[0] or 0.0, r[1] or 0, r[2] or 0
        if n == held or not weight:
            break
        level, held = (budget - fixed) / weight, n
    return sizes.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")) if weight else cap)


def ranked_weights(sizes: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Give the sources, by code point with null last, the weights of ``cycle`` in turn."""
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1  # one row per source
    weight = F.element_at(F.array(*[F.lit(w) for w in cycle]), (place % len(cycle) + 1).cast("int"))
    return sizes.withColumn("weight", weight)


def shuffle_key(doc_id: Column, text: Column) -> Column:
    """The place in a source's queue: 64 bits of a hash, as hex digits."""
    whole = F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    return F.substring(F.md5(whole), 1, 16)


def _cells(queue: DataFrame, hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """``queue`` with ``_sub``, the part of its range, and the words before each (source, _cut, _sub)."""
    cells = store(queue.groupBy("source", "_cut").agg(F.sum("size").alias("_sum"), F.count(F.lit(1)).alias("_n")), "mix_ranges")
    mean = cells.agg(F.avg("_n")).first()[0] or 0.0  # a row for each source and range
    so_far = lambda w: F.coalesce(F.sum("_sum").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = cells.withColumn("_before", so_far(Window.partitionBy("source").orderBy("_cut")))
    long = cells.filter(F.col("_n") > max(hot_rows, HOT_TIMES * mean)).select(
        F.col("source").alias("_source"), F.col("_cut").alias("_hot"), F.col("_before").alias("_start"))
    if long.isEmpty():
        return queue.withColumn("_sub", F.lit("")), cells.select("source", "_cut", F.lit("").alias("_sub"), "_before")
    long = F.broadcast(long)  # at most a row for every ``hot_rows`` of the queue
    at = lambda df: df["source"].eqNullSafe(F.col("_source")) & (df["_cut"] == F.col("_hot"))
    piece = F.lpad(F.pmod(F.xxhash64("row"), F.lit(PIECES)).cast("string"), 4, "0")
    cut = (queue.join(long, at(queue), "left")
           .withColumn("_sub", F.when(F.col("_hot").isNotNull(), F.concat("_key", piece)).otherwise("")))
    parts = cut.filter("_sub != ''").groupBy("source", "_cut", "_sub", "_start").agg(F.sum("size").alias("_sum"))
    parts = parts.withColumn("_before", F.col("_start") + so_far(Window.partitionBy("source", "_cut").orderBy("_sub")))
    whole = cells.join(long, at(cells), "left_anti").withColumn("_sub", F.lit(""))
    names = ["source", "_cut", "_sub", "_before"]
    return cut.drop("_source", "_hot", "_start"), whole.select(names).unionByName(parts.select(names))


def fair_queue(rows: DataFrame, sizes: DataFrame, budget: float, ranges: int = RANGES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Words taken of each row of (row, doc_id, source, size, _key).

    ``sizes`` has (source, source_size, target). Returns row and ``taken``; rows of which
    nothing is taken are left out.
    """
    # shuffle: the order of a hash, the same in every run
    cut = F.floor(F.conv(F.substring("_key", 1, _HEX), 16, 10).cast("long") * ranges / 16 ** _HEX)
    queue, sent = _cells(rows.filter("size > 0").withColumn("_cut", cut), hot_rows)
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    sent = sent.alias("q").join(sizes.alias("s"), same(sent, sizes)).filter("s.target > 0").select(
        "q.source", "q._cut", "q._sub", "q._before", "s.source_size", "s.target")
    one = same(queue, sent) & (queue["_cut"] == sent["_cut"]) & (queue["_sub"] == sent["_sub"])
    queue = queue.alias("q").join(sent.alias("s"), one).select("q.*", "s._before", "s.source_size", "s.target")
    inside = (Window.partitionBy("source", "_cut", "_sub").orderBy("_key", "doc_id", "size", "row")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    queue = queue.withColumn("_done", F.col("_before") + F.sum("size").over(inside))
    epochs = F.ceil(F.col("target") / F.col("source_size")).cast("int")
    copies = queue.withColumn("epoch", F.explode(F.sequence(F.lit(1), epochs)))
    copies = copies.withColumn("finish", (F.col("_done") + (F.col("epoch") - 1) * F.col("source_size")) / F.col("target"))
    copies = copies.withColumn("_time", F.floor(F.col("finish") * ranges)).select(
        "row", "doc_id", "source", "size", "epoch", "_key", "finish", "_time")
    stored = copies = store(copies, "mix_copies")  # read by both steps below
    # the global order, range by range of virtual time
    spent = copies.groupBy("_time").agg(F.sum("size").alias("_sum"))
    upto = Window.orderBy("_time").rowsBetween(Window.unboundedPreceding, -1)
    spent = spent.withColumn("_spent", F.coalesce(F.sum("_sum").over(upto), F.lit(0))).drop("_sum")
    spent = spent.filter(F.col("_spent") < budget)
    copies = copies.join(spent, "_time")
    order = (Window.partitionBy("_time").orderBy("finish", F.col("source").asc_nulls_last(), "_key", "doc_id", "epoch", "row")
             .rowsBetween(Window.unboundedPreceding, -1))
    at = F.col("_spent") + F.coalesce(F.sum("size").over(order), F.lit(0))
    taken = F.greatest(F.lit(0), F.least(F.col("size"), F.lit(int(round(budget))) - at))
    out = store(copies.withColumn("taken", taken).filter("taken > 0")
                .groupBy("row").agg(F.sum("taken").cast("long").alias("taken")), "mix_taken")
    release(stored)
    return out


def plan(rows: DataFrame, max_epochs: float = MAX_EPOCHS, budget: float | None = None,
         cycle: tuple[int, ...] = (1, 2, 3), ranges: int = RANGES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows of (row, doc_id, source, size, _key) with source_size, target and taken."""
    sizes = ranked_weights(rows.groupBy("source").agg(F.sum("size").alias("source_size")), cycle)
    sizes = store(targets(sizes, max_epochs, budget), "mix_targets")
    spend = sizes.agg(F.sum("target")).first()[0] or 0.0
    taken = fair_queue(rows, sizes, spend, ranges, hot_rows)
    whole = rows.alias("r").join(sizes.alias("s"), rows["source"].eqNullSafe(sizes["source"])).select(
        "r.*", "s.source_size", "s.target")
    return whole.join(taken, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))


def _columns(prefix: str = "") -> list[Column]:
    return [F.col(f"{prefix}doc_id").cast("long").alias("doc_id"), F.col(f"{prefix}source").cast("string").alias("source"),
            doc_size(F.col(f"{prefix}text").cast("string")).alias("size"),
            shuffle_key(F.col(f"{prefix}doc_id"), F.col(f"{prefix}text").cast("string")).alias("_key")]


def mixed(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken, source.

    ``docs`` needs ``doc_id``, ``text`` and ``source``; other columns are ignored, whatever
    their names. A null text has size 0 and nothing of it is taken; a null source is a source
    of its own, last in order; a source of size 0 has target 0; repeated rows are documents of
    their own, ordered by a hash of id and text, so only equal rows are interchangeable and reruns
    agree; an empty table gives no rows. Without ``budget`` all sizes together are shared.
    """
    rows = store(docs.select(F.monotonically_increasing_id().alias("row"), *_columns()), "mix_sizes")
    return plan(rows, **options).select("doc_id", "size", "source_size", "target", "taken", "source")


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mix takes, once for every copy; all columns as they are.

    A copy that the budget cuts keeps its first words, and ``n_chars``, where the table has it,
    is counted again.
    """
    whole = store(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "numbered")
    rows = store(whole.select("row", *_columns("doc.")), "mix_sizes")
    taken = plan(rows, **options).filter("taken > 0").select("row", "size", "taken")
    copies = whole.join(taken, "row").withColumn("copy", F.explode(F.sequence(F.lit(0), F.floor((F.col("taken") - 1) / F.col("size")).cast("int"))))
    words = F.least(F.col("size"), F.col("taken") - F.col("copy") * F.col("size"))
    parts = F.regexp_extract_all(F.col("doc.text"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    head = F.array_join(F.slice(parts, F.lit(1), words.cast("int")), "")
    text = F.when(words < F.col("size"), head).otherwise(F.col("doc.text"))
    new = {"text": text} | ({"n_chars": F.when(words < F.col("size"), F.char_length(text).cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("doc.n_chars"))} if "n_chars" in docs.columns else {})
    return copies.select(*[new[c].alias(c) if c in new else F.col("doc")[c].alias(c) for c in docs.columns])
