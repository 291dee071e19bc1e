"""Operator 7, language ID: language-bitmask n-gram filters.

One Bloom filter per language holds the byte n-grams that are typical of it. The filters
are bit-sliced: slot i is a bitmask with bit l set if language l's filter has its i-th bit
set, so the AND of an n-gram's few slots gives all languages that contain it at once. A
text's n-grams are looked up, every language's bits are counted, the counts are corrected
for the filter's expected false positives, and the largest decides.

N-grams are four bytes of a text in which A-Z became a-z and all other ASCII became blanks;
n-grams with a blank inside are left out. An n-gram is typical of a language if its rate
there is at least ``SHARE_OF_BEST`` of its best rate in any language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashcast.llm import textkit as tk
from cashcast.llm.learning import fold, sample_by
from cashcast.session import ship_package

#: Learning documents of each language at most (about; chosen by a hash of the id).
LEARN_DOCS = 4000
SHARE_OF_BEST = 0.3
MIN_COUNT = 5
#: log2 of the slots; hashes of an n-gram. 2^20 slots of 8 bytes for each 64 languages.
SLOT_BITS = 20
HASHES = 3
UNDETERMINED = "und"

_PLAIN = np.full(256, 0x20, np.uint8)
_PLAIN[0x61:0x7B] = np.arange(0x61, 0x7B)
_PLAIN[0x41:0x5B] = np.arange(0x61, 0x7B)
_PLAIN[0x80:] = np.arange(0x80, 0x100)


def grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram as uint32, text row) of all n-grams of a piece."""
    if len(data) < 4:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    t = _PLAIN[data].astype(np.uint32)
    g = (t[:-3] << 24) | (t[1:-2] << 16) | (t[2:-1] << 8) | t[3:]
    ok = (t[1:-2] != 0x20) & (t[2:-1] != 0x20)
    for back in (1, 2, 3):  # none crosses a text
        cut = off[1:-1] - back
        ok[cut[(cut >= 0) & (cut < len(ok))]] = False
    at = np.flatnonzero(ok)
    return g[at], np.searchsorted(off, at, "right") - 1


def _slots(g: np.ndarray) -> list[np.ndarray]:
    h = tk.mix(g.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    return [(h >> np.uint64(SLOT_BITS * k)) & np.uint64((1 << SLOT_BITS) - 1) for k in range(HASHES)]


class Filters:
    """Bit-sliced Bloom filters of all languages; one array of masks for each 64 of them."""

    def __init__(self, languages: list[str], gram: np.ndarray, lang: np.ndarray) -> None:
        self.languages = languages
        self.planes = np.zeros((len(languages) // 64 + 1, 1 << SLOT_BITS), np.uint64)
        for s in _slots(gram):
            np.bitwise_or.at(self.planes, (lang // 64, s.astype(np.int64)), np.uint64(1) << (lang % 64).astype(np.uint64))
        self.false_rate = np.array([
            float(((self.planes[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean()) ** HASHES for i in range(len(languages))])

    def hits(self, g: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        """Per text and language: n-grams that the language's filter contains, corrected."""
        slots = _slots(g)
        total = np.bincount(rows, minlength=n).astype(float)
        out = np.zeros((n, len(self.languages)))
        for p, plane in enumerate(self.planes):
            mask = plane[slots[0]]
            for s in slots[1:]:
                mask &= plane[s]
            for i in range(p * 64, min(len(self.languages), p * 64 + 64)):
                seen = np.bincount(rows[((mask >> np.uint64(i % 64)) & np.uint64(1)).astype(bool)], minlength=n)
                out[:, i] = (seen - total * self.false_rate[i]) / (1 - self.false_rate[i])
        return np.maximum(out, 0)


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lang = b.column("lang_no").to_numpy(zero_copy_only=False).astype(np.uint64)
        for i, j, data, off in tk.pieces(b.column("text")):
            g, rows = grams(data, off)
            key, n = np.unique((lang[i:j][rows] << np.uint64(32)) | g, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tk.signed(key)), pa.array(n)], ["key", "n"])


def learn(labelled: DataFrame, learn_docs: int = LEARN_DOCS) -> Filters:
    """Filters from rows of (doc_id, text, lang); null languages are left out."""
    rows = labelled.filter("lang IS NOT NULL").select("doc_id", F.col("text").cast("string"), F.col("lang").cast("string"))
    names = sorted(r[0] for r in rows.select("lang").distinct().collect())
    number = F.lit(0)
    for i, name in enumerate(names):
        number = F.when(F.col("lang") == F.lit(name), F.lit(i)).otherwise(number)
    picked = sample_by(rows, "lang", learn_docs, F.col("doc_id")).select(number.alias("lang_no"), "text")
    counts = picked.mapInArrow(_counter, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).withColumn(
        "lang_no", F.shiftright("key", 32).cast("int"))
    totals = {r[0]: r[1] for r in counts.groupBy("lang_no").agg(F.sum("n")).collect()}
    t = counts.filter(F.col("n") >= MIN_COUNT).toPandas()  # n-grams of a bounded sample
    key, lang = t["key"].to_numpy(np.int64), t["lang_no"].to_numpy(np.int64)
    gram = (key & 0xFFFFFFFF).astype(np.uint32)
    rate = t["n"].to_numpy(float) / np.array([totals.get(i, 1) for i in range(max(len(names), 1))], float)[lang]
    _, at = np.unique(gram, return_inverse=True)
    best = np.zeros(at.max() + 1 if len(at) else 0)
    np.maximum.at(best, at, rate)
    typical = rate >= SHARE_OF_BEST * best[at]
    return Filters(names, gram[typical], lang[typical])


def _has_letter(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    ascii_ = tk.byte_table((0x41, 0x5A), (0x61, 0x7A))[data]
    out = tk.per_text(ascii_, off) > 0
    rare = np.flatnonzero(~out & (tk.per_text(data >= 0x80, off) > 0))
    for r in rare:
        out[r] = any(c.isalpha() for c in data[off[r]:off[r + 1]].tobytes().decode("utf-8", "replace"))
    return out


def _predictor(spark, filters: Filters, judged: bool = False):
    """Adds lang_pred and score to batches in place of their text; if ``judged``, also n_grams and
    ``known``, the share of them that are the best language's."""
    shared = spark.sparkContext.broadcast(filters)  # 8 MB for each 64 languages, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        names = np.array([*f.languages, UNDETERMINED], object)
        for b in batches:
            for i, j, data, off in tk.pieces(b.column("text")):
                n = j - i
                g, rows = grams(data, off)
                n_grams = np.bincount(rows, minlength=n)
                if f.languages:
                    hits = f.hits(g, rows, n)
                    best, total = hits.argmax(1), hits.sum(1)
                    most = hits[np.arange(n), best]
                    score = np.where(total > 0, most / np.maximum(total, 1e-12), 0.0)
                else:
                    best, score, most = np.zeros(n, int), np.zeros(n), np.zeros(n)
                no = ~_has_letter(data, off) | (not f.languages)
                own = [c for c in b.schema.names if c != "text"]
                also = [pa.array(n_grams.astype(np.int64)), pa.array(most / np.maximum(n_grams, 1))] if judged else []
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c).slice(i, n) for c in own),
                     pa.array(names[np.where(no, len(f.languages), best)].tolist(), pa.string()),
                     pa.array(np.where(no, 0.0, np.clip(score, 0, 1))), *also],
                    [*own, "lang_pred", "score", *(["n_grams", "known"] if judged else [])])
    return run


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, lang_pred, score.

    Uses ``doc_id`` and ``text``; other columns are ignored, whatever their names. A null or
    empty text, or one without a letter, is ``und`` with score 0; so is every text if no
    language was learned; a text none of whose n-grams is known gets the first language with
    score 0, and ties go to the first by code point; repeated rows are answered each; an empty
    table gives no rows.
    """
    ship_package(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
                      F.col("text").cast("string").alias("text"))
    return own.mapInArrow(_predictor(docs.sparkSession, filters), "doc_id long, text_hash long, lang_pred string, score double")


def language_id(docs: DataFrame) -> DataFrame:
    """Learn from the learning fold of ``docs`` (doc_id, text, lang) and predict every row."""
    part = fold(F.col("doc_id"), 4)
    filters = learn(docs.filter(part != 2).select("doc_id", "text", "lang"))
    return predict(docs, filters).select("doc_id", (part == 2).alias("held_out"), "lang_pred", "score")


#: Share of a text's n-grams that the best language must contain, and n-grams under which a text is too short to tell.
MIN_KNOWN = 0.3
FEW_GRAMS = 20


def known_language(docs: DataFrame, min_known: float = MIN_KNOWN, few_grams: int = FEW_GRAMS) -> DataFrame:
    """``docs`` without the rows that are in none of the learned languages.

    These are the undetermined ones (null text, no letter, nothing learned) and those of
    ``few_grams`` n-grams or more of which the best language contains under ``min_known``. Neither
    depends on how many languages share the text's n-grams, so texts of close languages stay, and
    short texts with letters stay whatever they hold. All columns are kept as they are; the filters
    are learned from the learning fold's ``lang``.
    """
    ship_package(docs.sparkSession)
    filters = learn(docs.filter(fold(F.col("doc_id"), 4) != 2).select("doc_id", "text", "lang"))
    whole = docs.select(F.struct("*").alias("doc"), F.col("text").cast("string").alias("text"))
    schema = f"doc {whole.schema['doc'].dataType.simpleString()}, lang_pred string, score double, n_grams long, known double"
    found = whole.mapInArrow(_predictor(docs.sparkSession, filters, judged=True), schema)
    enough = (F.col("n_grams") < few_grams) | (F.col("known") >= min_known)
    return found.filter((F.col("lang_pred") != UNDETERMINED) & enough).select("doc.*")
