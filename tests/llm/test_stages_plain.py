"""Stages of the pipeline against plain versions, sharding where buckets split, many languages."""

import os
import random
import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from cashcast.llm import language, mixing, sharding
from cashcast.llm.decontamination import WINDOW
from cashcast.llm.oracle import OP2, OP4
from cashcast.session import store
from tests.llm.cases import HAVE, SF

LOW = {i: i + 32 for i in range(65, 91)}
tables = pytest.mark.skipif(not HAVE, reason="test tables not present")


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[i:i + n]) for i in range(max(len(w) - n, 0) + 1)} if w else set()


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def first_of_each_group(docs):
    """Ids kept of (id, text): the smallest of each component of pairs of similarity 0.8 or more."""
    sets = {d: shingles(t, corpus_pipeline.SHINGLE) for d, t in docs}
    ids = sorted(d for d in sets if sets[d])
    label = {d: d for d in ids}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if min(len(x), len(y)) * 100 >= corpus_pipeline.PERCENT * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= corpus_pipeline.PERCENT * (len(x) + len(y) - both):
                    r, s = sorted((root(a), root(b)))
                    label[s] = r
    return {d for d in sets if not sets[d] or root(d) == d}


def uncontaminated(docs, items):
    windows = set()
    for t in items:
        w = words(t)
        windows |= {tuple(w[i:i + WINDOW]) for i in range(max(len(w) - WINDOW, 0) + 1)} if w else set()
    sizes = {len(g) for g in windows}
    return {d for d, t in docs if not any(tuple(w[i:i + n]) in windows for w in [words(t)] for n in sizes for i in range(len(w) - n + 1))}


@tables
def test_stages_keep_what_plain_versions_keep(spark):
    stages = dict(corpus_pipeline.STAGES)
    read = lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    docs = spark.read.parquet(f"{SF}/documents.parquet")

    known = store(stages["language_id"](spark, docs, SF), "known")
    kept, lang = {d for d, _ in read(known)}, {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    letters = {d for d, (_, t) in lang.items() if any(c.isalpha() for c in t or "")}
    prose = {d for d in letters if len(words(lang[d][1])) >= 20}
    assert kept <= letters and len(prose - kept) <= 0.02 * len(prose)  # clean documents stay

    alone = store(stages["ngram_join"](spark, known, SF), "alone")
    assert {d for d, _ in read(alone)} == first_of_each_group(read(known))

    clean = store(stages["decontaminate"](spark, alone, SF), "clean")
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {d for d, _ in read(clean)} == uncontaminated(read(alone), items)

    mixed = stages["mix"](spark, clean, SF)
    con = duckdb.connect()
    con.register("documents", clean.toPandas())
    taken = {r[0]: r[1] for r in con.execute(f"SELECT doc_id, taken FROM ({OP2})").fetchall() if r[1]}
    got = Counter()
    for d, t in read(mixed):
        got[d] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert got == taken

    last = stages["shard"](spark, mixed, SF)
    assert sorted(map(str, read(last))) == sorted(map(str, read(mixed)))


@pytest.mark.parametrize("hot_rows", [1_000_000, 100, 0])
def test_mixing_like_its_twin_with_hot_ids(spark, hot_rows, monkeypatch):
    """A third of the rows without id, a third one row again and again, whether or not ranges are cut again."""
    monkeypatch.setattr(mixing, "HOT_TIMES", 0 if hot_rows == 0 else 2)
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choices(["a", "bc", "def", "x"], k=n))
    rows = [(None, text(rng.randint(1, 30)), rng.choice(["s", None])) for _ in range(1000)]
    rows += [(7, "the same row", "s")] * 1000 + [(None, None, "s")] * 20
    rows += [(i % 300, text(rng.randint(0, 9)), rng.choice(["s", "t", "u", None])) for i in range(1000)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    names = [c[0] for c in con.execute(f"DESCRIBE {OP2}").fetchall()]
    plain = lambda r: tuple(round(v, 6) if isinstance(v, float) else v for v in r)
    expected = Counter(map(plain, con.execute(OP2).fetchall()))
    got = Counter(plain(r[n] for n in names) for r in mixing.mixed(docs.repartition(7), hot_rows=hot_rows).collect())
    assert got == expected


@pytest.mark.parametrize("rows, limit, deep", [(3000, 60, 9), (400, 3000, 1)])
def test_sharding_like_its_twin_where_buckets_split(spark, rows, limit, deep):
    """Thousands of shards, more bits than one round settles, and shards of many documents."""
    rng = random.Random(rows)
    docs = [(i, "x" * rng.randint(1, 20) if i % 7 else None) for i in range(rows)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    con = duckdb.connect()
    con.register("documents", frame.toPandas())
    twin = OP4.replace(str(sharding.SHARD_BYTES), str(limit))
    names = [c[0] for c in con.execute(f"DESCRIBE {twin}").fetchall()]
    expected = sorted(con.execute(twin).fetchall())
    got = sharding.shard(frame, limit)
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == expected
    assert max(r.depth for r in got.collect()) >= deep and got.select("shard").distinct().count() >= 2


def test_more_languages_than_a_mask_has_bits(spark):
    """70 languages of own syllables, some shared by all."""
    rng = random.Random(3)
    shared = ["ka", "to", "mi"]
    langs = {f"l{k:02d}": [a + b + c for a, b, c in zip(rng.choices("bcdfghjklmnpqrstvwxz", k=12), rng.choices("aeiouy", k=12), rng.choices("bdgklmnprst", k=12))]
             for k in range(70)}
    rows = [(i * 70 + k, " ".join("".join(rng.choices(syll + shared, k=3)) for _ in range(60)), name)
            for k, (name, syll) in enumerate(langs.items()) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.language_id(docs).collect()}
    held = [r for r in rows if got[r[0]].held_out]
    assert len(held) > 150 and sum(got[d].lang_pred == name for d, _, name in held) >= 0.95 * len(held)


def test_close_languages_and_short_texts_stay(spark):
    """Eight languages of the same syllables but for one of ten; noise goes, what is too short to tell stays."""
    rng = random.Random(8)
    common = [a + b + c for a, b, c in zip("bcdfghjkl", "aeiouaeio", "mnprstvwx")]
    text = lambda syll, n: " ".join("".join(rng.choices(syll, k=3)) for _ in range(n))
    rows = [(i * 8 + k, text([*common, f"z{'aeiouyäö'[k]}q"], 80), f"l{k}") for k in range(8) for i in range(30)]
    noise = [(1000 + i, text([a + b for a in "qxzjv" for b in "qxzjv"], 80), None) for i in range(20)]
    short = [(2000, "Qx", None), (2001, "xyzzy plugh", None), (2002, "12 !", None), (2003, None, None), (2004, "", None)]
    docs = spark.createDataFrame(rows + noise + short, "doc_id long, text string, lang string")
    predicted = {r.doc_id: r for r in language.language_id(docs).collect()}
    assert sum(predicted[r[0]].score < 0.3 for r in rows) > 100  # a share of all languages' hits says nothing here
    kept = {r.doc_id for r in language.known_language(docs).collect()}
    assert kept == {r[0] for r in rows} | {2000, 2001}


@tables
def test_toxicity_finds_toxic_documents(spark):
    """Accuracy alone says little where one label is rare: recall and false positives on the held-out rows."""
    sf = SF.replace("0.001", "0.01")
    if not os.path.exists(sf):
        pytest.skip("table not present")
    got = E.queries()["op6_toxicity"](spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    held = got[got.held_out]
    toxic, clean = held[held.toxic == 1], held[held.toxic == 0]
    assert (toxic.predicted == 1).mean() > 0.6 and (clean.predicted == 1).mean() < 0.05
