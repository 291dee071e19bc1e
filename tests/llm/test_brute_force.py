"""Operators against plain versions on the smallest test tables, and their parts on small inputs."""

import os
import re
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
from cashcast.llm import chaining, line_rules, textkit
from cashcast.llm.graphs import Bloom, components
from cashcast.llm.oracle import ORACLE
from cashcast.llm.run_index import RunIndex
from tests.llm.cases import HAVE, SF

tables = pytest.mark.skipif(not HAVE, reason="test tables not present")


@tables
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.execute(ORACLE[name])
    names = [d[0] for d in rel.description]
    expected = sorted(rel.fetchall(), key=repr)
    df = E.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    got = sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        assert a == pytest.approx(b) if any(isinstance(v, float) for v in a) else a == b


def _held(docs, n, rest):
    return docs.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % n == rest)


@tables
@pytest.mark.parametrize("name, label, folds, rest", [("op3_quality", "quality", 4, 2), ("op6_toxicity", "toxic", 5, 0)])
def test_held_out_accuracy(spark, name, label, folds, rest):
    sf = SF.replace("0.001", "0.01")
    if not os.path.exists(sf):
        pytest.skip("table not present")
    got = E.queries()[name](spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    assert (got.held_out == _held(got, folds, rest)).all()
    held = got[got.held_out]
    assert (held.predicted == held[label]).mean() > 0.88


@tables
def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    got = E.queries()["op7_language_id"](spark, SF).toPandas().merge(docs, on="doc_id")
    held = got[_held(got, 4, 2)]
    assert len(got) == len(docs) and (held.lang_pred == held.lang).mean() > 0.95


@tables
def test_fuzzy_passages_cover_exact_runs(spark):
    """Documents with 51 words in a row of an earlier document are reported, and every report is alike."""
    import difflib

    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = {i: i + 32 for i in range(65, 91)}
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().sort_values("doc_id")
    texts = {d: word.findall((t or "").translate(low)) for d, t in zip(docs.doc_id, docs.text)}
    got = E.queries()["op10_fuzzy_passages"](spark, SF).collect()
    seen, runs = {}, set()
    for d, w in texts.items():
        own = [tuple(w[i:i + 51]) for i in range(len(w) - 50)]
        if any(k in seen for k in own):
            runs.add(d)
        seen.update(dict.fromkeys(own, d))
    found = {r.doc_id for r in got}
    assert len(runs - found) <= 0.02 * len(runs)
    for r in got:
        a, b = texts[r.doc_id][r.start_word:r.end_word], texts[r.other_doc_id][r.other_start_word:r.other_end_word]
        same = sum(m.size for m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks())
        assert same >= 0.78 * max(len(a), len(b)) and len(a) >= 50 and r.other_doc_id <= r.doc_id


def test_run_index():
    rng = np.random.default_rng(1)
    for _ in range(100):
        depth, base = int(rng.integers(3, 30)), rng.integers(0, 3, 200).astype(np.uint8)
        parts = []
        for _ in range(int(rng.integers(1, 8))):
            a, n = int(rng.integers(0, 100)), int(rng.integers(0, 60))
            parts.append(base[a:a + n].copy())
            if n and rng.random() < 0.5:
                parts[-1][rng.integers(0, n)] = rng.integers(0, 256)
        off = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        got = {(int(f), int(o)): int(p) for f, o, p in zip(*RunIndex(np.concatenate(parts), off, depth).first_seen())}
        first, expected = {}, {}
        for i, p in enumerate(parts):
            for j in range(len(p) - depth + 1):
                expected[i, j] = first.setdefault(p[j:j + depth].tobytes(), int(off[i]) + i + j)
        assert got == expected


def _plain_chain_score(x, y):
    best = []
    for i in range(len(x)):
        s = chaining.MATCH
        for j in range(i):
            if x[j] < x[i] and y[j] < y[i] and x[i] - x[j] <= chaining.REACH and y[i] - y[j] <= chaining.REACH:
                s = max(s, chaining.MATCH + best[j] - chaining.GAP * (x[i] - x[j] + y[i] - y[j]))
        best.append(s)
    return max(best)


def test_chains_score_like_the_quadratic_recurrence():
    rng = np.random.default_rng(3)
    for _ in range(100):
        m = sorted({(int(a), int(b)) for a, b in rng.integers(0, 40, (int(rng.integers(1, 25)), 2))}, key=lambda p: (p[0], -p[1]))
        x, y = [a for a, _ in m], [b for _, b in m]
        top = chaining.chains(x, y, 0.0)[0]
        score = chaining.MATCH * len(top) - chaining.GAP * (x[top[-1]] - x[top[0]] + y[top[-1]] - y[top[0]])
        assert score == pytest.approx(_plain_chain_score(x, y))


def test_alignment_extends_and_counts():
    a = np.arange(100, 200)
    b = np.concatenate([np.arange(20), a[:50], [1, 2], a[50:], np.arange(5)])
    got = chaining.align(a, b, np.array([10, 30, 60, 80]), np.array([30, 50, 82, 102]), 6)
    assert got == (0, 100, 20, 122, 100)


def test_word_spans_and_hashes():
    texts = ["ab cd", "", "cd", "x" * 10 + " ab"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    start, end, row = textkit.word_spans(data, off, textkit.NON_BLANK)
    words = [data[s:e].tobytes().decode() for s, e in zip(start, end)]
    assert words == ["ab", "cd", "cd", "x" * 10, "ab"] and row.tolist() == [0, 0, 2, 3, 3]
    h = textkit.span_hash(textkit.prefix_sums(textkit.EXACT[data]), start, end)
    assert h[1] == h[2] and h[0] == h[4] and len(set(h.tolist())) == 3


def test_line_measure_against_plain():
    text = "One line\nOne line\none  line\n\n" + "a b c d e f g h " * 3 + "\ntail"
    raw = np.frombuffer(text.encode(), np.uint8)
    counts, row, line, words = line_rules.measure(raw, np.array([0, len(raw)]))
    w = text.split()
    win = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    covered = {i + k for i, g in enumerate(win) if win.count(g) > 1 for k in range(8)}
    assert int(counts["n_repeat_words"][0]) == len(covered)
    assert int(counts["n_dup_lines"][0]) == 1 and int(counts["n_words"][0]) == len(w)
    assert sorted(words.tolist()) == [1, 6, 24]


def test_components_and_bloom(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert {got[i] for i in range(1, 61)} == {1} and got[101] == 100
    from pyspark.sql import functions as F

    keys = spark.range(1000)
    bloom = Bloom(keys, F.col("id"))
    h = [np.array([r[0] for r in spark.range(a, b).select(F.xxhash64("id")).collect()]) for a, b in ((0, 1000), (5000, 9000))]
    assert bloom.holds(h[0]).all() and bloom.holds(h[1]).mean() < 0.01
