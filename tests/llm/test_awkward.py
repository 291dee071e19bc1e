"""Every operator on nulls, empty and very long texts, ties, repeated rows, clashing names, empty tables."""

import hashlib

import pytest

from cashcast.llm import (decontamination, fuzzy_passages, language, line_rules, mixing, ngram_join, quality, sharding,
                          substring_index, toxicity)
from tests.llm.cases import CLASHES, LONG, PASSAGE, ROWS, awkward, by_id, empty, labels, prose


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id string, text string, row string")


ITEMS = [("q1", " ".join(PASSAGE.split()[5:30]), "x"), ("q2", "short words", "x"), (None, None, "x"), ("q3", "", "x"), ("q1", "short words", "x")]


def test_decontamination(spark):
    got = by_id(decontamination.digest(awkward(spark), items(spark, ITEMS)))
    assert sum(map(len, got.values())) == len(ROWS)
    assert [r.contaminated for r in got[5]] == [True, True] and got[9][0].n_hit == 25
    assert got[7][0].n_items == 2 and got[7][0].n_hit == 2  # both items that hold "short words"
    assert got[1][0].n_words == 0 and not got[1][0].contaminated
    assert got[1][0].items_sha256 == hashlib.sha256(b"").hexdigest()
    assert not got[4][0].contaminated and got[4][0].n_words == 60_000
    clean = decontamination.decontaminate(awkward(spark), items(spark, ITEMS))
    assert clean.columns == awkward(spark).columns
    assert {r.doc_id for r in clean.collect()} == {1, 2, 3, 4, 8, 10, 11, None}


def test_decontamination_without_items_or_rows(spark):
    got = decontamination.digest(awkward(spark), items(spark, [])).collect()
    assert len(got) == len(ROWS) and not any(r.contaminated for r in got)
    assert decontamination.digest(empty(spark), items(spark, ITEMS)).count() == 0


def test_decontamination_in_blocks(spark):
    one = decontamination.digest(awkward(spark), items(spark, ITEMS)).collect()
    many = decontamination.digest(awkward(spark), items(spark, ITEMS), block_bytes=60).collect()
    key = lambda r: (str(r.doc_id), r.n_words)
    assert sorted(one, key=key) == sorted(many, key=key)


def test_blocks_find_the_same_passages(spark):
    """All of find's columns, with passages that two items share at a border and many copies of one row."""
    words = PASSAGE.split()
    asked = [("a", " ".join(words[:14]), "x"), ("b", " ".join(words[14:30]), "x"), ("c", " ".join(words[8:20]), "x"),
             ("d", " ".join(words[50:60]), "x"), ("e", "short words", "x"), ("f", None, "x")]
    copies = awkward(spark).unionByName(awkward(spark).filter("doc_id = 9 OR doc_id IS NULL"))
    answers = []
    for size in (1 << 20, 200, 40):
        found = decontamination.find(copies, items(spark, asked), block_bytes=size).collect()
        answers.append(sorted(((str(r.doc_id), r.text_hash, r.n_words, r.n_hit, sorted(r.item_ids), sorted(r.near_ids), r.spans)
                               for r in found)))
    assert answers[0] == answers[1] == answers[2] and len(answers[0]) == len(ROWS) + 3
    assert [a[6] for a in answers[0] if a[0] == "9"] == [[30, 60, 80, 90]] * 2


def test_proximity(spark):
    words = PASSAGE.split()
    moved = " ".join([*words[:4], "inserted", *words[4:10]])
    docs = spark.createDataFrame([(1, moved), (2, " ".join(words[:10])), (3, " ".join(words[9::-1]))], "doc_id long, text string")
    got = by_id(decontamination.find(docs, items(spark, [("q", " ".join(words[:10]), "x")]), slop=1))
    assert (got[1][0].item_ids, got[1][0].near_ids) == ([], ["q"])
    assert (got[2][0].item_ids, got[2][0].spans) == (["q"], [0, 10])
    assert got[3][0].near_ids == []


def test_mixing(spark):
    got = by_id(mixing.mixed(awkward(spark)))
    assert sum(map(len, got.values())) == len(ROWS)
    rows = [r for v in got.values() for r in v]
    assert got[1][0].size == 0 and got[1][0].taken == 0
    assert all(r.taken <= 3 * r.size and r.target <= 3 * r.source_size for r in rows)
    assert sum(r.taken for r in rows) == pytest.approx(sum(r.size for r in rows), abs=1)
    again = mixing.mixed(awkward(spark).repartition(7))
    assert sorted(map(str, again.collect())) == sorted(map(str, rows))
    assert mixing.mixed(empty(spark)).count() == 0


def test_mixture_takes_effect(spark):
    docs = awkward(spark)
    out = mixing.mixture(docs)
    assert out.columns == docs.columns
    words = sum(len(r.text.split()) for r in out.collect())
    assert words == pytest.approx(sum(len((t or "").split()) for _, t, _, _ in ROWS), abs=1)
    assert mixing.mixture(empty(spark)).count() == 0


def test_quality_and_toxicity(spark):
    for score in (quality.quality_scores, toxicity.toxicity_scores):
        rows = labels(spark, [(4, 1, 0), (5, 0, 1), (5, 1, 1), (7, 0, 1), (8, None, None), (None, 1, 1)])
        got = by_id(score(awkward(spark), rows))
        assert sum(map(len, got.values())) == len(ROWS)
        assert all(0 <= r.score <= 1 for v in got.values() for r in v)
        assert got[1][0].score == got[2][0].score  # null like empty
        none = by_id(score(awkward(spark), labels(spark, [])))
        assert none[1][0].score == 0.5
        assert score(empty(spark), rows).count() == 0


def test_sharding(spark):
    docs = awkward(spark)
    got = sharding.shard(docs, limit=2000).collect()
    assert len(got) == len(ROWS)
    total = {}
    for r in got:
        total.setdefault(r.shard, []).append(r.n_bytes)
    assert all(sum(v) <= 2000 or len(v) == 1 for v in total.values())
    assert max(map(max, total.values())) == len(LONG)
    out = sharding.sharded(docs, limit=2000)
    assert out.columns == [c for c in docs.columns if c != "shard"] + ["shard"] and out.count() == len(ROWS)
    assert sharding.shard(empty(spark)).count() == 0


def test_sharding_pages_of_one_key(spark):
    docs = spark.createDataFrame([(1, "x" * 100)] * 50 + [(2, "y" * 10)], "doc_id long, text string").repartition(4)
    total = {}
    for r in sharding.shard(docs, limit=1000).collect():
        total[r.shard] = total.get(r.shard, 0) + r.n_bytes
    assert sum(total.values()) == 5010 and max(total.values()) <= 1000


def test_substring_index(spark):
    got = by_id(substring_index.remove_repeats(awkward(spark), with_text=True))
    assert sum(map(len, got.values())) == len(ROWS)
    n = len(PASSAGE)
    assert sorted(r.n_removed for r in got[5]) == [0, n] and got[6][0].n_removed == n
    # blanks around the passage differ from the passage's own borders
    assert got[9][0].n_removed == n and PASSAGE[100:-100] not in got[9][0].kept
    assert got[1][0].n_bytes == 0 and got[4][0].n_removed == 0
    assert substring_index.remove_repeats(empty(spark)).count() == 0


def test_language(spark):
    got = by_id(language.language_id(awkward(spark)))
    assert sum(map(len, got.values())) == len(ROWS)
    for i in (1, 2, 3, 10):
        assert (got[i][0].lang_pred, got[i][0].score) == ("und", 0.0)
    assert all(r.lang_pred in ("en", "de", "und") and 0 <= r.score <= 1 for v in got.values() for r in v)
    assert language.language_id(empty(spark)).count() == 0
    kept = language.known_language(awkward(spark))
    assert kept.columns == awkward(spark).columns and not {r.doc_id for r in kept.collect()} & {1, 2, 3, 10}
    assert language.known_language(empty(spark)).count() == 0


def test_line_rules(spark):
    got = by_id(line_rules.line_rules(awkward(spark)))
    assert sum(map(len, got.values())) == len(ROWS)
    assert got[1][0].base_failed and not got[1][0].kept and got[4][0].kept
    assert got[11][0].n_repeat_words == 12
    assert line_rules.line_rules(empty(spark)).count() == 0


def test_line_rules_remove_common_lines(spark):
    common = "this line is on every page of the host and says nothing at all about it"
    rows = [(i, common + "\n" + common.upper() + "\n" + " ".join(f"w{i}x{k}" for k in range(5)), "h") for i in range(30)]
    rows += [(100, common + "\n" + " ".join(f"own{k}" for k in range(40)), "h"), (101, common + "\n" + " ".join(f"z{k}" for k in range(40)), "other")]
    got = by_id(line_rules.line_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    assert not got[0][0].kept and got[0][0].n_words_left == 5  # the upper-case line is the same line
    assert got[100][0].kept and got[100][0].n_common_lines == 1
    assert got[101][0].kept and got[101][0].n_common_lines == 0


def test_ngram_join(spark):
    got = by_id(ngram_join.ngram_components(awkward(spark)))
    assert sum(map(len, got.values())) == len(ROWS)
    assert {r.component_id for i in (5, 6) for r in got[i]} == {5} and got[5][0].n_shingles == 77
    assert got[1][0].component_id == 1 and got[2][0].n_shingles == 0
    assert got[7][0].n_shingles == 1 and got[11][0].n_shingles == 1
    assert ngram_join.ngram_components(empty(spark)).count() == 0
    out = ngram_join.deduplicate(awkward(spark))
    assert out.columns == awkward(spark).columns
    ids = sorted(str(r.doc_id) for r in out.collect())
    assert ids == sorted(["1", "2", "3", "4", "5", "7", "8", "9", "10", "11", "None", "None"])
    assert ngram_join.deduplicate(empty(spark)).count() == 0


def test_deduplicate_goes_by_links_not_ids(spark):
    """Different texts without an id, or of one id, are not one group."""
    rows = [(None, prose(30, 1)), (None, prose(30, 2)), (None, prose(30, 2)), (7, prose(30, 3)), (7, prose(30, 4)), (8, prose(30, 4))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = sorted(r.text for r in ngram_join.deduplicate(docs).collect())
    assert left == sorted(prose(30, k) for k in (1, 2, 3, 4))


def test_fuzzy_passages(spark):
    got = fuzzy_passages.passages(awkward(spark)).collect()
    found = {(r.doc_id, r.other_doc_id): r for r in got}
    assert {(5, 5), (6, 5)} < set(found) and len(found) == 3
    r = found.get((9, 5)) or found[9, 6]  # either is earlier
    assert (r.start_word, r.end_word, r.other_start_word, r.other_end_word, r.n_words, r.similarity) == (30, 110, 0, 80, 80, 1.0)
    assert fuzzy_passages.passages(empty(spark)).count() == 0


def test_clashing_names_are_there():
    assert len(set(CLASHES)) == len(CLASHES)
