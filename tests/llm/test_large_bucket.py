"""A minimizer that many documents share with different surroundings: its bucket is dealt by windows."""

import numpy as np

from cashcast.llm import substring_index


def _texts():
    rng = np.random.default_rng(4)
    noise = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes().decode()
    common, around = "THE COMMON LINE OF FORTY BYTES IN ALL TEX", noise(90)
    out = []
    for i in range(300):
        before, after = noise(100), noise(100)
        if i % 7 == 0:  # some are equal around it, on one side or on both
            before = before[:-45] + around[:45]
        if i % 21 == 0:
            after = around[45:] + after[45:]
        out.append(before + common + after)
    return out


def _plain(texts, depth):
    seen, out = set(), {}
    for i, t in enumerate(texts):
        for j in range(len(t) - depth + 1):
            if t[j:j + depth] in seen:
                out.setdefault(i, set()).update(range(j, j + depth))
            seen.add(t[j:j + depth])
    return out


def test_large_bucket_is_dealt_by_windows(spark, monkeypatch):
    texts, depth = _texts(), 60
    df = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "row long, doc_id long, text string").repartition(3)
    split = []
    large = substring_index.large_buckets
    monkeypatch.setattr(substring_index, "large_buckets", lambda asked, n: (split.append(large(asked, n).count()), large(asked, n))[1])
    expected = _plain(texts, depth)
    assert len(expected) > 30
    for bucket, some in ((substring_index.BUCKET_BYTES, False), (2000, True)):
        got = substring_index.repeated_spans(df, depth, 32, bucket=bucket).collect()
        assert {r.row: {p for s in r.spans for p in range(s.start, s.end)} for r in got} == expected
        assert (split[-1] > 0) == some
