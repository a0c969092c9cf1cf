"""The log-frequency filter and its scores against exact counts."""

import math
from collections import Counter

import numpy as np
import pytest
from odd_rows import none, odd, real  # noqa: F401
from pyspark.sql import functions as F

from kerbline.llm import bloom_lm

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def tokens(text):
    return (text or "").encode().translate(LOWER).split() + [b"\n"]


def middle(n):
    return 2.0 ** (n.bit_length() - 0.5) if n else 0.0


def exact(learned):
    """(counts of tokens, of pairs) of the texts to learn from."""
    words, pairs = Counter(), Counter()
    for text in learned:
        own = tokens(text)
        words.update(own)
        pairs.update(zip([b"\n", *own], own))
    return words, pairs


def scored(df, **options):
    return {r["doc_id"]: r for r in bloom_lm.score(df, "learn", **options).collect()}


@pytest.fixture(scope="module")
def both(odd, real):
    """Odd rows to score, given rows to learn from; the ids are made distinct."""
    mine = odd.select("text", F.lit(False).alias("learn")).unionByName(real.select("text", F.lit(True).alias("learn")))
    rows = [(i, *r) for i, r in enumerate(mine.collect())]
    return odd.sparkSession.createDataFrame(rows, "doc_id long, text string, learn boolean"), rows


def test_base_score_is_exact(both):
    df, rows = both
    words, _ = exact(text for _, text, learn in rows if learn)
    n, v = sum(words.values()), len(words)
    found = scored(df)
    assert len(found) == len(rows)
    for i, text, _ in rows:
        own, r = tokens(text), found[i]
        base = sum(math.log10((words[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(words[t] > 0 for t in own), n)
        assert abs(r["base_score"] - base) <= 1e-9 * abs(base) + 1e-9
        assert r["score"] < 0 and math.isfinite(r["score"])


def test_scores_are_those_of_quantised_counts(both):
    """Every token and pair is held, those seen once too: only the filter's false positives make a difference."""
    df, rows = both
    words, pairs = exact(text for _, text, learn in rows if learn)
    n, v = sum(words.values()), len(words)
    found, off = scored(df), []
    for i, text, _ in rows:
        own, want = tokens(text), 0.0
        for u, w in zip([b"\n", *own], own):
            a, b = middle(words[u]), middle(words[w])
            share = min(middle(pairs[u, w]), a) / a if a else 0.0
            weight = a / (a + bloom_lm.KAPPA)
            want += math.log10(weight * share + (1 - weight) * (b + bloom_lm.ALPHA) / (n + bloom_lm.ALPHA * (v + 1)))
        off.append(abs(found[i]["score"] / want - 1))
    assert sorted(off)[len(off) * 9 // 10] < 0.02


def test_parts_make_no_difference(both, monkeypatch):
    df, rows = both
    want = scored(df)
    monkeypatch.setattr(bloom_lm, "HELD_BYTES", 1 << 14)
    monkeypatch.setattr(bloom_lm, "PART_BITS", 15)
    found = scored(df)
    assert found.keys() == want.keys() and all(abs(found[i]["score"] - want[i]["score"]) < 1e-6 * abs(want[i]["score"]) for i in want)


def test_more_ranges(both):
    df, rows = both
    want, found = scored(df), scored(df, ranges=1024)
    assert all(found[i]["base_score"] == pytest.approx(want[i]["base_score"], rel=1e-12) for i in want)
    assert np.median([abs(found[i]["score"] / want[i]["score"] - 1) for i in want]) < 0.02


def test_nothing_to_learn_from(odd, none):
    rows = bloom_lm.score(odd.withColumn("learn", F.lit(None).cast("boolean")), "learn").collect()
    assert len(rows) == odd.count() and {r["base_score"] for r in rows} == {0.0} and {r["score"] for r in rows} == {0.0}
    assert set(odd.columns) - {"text", "score"} <= set(rows[0].asDict())
    assert bloom_lm.score(none.withColumn("learn", F.lit(True)), "learn").count() == 0


def test_filter_gives_levels():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 1 << 63, 30_000).astype(np.uint64)
    level = rng.integers(0, 6, 30_000)
    own = bloom_lm.Filter.of(codes, level)
    assert len(own.bits) == -(-int(level.sum()) * bloom_lm.BITS_PER_ENTRY // 8)
    got = own.levels(codes)
    assert (got >= level).all() and (got == level).mean() > 0.95
    assert (own.levels(rng.integers(0, 1 << 63, 30_000).astype(np.uint64)) == 0).mean() > 0.95
    assert bloom_lm.Filter.of(codes, level * 0).levels(codes).max() == 0


def test_levels_and_ranges_grow_as_stated():
    counts = np.array([0, 1, 2, 3, 4, 7, 8, 1 << 40])
    assert bloom_lm.level_of(counts).tolist() == [n.bit_length() for n in counts.tolist()]
    assert bloom_lm.range_count(0) == bloom_lm.LEAST_RANGES
    assert bloom_lm.range_count(30 << 40) >= (30 << 40) // bloom_lm.RANGE_BYTES  # no bound
    assert bloom_lm._width(256) == 5 and bloom_lm._width(1 << 16) == 4
    values = np.arange(0, 1 << 40, (1 << 40) // 999).astype(np.uint64)
    assert (bloom_lm._unpacked(bloom_lm._packed(values, 5).ravel(), 5) == values).all()
