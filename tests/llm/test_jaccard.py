"""Components of alike shingle sets against a comparison of all pairs."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
from odd_rows import none, odd, real  # noqa: F401
from pyspark.sql import functions as F

from kerbline.llm import jaccard
from kerbline.llm.queries import QUERIES


def shingle_set(text, size=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def expected(rows):
    sets = [shingle_set(text) for _, text in rows]
    distinct = sorted(set(sets) - {frozenset()}, key=len)
    parent = {s: s for s in distinct}

    def root(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if 100 * len(a) < 90 * len(b):
                break
            shared = len(a & b)
            if 100 * shared >= 90 * (len(a) + len(b) - shared):
                parent[root(a)] = root(b)
    least = {}
    for (doc_id, _), s in zip(rows, sets):
        if s and doc_id is not None:
            least[root(s)] = min(least.get(root(s), doc_id), doc_id)
    return sorted(((d, len(s), least.get(root(s)) if s else d) for (d, _), s in zip(rows, sets)), key=repr)


def ours(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(map(tuple, df.collect()), key=repr)


def near_copies(seed=5):
    """Groups of near copies of one text each, around the threshold, with exact copies and a phrase that all share."""
    rng = random.Random(seed)
    phrase = "this very phrase is found in all of them and it is a long one".split()
    rows = []
    for group in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([6, 12, 25, 60, 150]))] + phrase
        for _ in range(rng.choice([2, 5, 40])):
            words = list(base)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10_000)}"
            if rng.random() < 0.3:
                words = words[: len(words) - rng.randrange(4)]
            rows.append(" ".join(words).upper() if rng.random() < 0.2 else "\n ".join(words))
    rows += rng.sample(rows, 20)
    rng.shuffle(rows)
    return list(enumerate(rows, 100))


def test_query_compares_as_all_pairs(spark, sf_dir, real):
    rows = [tuple(r) for r in real.select("doc_id", "text").collect()]
    want = expected(rows)
    assert ours(QUERIES["op12_jaccard_join"](spark, sf_dir)) == want
    assert sum(component != doc for doc, _, component in want) > 5


@pytest.mark.parametrize("rounds, small", [(0, 8), (2, 1)])
def test_near_copies(spark, monkeypatch, rounds, small):
    monkeypatch.setattr(jaccard, "SMALL", small)
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = expected(rows)
    assert 12 < len({c for _, _, c in want}) < len(want) - 80
    assert ours(jaccard.join(df, rounds=rounds)) == want


def test_hubs_leave_few_pairs(spark):
    """A group of near copies costs the hub rounds a pair or two per member; what is left for the last round is not all pairs."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base[:i] + [f"x{i}"] + base[i + 1 :]) for i in rng.sample(range(200), 120)] + [" ".join(base)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = []
    monkey = jaccard.verified
    try:
        jaccard.verified = lambda pairs, *rest: (found.append(pairs.distinct().count()), monkey(pairs, *rest))[1]
        assert {r[2] for r in ours(jaccard.join(df))} == {0}
    finally:
        jaccard.verified = monkey
    assert sum(found) < 5 * len(texts)


def test_odd_rows(spark, odd, none):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    clashing = odd.withColumns({c: F.lit("x") for c in ("token", "node", "n", "tokens", "component_id", "file_id")})
    assert ours(jaccard.join(clashing)) == expected(rows)
    assert ours(jaccard.join(none)) == []


def test_filters_never_drop_a_link():
    """Every linked pair passes length, position and suffix filter at its first shared prefix shingle."""
    rng = np.random.default_rng(4)
    linked = 0
    for _ in range(300):
        n = int(rng.integers(9, 60))
        a = set(rng.choice(10_000, n, replace=False).tolist())
        b = set(sorted(a)[int(rng.integers(0, 3)) :]) | set(rng.choice(10_000, int(rng.integers(0, 3))).tolist())
        shared = len(a & b)
        if 100 * shared < 90 * (len(a) + len(b) - shared):
            continue
        linked += 1
        a_, b_ = sorted(a), sorted(b)
        prefixes = [x[: jaccard.spare(len(x)) + 1] for x in (a_, b_)]
        first = min(set(prefixes[0]) & set(prefixes[1]))
        i, j = a_.index(first), b_.index(first)
        need = -(-90 * (len(a) + len(b)) // 190)
        assert min(len(a) - i, len(b) - j) >= need
        cells = [np.bincount(np.array(x[k + 1 :], int) % 16, minlength=16) for x, k in ((a_, i), (b_, j))]
        assert np.abs(cells[0] - cells[1]).sum() <= len(a) + len(b) - 2 * need - i - j
    assert linked > 100


def test_smallest_set_with_a_partner():
    least = jaccard.least_size(90)
    assert all(100 * m < 90 * n for m, n in combinations(range(1, least + 1), 2))
    assert 100 * least >= 90 * (least + 1)
