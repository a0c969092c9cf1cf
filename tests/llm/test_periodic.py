"""Runs of periodic words against a search of every period at every place."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from kerbline.llm import periodic
from kerbline.llm.queries import QUERIES
from odd_rows import none, odd, real  # noqa: F401


def smallest_period(words):
    """From the longest proper border."""
    border = [0] * len(words)
    for i in range(1, len(words)):
        k = border[i - 1]
        while k and words[i] != words[k]:
            k = border[k - 1]
        border[i] = k + (words[i] == words[k])
    return len(words) - border[-1]


def brute(words):
    """(start, length, period) of every run: each period, each maximal stretch, periods that are not smallest left out."""
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q) and smallest_period(words[i : i + length]) == q:
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def made(random_words, kinds, repeats):
    """Words with periodic stretches, some inside others."""
    rng = random.Random(random_words * 100 + kinds)
    words = [rng.choice("abcdefgh"[:kinds]) for _ in range(random_words)]
    for _ in range(repeats):
        at, q = rng.randrange(len(words) + 1), rng.randint(1, 9)
        piece = [rng.choice("abcdefgh"[:kinds]) for _ in range(q)]
        words[at:at] = (piece * 9)[: rng.randint(q, 7 * q)]
    return words


CASES = [made(n, kinds, repeats) for n in (0, 3, 40, 150) for kinds in (1, 2, 3, 8) for repeats in (0, 3, 6)]
CASES += [["a"] * 700, (["a"] * 9 + ["b"]) * 30, (list("abcab") * 5 + ["x"]) * 6, list("ab") * 100 + list("ba") * 100]


def test_runs_are_those_of_brute_force():
    assert periodic.runs_of(CASES) == [brute(words) for words in CASES]
    assert [periodic.runs_of([words])[0] for words in CASES] == [brute(words) for words in CASES]


def test_blocks_beyond_the_cap_are_searched_in_pieces():
    for words in CASES:
        codes, offsets = periodic._numbered([words])
        assert periodic.find_runs(codes, offsets, cap=2) == periodic.find_runs(codes, offsets)


def test_transform_is_exact():
    rng = np.random.default_rng(1)
    for size in (1, 2, 8, 64):
        blocks = rng.integers(0, 30_000, (5, size)).astype(np.uint64)
        windows = rng.integers(0, 30_000, (5, 2 * size - 1)).astype(np.uint64)
        windows[0, :size] = blocks[0]
        ours = periodic.squared_differences(blocks, windows)
        for row in range(5):
            for d in range(size):
                squares = ((blocks[row].astype(object) - windows[row, d : d + size].astype(object)) ** 2).sum()
                assert ours[row, d] == squares % periodic.PRIME
        assert ours[0, 0] == 0


def test_a_sum_that_is_zero_only_modulo_the_prime_is_no_run(monkeypatch):
    monkeypatch.setattr(periodic, "squared_differences", lambda blocks, windows: np.zeros(blocks.shape, np.uint64))
    assert periodic.runs_of(CASES) == [brute(words) for words in CASES]


def expected(doc_id, text):
    words = (text or "").encode().split()
    crc = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if crc % 10 == 0 and words:
        n, g = len(words), crc // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words) if len(words) < 5000 else periodic.runs_of([words])[0]
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (
        doc_id,
        len(runs),
        *best,
        runs and 1000 * best[1] // best[2] or None,
        hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_is_brute_force_on_the_given_table(spark, sf_dir, real):
    out = QUERIES["op13_periodic_runs"](spark, sf_dir)
    assert out.columns == COLUMNS
    want = [expected(r["doc_id"], r["text"]) for r in real.select("doc_id", "text").collect()]
    assert sorted(map(tuple, out.collect())) == sorted(want)
    assert sum(r[1] for r in want) > 10


def test_odd_rows(spark, odd, none):
    rows = [tuple(r) for r in periodic.report(odd).collect()]
    want = [expected(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    assert periodic.report(none).collect() == []


@pytest.mark.parametrize("doc_id", [0, 5, None])
def test_changed_words_have_the_stated_form(doc_id):
    words = [str(i) for i in range(50)]
    for crc in (10 * g for g in range(200)):
        n, g = 50, crc // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        want = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        assert periodic.periodic_tail(words, crc) == want
