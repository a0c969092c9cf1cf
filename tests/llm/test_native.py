"""Exact deduplication, mixing, URL filters: brute force, edge cases, recovery."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from kerbline.llm import bloom, exact_dedup, mixing, url_filter
from odd_rows import none, odd, real  # noqa: F401

SPACES = str.maketrans("", "", " \t\n\x0b\x0c\r")


def _groups(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r["text"] or "").translate(SPACES)].append(r)
    return groups


@pytest.mark.parametrize("short", [False, True])
def test_dedup_matches_brute_force_even_when_digests_collide(odd, short):
    digest = (lambda c: F.substring(F.sha2(c, 256), 1, 1)) if short else exact_dedup.sha256
    got = exact_dedup.dedup(odd, digest=digest, max_files=1 if short else None).collect()
    assert len(got) == odd.count()
    want = _groups(odd.collect())
    assert sum(r["kept"] for r in got) == len(want)
    sizes, keeps = defaultdict(list), {}
    for norm, rows in want.items():
        best = max(rows, key=lambda r: (len(r["text"] or ""), r["doc_id"] is not None, -(r["doc_id"] or 0)))
        for r in rows:
            sizes[r["doc_id"]].append(len(rows))
            keeps[(r["doc_id"], len(rows))] = best["doc_id"]
            if not short:
                assert hashlib.sha256(norm.encode()).hexdigest() in {g["digest"] for g in got if g["doc_id"] == r["doc_id"]}
    for r in got:
        assert r["group_size"] in sizes[r["doc_id"]] and r["keep_id"] == keeps[(r["doc_id"], r["group_size"])]


def test_dedup_keeps_one_row_of_each_text(odd, none):
    kept = exact_dedup.distinct_texts(odd)
    assert kept.columns == odd.columns
    assert sorted((r["text"] or "").translate(SPACES) for r in kept.collect()) == sorted(_groups(odd.collect()))
    assert exact_dedup.dedup(none).count() == 0 and exact_dedup.distinct_texts(none).count() == 0


def test_state_goes_on_over_many_batches(spark, real):
    parts = exact_dedup.dedup(real.repartition(5), max_files=1)
    once = exact_dedup.dedup(real)
    columns = ["doc_id", "keep_id", "group_size", "kept", "digest"]
    assert parts.select(columns).exceptAll(once.select(columns)).isEmpty()


def _targets(sizes, weights=(3, 1, 2)):
    """By filling up and sharing again until no source is above twice its size."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, full, target = 1.5 * sum(sizes.values()), set(), {}
    while True:
        open_ = [s for s in names if s not in full]
        total = sum(weight[s] for s in open_)
        target = {s: 2.0 * sizes[s] if s in full else left * weight[s] / total for s in names}
        over = {s for s in open_ if target[s] > 2 * sizes[s]}
        if not over:
            return target
        full |= over
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        if len(full) == len(names):
            return {s: 2.0 * sizes[s] for s in names}


@pytest.mark.parametrize("which", ["odd", "real"])
def test_mixing_comes_near_its_targets(request, which):
    docs = request.getfixturevalue(which)
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    sizes = defaultdict(int)
    for r in docs.collect():
        sizes[r["source"]] += len((r["text"] or "").translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ")) - (
            (r["text"] or "").translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ").count("")
        )
    want = _targets(sizes)
    got = mixing.report(docs).collect()
    assert len(got) == docs.count()
    taken = defaultdict(int)
    for r in got:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        if r["doc_id"] is not None:
            s = source[r["doc_id"]]
            assert r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6 * (1 + want[s])
            taken[s] += r["taken"]
    if which == "real":
        largest = defaultdict(int)
        for r in got:
            largest[source[r["doc_id"]]] = max(largest[source[r["doc_id"]]], r["size"])
        assert all(abs(taken[s] - want[s]) <= largest[s] / 2 for s in want)
        assert sorted(abs(taken[s] / want[s] - 1) for s in want)[len(want) // 2] < 0.01
        again = mixing.report(docs.repartition(7)).collect()
        assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)


def test_mixed_documents_follow_their_positions(odd, none, real):
    out = mixing.mix(real)
    assert out.columns == ["doc", "position"] and out.select("doc.*").columns == real.columns
    places = [r["position"] for r in out.select("position").collect()]
    assert places == sorted(places) and 0 <= places[0] and places[-1] <= 1
    taken = mixing.report(real).agg(F.sum(F.col("taken") / F.nullif("size", F.lit(0)))).first()[0]
    assert len(places) == round(taken)
    assert mixing.mix(none).count() == 0 and mixing.report(none).count() == 0
    assert mixing.mix(odd).select("doc.*").columns == odd.columns


@pytest.mark.parametrize("schedule", [(1, 1), (1, 2, 1), (2, 1), (0, 1), (3, 0, 3)])
def test_positions_invert_the_integrated_schedule(spark, schedule):
    points = [i / 50 for i in range(51)]
    df = spark.createDataFrame([(p,) for p in points], "share double")
    got = [r[0] for r in df.select(F.expr(mixing.position_sql("share", schedule))).collect()]
    width = 1 / (len(schedule) - 1)

    def given(t):
        total = 0.0
        for i, (a, b) in enumerate(zip(schedule, schedule[1:])):
            x = min(max(t - i * width, 0), width)
            total += a * x + (b - a) / width * x * x / 2
        return total

    assert got == sorted(got)
    for share, t in zip(points, got):
        assert abs(given(t) / given(1.0) - share) < 1e-9


def test_url_rules_and_list(spark):
    urls = [
        (None, "", "", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        ("http://A.Example.ORG/es/1?x#y", "a.example.org", "/es/1", "example.org/es/", "block"),
        ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        ("http://notexample.org/en/12", "notexample.org", "/en/12", "org/", "allow"),
        ("http://x.org", "x.org", "", None, "allow"),
        ("http://b.com/de/", "b.com", "/de/", "com/de/", "block"),
        ("http://www.b.com/en/9/?u=1", "www.b.com", "/en/9/", None, "block"),
        ("https://b.com/en/9", "b.com", "/en/9", None, "block"),
        ("https://b.com/en/91", "b.com", "/en/91", None, "allow"),
        ("x://y://z/p", "y:", "//z/p", None, "allow"),
    ]
    rows = [(i, u, "h", "p", "v") for i, (u, *_) in enumerate(urls)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, host string, path string, canonical string")
    listed = spark.createDataFrame([("b.com/en/9",), ("b.com/en/9",), (None,)], "canonical string")
    got = {r["page_id"]: tuple(r) for r in url_filter.judge(df, listed).select("page_id", "host", "path", "rule", "verdict").collect()}
    assert got == {i: (i, *want) for i, (_, *want) in enumerate(urls)}
    assert url_filter.judge(df, listed).count() == len(rows)
    none = listed.where("false")
    assert url_filter.judge(df, none).where("verdict = 'block' AND rule IS NULL").isEmpty()
    assert url_filter.judge(df.where("false"), listed).isEmpty()


def test_a_full_filter_changes_no_verdict(spark, sf_dir):
    urls = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    listed = urls.where("page_id % 2 = 0").select(url_filter.canonical(url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))).alias("canonical"))
    wide, narrow = url_filter.judge(urls, listed), url_filter.judge(urls, listed, max_blocks=1)
    assert wide.exceptAll(narrow).isEmpty() and wide.count() == narrow.count()


def test_bloom_split_lets_every_key_through(spark):
    keys = spark.range(0, 3000, 3)
    for blocks in (1, bloom.MAX_BLOCKS):
        sure, maybe = bloom.split(spark.range(3000), F.col("id"), keys, F.col("id"), blocks)
        assert sure.where("id % 3 = 0").isEmpty() and sure.count() + maybe.count() == 3000
    assert maybe.count() < 1100
