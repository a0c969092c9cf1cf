"""Language, quality, language model, byte-pair encoding: brute force, held-out accuracy, edge cases."""

import base64
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from kerbline.llm import bpe, langid, quality
from kerbline.llm.queries import QUERIES
from odd_rows import none, odd, real  # noqa: F401

PATH = public_tokenizers.path(bpe.VOCABULARY)


def test_language_is_right_on_held_out_texts(spark, sf_dir, real):
    got = {r["doc_id"]: r for r in QUERIES["op1_language_id"](spark, sf_dir).collect()}
    rows = real.collect()
    assert len(got) == len(rows)
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert {i for i, r in got.items() if r["held_out"]} == {r["doc_id"] for r in held}
    assert sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_edge_cases(odd, none):
    model = langid.fit(odd)
    out = langid.predict(odd, model)
    assert set(out.columns) == {*odd.columns, "lang_pred"}
    rows = out.collect()
    assert len(rows) == odd.count()
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert r["lang_pred"] in ("und", "en", "de")
    assert langid.predict(none, model).count() == 0
    empty = langid.fit(none)
    assert {r["lang_pred"] for r in langid.predict(odd, empty).collect()} == {"und"}


def test_language_of_more_than_one_block(spark):
    letters = [chr(0x4E00 + i) for i in range(langid.LANGUAGES + 3)]
    rows = [(f"l{i:03}", (c + " ") * 20) for i, c in enumerate(letters)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    model = langid.fit(docs)
    assert [len(langs) for langs, _, _ in model] == [langid.LANGUAGES, 3]
    got = langid.predict(docs, model).collect()
    assert len(got) == len(rows) and all(r["lang_pred"] == r["lang"] for r in got)
    raw = [t.encode() for _, t in rows] + [letters[0].encode(), b"none of these"]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    whole = [tuple(np.concatenate([block[k] for block in model]) for k in range(3))]
    for one, many in zip(langid.scores(whole, data, offsets), langid.scores(model, data, offsets)):
        assert np.allclose(one, many)


def test_language_scores_are_naive_bayes():
    texts = ["abab ba", "cdcd dc", "ab cd"]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    codes, rows, letters = langid.folded(data, offsets)
    assert letters.tolist() == [6, 6, 4]
    want = Counter()
    for i, t in enumerate(texts):
        want.update((i, n, g) for n in (1, 2, 3) for g in (t[k : k + n] for k in range(len(t) - n + 1)) if g != " ")
    got = sum(len(b) for b, _ in langid.grams(codes, rows))
    assert got == sum(want.values())


def _base(text):
    words = (text or "").encode().split()
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").encode().split(b"\n") if x.split()]
    return (
        len(words),
        sum(len(w.decode()) for w in words),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


@pytest.mark.parametrize("which", ["odd", "real"])
def test_quality_counts_match_brute_force(request, which):
    docs = request.getfixturevalue(which)
    refs = quality.references(docs)
    out = quality.judge(docs, refs).collect()
    assert len(out) == docs.count()
    for r in out:
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert got == _base(r["text"])
        n, repeats = got[0], got[4]
        assert r["base_failed"] == (n < 20 or 100 * repeats > 30 * n)
        near = (n < quality.CLASS_WORDS or r["class_distance"] <= quality.CLASS_LIMIT) and (
            n < quality.COMMON_WORDS or r["word_distance"] <= quality.WORD_LIMIT
        )
        assert r["kept"] == (not r["base_failed"] and near)
    passing = quality.passing(docs, refs)
    assert passing.columns == docs.columns and passing.count() == sum(r["kept"] for r in out)


def test_quality_keeps_clean_labels_and_drops_junk(spark, sf_dir):
    sf = sf_dir.replace("0.001", "0.01")
    verdicts = QUERIES["op7_quality_rules"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = verdicts.join(labels, "doc_id").where("n_words >= 20").collect()
    good, junk = [r for r in rows if r["quality"]], [r for r in rows if not r["quality"]]
    assert sum(r["kept"] for r in good) >= 0.99 * len(good)
    assert sum(not r["kept"] for r in junk) >= 0.9 * len(junk)


def test_quality_of_nothing(none, odd):
    refs = quality.references(none)
    assert refs == {} and quality.judge(none, refs).count() == 0
    assert quality.judge(odd, refs).count() == odd.count()


def _prose(alphabet, seed, n):
    """Invented prose: a few common words among many rare ones."""
    rng = random.Random(seed)
    common = ["".join(rng.choices(alphabet, k=rng.randint(2, 4))) for _ in range(30)]
    return " ".join(rng.choice(common) if rng.random() < 0.5 else "".join(rng.choices(alphabet, k=rng.randint(4, 9))) for _ in range(n))


LATIN, RUSSIAN, GREEK = "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуя", "αβγδεζηθικλμνοπρστυ"


def test_quality_keeps_every_language(spark):
    def texts(lang, alphabet, seed, n=20):
        whole = _prose(alphabet, seed, n * 250).split()
        return [(lang, " ".join(whole[i :: n])) for i in range(n)]

    rows = [r for i in range(quality.LANGUAGES + 3) for r in texts(f"l{i:03}", LATIN, i)]
    rows += texts("zz", RUSSIAN, 1)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(8).cache()
    refs = quality.references(docs)
    assert set(refs) == {lang for lang, _ in rows} | {quality.ALL}
    assert len(quality.judges(spark, refs)) == 2
    assert all(r["kept"] for r in quality.judge(docs, refs).collect())
    # a script without a reference is not tested; one with a reference is
    more = spark.createDataFrame([("g", _prose(GREEK, 5, 300))], "lang string, text string")
    assert quality.judge(more, refs).first()["kept"]
    junk = spark.createDataFrame([("g", "б#$%*&|<> " * 30 + "".join(chr(33 + i % 14) + " " for i in range(300)))], "lang string, text string")
    assert not quality.judge(junk, refs).first()["kept"]
    # texts without a label are a reference too, if there are enough of them
    rows = texts(None, RUSSIAN, 2) + texts("en", LATIN, 500)
    unlabelled = spark.createDataFrame(rows, "lang string, text string")
    assert set(quality.references(unlabelled)) == {"en", quality.UNLABELLED, quality.ALL}
    assert all(r["kept"] for r in quality.judge(unlabelled, quality.references(unlabelled)).collect())


def test_a_text_is_not_its_own_reference(spark, real):
    """Junk whose label is rare, missing or that of a language is judged by the languages; many copies do not help it."""
    rng = random.Random(11)
    junk = " ".join("".join(rng.choices("qxzjkvwy", k=rng.randint(3, 9))) for _ in range(300))
    docs = real.select("text", "lang").where("lang IS NOT NULL")
    for label, copies in (("zz", 1), (None, 1), ("en", 1), ("zz", 60)):
        both = docs.unionByName(spark.createDataFrame([(junk, label)] * copies, "text string, lang string"))
        refs = quality.references(both)
        assert "zz" not in refs and quality.UNLABELLED not in refs
        out = quality.judge(both, refs).where(F.col("text") == junk).collect()
        assert len(out) == copies and not any(r["kept"] or r["base_failed"] for r in out)


def _distance(p, q):
    total, other = sum(p), sum(q)
    if not total:
        return 0.0
    out = 0.0
    for x, y in zip(p, q):
        x, y = x / total, y / other
        m = (x + y) / 2
        out += (x * math.log2(x / m) if x else 0) / 2 + (y * math.log2(y / m) if y else 0) / 2
    return math.sqrt(max(out, 0))


def _class_of(char):
    kinds = (("upper", str.isupper), ("lower", str.islower), ("digit", str.isdigit))
    if ord(char) > 127:
        return "beyond ASCII"
    named = {**dict.fromkeys(" \t", "space"), **dict.fromkeys("\n\r\x0b\x0c", "line"), **dict.fromkeys(".,;:!?", "stop")}
    named |= dict.fromkeys("'\"()-", "quote")
    return named.get(char) or next((k for k, f in kinds if f(char)), "control" if ord(char) < 32 or ord(char) == 127 else "symbol")


def test_verdicts_are_those_of_a_plain_reimplementation(real):
    rows = [(r["text"] or "", r["lang"] or quality.UNLABELLED) for r in real.collect()]
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    counted = [(Counter(map(_class_of, t)), Counter(t.encode().translate(lower).split())) for t, _ in rows]
    tallies = {}
    for (text, lang), (chars, words) in zip(rows, counted):
        for name in (lang, quality.ALL):
            own = tallies.setdefault(name, (Counter(), Counter(), set()))
            own[0].update(chars)
            own[1].update(words)
            own[2].add(text)
    refs = {}
    for name, (chars, words, texts) in tallies.items():
        if sum(words.values()) >= quality.REFERENCE_WORDS and len(texts) >= quality.REFERENCE_TEXTS:
            refs[name] = chars, words, sorted(words, key=lambda w: (-words[w], w))[: quality.TOP_WORDS]
    assert len(refs) >= 4
    got = quality.judge(real, quality.references(real)).select("text", "lang", "class_distance", "word_distance").collect()
    got = {(r["text"] or "", r["lang"] or quality.UNLABELLED): r for r in got}
    for (text, lang), (chars, words) in zip(rows, counted):
        of_class, of_words = [], []
        for name, (all_chars, all_words, top) in refs.items():
            mine = name in (lang, quality.ALL)
            rest = {k: n - (chars[k] if mine else 0) for k, n in all_chars.items()}
            of_class.append(_distance([chars[k] for k in quality.CLASS_NAMES], [rest.get(k, 0) for k in quality.CLASS_NAMES]))
            if name == quality.ALL:
                continue
            own = [words[w] for w in top] + [sum(words.values()) - sum(words[w] for w in top)]
            full = [all_words[w] for w in top] + [sum(all_words.values()) - sum(all_words[w] for w in top)]
            left = [max(0, n - (o if mine else 0)) for n, o in zip(full, own)]
            blank = _distance([0] * len(top) + [1], full)
            of_words.append(_distance(own, left) * max(1.0, quality.WORD_LIMIT / (quality.WORD_SHARE * blank)))
        r = got[text, lang]
        assert abs(r["class_distance"] - min(1, *of_class)) < 1e-9
        assert abs(r["word_distance"] - min(1, *of_words)) < 1e-9


def test_quality_drops_words_that_no_language_knows(spark, sf_dir):
    docs = spark.read.parquet(sf_dir.replace("0.001", "0.01") + "/documents.parquet").select("text", "lang")
    refs = quality.references(docs)
    rng = random.Random(2)
    sizes = [rng.randint(3, 9) for _ in range(400)]
    letters = "e" * 12 + "t" * 9 + "a" * 8 + "o" * 7 + "inshrdlu" * 5 + "cmfwypvbgk"
    gibberish = [" ".join("".join(rng.choices(letters, k=n + 6)) for n in rng.sample(sizes, 300)).capitalize() + "." for _ in range(5)]
    rows = [(text, "en") for text in gibberish]
    out = quality.judge(spark.createDataFrame(rows, "text string, lang string"), refs).collect()
    assert not any(r["base_failed"] for r in out) and all(r["class_distance"] <= quality.CLASS_LIMIT for r in out)
    assert not any(r["kept"] for r in out)


def test_js_distance():
    q = np.array([1.0, 1.0, 0.0])
    p = np.array([[2.0, 2.0, 0.0], [0.0, 0.0, 5.0], [0.0, 0.0, 0.0], [1.0, 0.0, 0.0]])
    got = quality.js_distance(p, q)
    divergence = 0.5 * (math.log2(1 / 0.75) + 0.5 * math.log2(0.5 / 0.75) + 0.5 * math.log2(0.5 / 0.25))
    assert np.allclose(got, [0, 1, 0, math.sqrt(divergence)])


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("block", [7, 1024])
def test_tokens_equal_the_public_library(monkeypatch, reference, block):
    monkeypatch.setattr(bpe.boundaries, "__defaults__", (block,))
    parts = ["'", "'s", "'re", "'ll", "'l", "'v", "'ve", "s", "re", "a", "\u00e9", "1", "\u00b2", " ", "  ", "\n", "\t", "\u3000"]
    parts += ["!", "?!", "\u65e5", "\u0301", "\x1c", "\x85", "\U0001f4a5", "d", "'d", "'t", "m"]
    random.seed(5)
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 30))) for _ in range(4000)]
    texts += ["a" * 3000, "ab" * 2000 + " ", "", " ", "x'", "'"]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    own = bpe.Codec(PATH)
    ids, starts, per_row = own.encode(data, offsets)
    cuts = np.cumsum([0, *per_row])
    for i, text in enumerate(texts):
        assert ids[cuts[i] : cuts[i + 1]].tolist() == reference.encode_ordinary(text), text
    out, n_bytes = own.decode(ids.tobytes(), starts.tobytes(), per_row)
    assert out.tobytes() == b"".join(raw) and n_bytes.tolist() == [len(r) for r in raw]


def test_bytes_that_are_not_utf8_come_back():
    raw = [b"ab\xff\xfe c", b"\xe2\x82", b"ok"]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    own = bpe.Codec(PATH)
    out, _ = own.decode(*(x.tobytes() for x in own.encode(data, offsets)[:2]), own.encode(data, offsets)[2])
    assert out.tobytes() == b"".join(raw)


def test_round_trip_of_odd_texts(odd, none, reference):
    encoded = bpe.encode(odd)
    assert set(encoded.columns) == {*odd.columns, "starts"}
    rows = bpe.decode(encoded).collect()
    assert len(rows) == odd.count()
    for r in rows:
        text = r["text"] or ""
        assert bytes(r["decoded"]).decode() == text
        if len(text) < 1000:
            assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == reference.encode_ordinary(text)
    assert bpe.digests(bpe.decode(bpe.encode(none))).count() == 0


def test_the_pipeline_holds_one_python_worker_for_a_task(spark, sf_dir, odd, none):
    """Encoding and decoding of a document are one step outside the JVM, with the results of the two calls in a row."""
    for docs in (odd, none):
        got, want = bpe.round_trip(docs), bpe.decode(bpe.encode(docs))
        assert got.schema == want.schema
        assert Counter(map(repr, got.collect())) == Counter(map(repr, want.collect()))
    out = corpus_pipeline.byte_bpe(spark, odd, sf_dir)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_long_slices_are_not_cached():
    own = bpe.Codec(PATH)
    short, long = b" cached", b"\xe6\xbc\xa2" * 4_000
    assert own.pieces[short] == own.pieces[short] and own.pieces[long] == own.pieces[long]
    assert list(own.pieces) == [short]
    assert sum(map(len, own.pieces)) <= bpe.CACHE * bpe.CACHED_BYTES
