"""Token pairs of two tokenizers against a plain count per document."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from odd_rows import none, odd, real  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kerbline.llm import alignment
from kerbline.llm.queries import QUERIES

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def spelt(piece):
    if len(piece) == 6 and piece.startswith("<0x"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


def ends(tokens):
    out, at = [], 0
    for t in tokens:
        at += len(t)
        out.append(at)
    return out


def expected(rows):
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = alignment.byte_level_alphabet()
    per, total = [], Counter()
    for doc_id, text in rows:
        ids_a, ids_b, linked, groups = [], [], [], ""
        if text:
            found = a.encode(" " + text, add_special_tokens=False)
            ids_a, ids_b = found.ids, b.encode(text)
            tokens_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
            tokens_b = [spelt(b.id_to_piece(i)) for i in ids_b]
            if not b"".join(tokens_a) == b"".join(tokens_b) == b" " + text.encode():
                ids_a, ids_b = [], []
            else:
                ends_a, ends_b = ends(tokens_a), ends(tokens_b)
                common = sorted(set(ends_a) & set(ends_b))
                at_a, at_b = dict(zip(ends_a, range(len(ids_a)))), dict(zip(ends_b, range(len(ids_b))))
                x = y = 0
                for end in common:
                    i, j = at_a[end], at_b[end]
                    groups += ",".join(map(str, ids_a[x : i + 1])) + "|" + ",".join(map(str, ids_b[y : j + 1])) + ";"
                    linked.append((ids_a[i], ids_b[j]))
                    x, y = i + 1, j + 1
        per.append((doc_id, ids_a, ids_b, linked, groups[:-1]))
        total.update(linked)
    most = defaultdict(int)
    for (_, y), n in total.items():
        most[y] = max(most[y], n)
    out = []
    for doc_id, ids_a, ids_b, linked, groups in per:
        best = sum(total[p] == most[p[1]] for p in linked)
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        sizes = (len(ids_a), len(ids_b), len(linked), len(linked), best, sum(total[p] for p in linked))
        out.append((doc_id, *sizes, digest))
    return out


def ours(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_is_a_plain_count(spark, sf_dir, real):
    rows = [tuple(r) for r in real.select("doc_id", "text").collect()]
    assert ours(QUERIES["op11_tokenizer_alignment"](spark, sf_dir)) == sorted(expected(rows), key=repr)


def test_odd_rows(spark, odd, none):
    extra = [(90, "a▁b"), (91, "<|endoftext|> <s></s> <unk>"), (92, "x\u0000y ퟿"), (93, "é é  \n\n　"), (94, " ")]
    rows = odd.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    want = expected([tuple(r) for r in rows.collect()])
    assert any(w[1] == 0 for w in want if w[0] == 90)
    assert ours(alignment.report(rows.withColumn("pair", F.lit("x")).withColumn("file_id", F.lit(1)))) == sorted(want, key=repr)
    assert ours(alignment.report(none)) == []
    broken = spark.range(1).selectExpr("7L AS doc_id", "CAST(X'ff41' AS string) AS text")
    assert ours(alignment.report(broken)) == [(7, 0, 0, 0, 0, 0, 0, "")]


def test_pairs_are_counted_by_documents_and_links(spark, real, monkeypatch):
    rows = real.select("doc_id", "text").limit(40).cache()
    documents, postings = alignment.align(rows, keep_groups=True)
    assert documents.where("groups <> ''").count() > 30
    counts = alignment.pair_counts(alignment.merge(postings)).collect()
    inside, total = Counter(), Counter()
    for (groups,) in documents.select("groups").collect():
        linked = [tuple(int(side.split(",")[-1]) for side in g.split("|")) for g in groups.split(";") if g]
        total.update(linked)
        inside.update(set(linked))
    assert {(r["pair"] >> 16, r["pair"] & 0xFFFF): (r["documents"], r["links"]) for r in counts} == {
        p: (inside[p], total[p]) for p in total
    }


def test_bitmaps_merge_over_flushes_and_turn_dense():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 1 << 16, n)) for n in (3, 4095, 9000, 60_000)]
    groups = np.repeat(np.arange(4), [len(s) for s in sets])
    _, values = alignment.bitmaps(groups, np.concatenate(sets))
    assert [len(v) for v in values.to_pylist()][2:] == [8192, 8192]
    row, number = alignment.marked(values)
    assert all(np.array_equal(np.sort(number[row == i]), s) for i, s in enumerate(sets))
    halves = [(alignment.bitmaps(np.zeros(len(x), int), x)[1]) for x in (sets[3][::2], sets[3][1::2], sets[3])]
    place = [pa.array([5, 5, 5]), pa.array([0, 0, 0]), pa.array([7, 7, 8]), pa.array([0, 0, 0], pa.int32())]
    batch = pa.RecordBatch.from_arrays([*place, pa.concat_arrays(halves)], ["file_id", "block", "pair", "plane", "docs"])
    for split in ([batch], [batch.slice(0, 1), batch.slice(1, 1), batch.slice(2)]):
        merged = pa.Table.from_batches(list(alignment._merged(iter(split))))
        assert merged.column("pair").to_pylist() == [7, 8]
        assert merged.column("popcount").to_pylist() == [len(sets[3])] * 2


def test_both_ways_to_cut_by_the_byte_level_file_agree(real, monkeypatch):
    path = public_tokenizers.path(alignment.BYTE_LEVEL)
    fast = alignment.ByteLevel(path)
    monkeypatch.setattr(alignment, "by_rank", lambda *_: False)
    plain = alignment.ByteLevel(path)
    texts = [r["text"] or "" for r in real.limit(60).collect()]
    texts += [f"a{chr(c)}b {chr(c)}1  {chr(c)} " for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or c % 7 == 0)]
    assert fast.encode(texts) == plain.encode(texts)
    assert fast.tokens == plain.tokens


def test_no_token_is_empty():
    for kind, name in ((alignment.ByteLevel, alignment.BYTE_LEVEL), (alignment.Pieces, alignment.PIECES)):
        assert all(kind(public_tokenizers.path(name)).tokens)
