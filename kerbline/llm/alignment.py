"""Alignment of two tokenizers over a corpus, with an inverted index of bitmaps over the pairs of their tokens.

Every text is cut by a byte-level BPE (A, which gets a space before the text) and by a piece model (B, which adds one).
Where tokens of both end at the same byte they are linked; the stretches between such places are groups.

The index holds for each pair of linked token ids the documents with such a link, as bitmaps of blocks of 2^16 documents:
a sorted list of 16-bit numbers, or 65,536 bits where more than ``SPARSE`` are set. Plane 0 of a pair marks the documents
that have it; plane j > 0 marks those where bit j - 1 of (links in the document - 1) is set, so

    documents of a pair = popcount(plane 0),     links of a pair = popcount(plane 0) + sum of 2^(j-1) * popcount(plane j).

Texts are tokenised once. A task makes bitmaps of bounded stretches of documents; those of the same pair, block and plane
are OR-merged, partitioned by pair and block, so a pair that is everywhere is spread over its blocks. Popcounts are added up
per pair. Scores go back along the postings: each bitmap is joined with its pair's count and adds it, block by block, to the
documents it marks.

Edge cases: a text that is null, empty or not UTF-8, or whose joined tokens of A or B are not a space and the text, has no
tokens: zeros, and '' for its groups; strings of special tokens are plain text; repeated rows are separate documents, told
apart by their place in the files; a null doc_id is kept; ties of counts are all best; empty tables give no rows; texts of
any length are cut whole; further columns may have any names.
"""

import hashlib
import json
import os
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from kerbline.llm.buffers import parts
from kerbline.llm.frames import as_text, located, mapped, written

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: A list of more documents than this becomes a bitmap; both then differ in length.
SPARSE = 4095
BITMAP_BYTES = 8192
FLUSH_LINKS = 1 << 20
#: Fixed value: the mark for a space in pieces.
PIECE_SPACE = "▁"
_PLACE = ["file_id", "block", "pair", "plane"]
_INDEX = "file_id long, block long, pair long, plane int, docs binary"
_DOCUMENT = "doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string"


def byte_level_alphabet():
    """{character: byte} of byte-level vocabularies: printable bytes stand for themselves, the others follow from 256."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """Tokenizer A, from its JSON file.

    Where the file's merges are numbered as their tokens are, and nothing but the byte-level split comes before them, its
    tokens are those of byte-pair merging by rank, which tiktoken does several times faster. Any other file is left to the
    library it was written for.
    """

    def __init__(self, path):
        with open(path, encoding="utf-8") as lines:
            spec = json.load(lines)
        alphabet = byte_level_alphabet()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocabulary = {text: number for text, number in spec["model"]["vocab"].items() if text not in special}
        self.tokens = [b""] * (1 + max([*vocabulary.values(), *special.values()]))
        for text, number in vocabulary.items():
            self.tokens[number] = bytes(map(alphabet.__getitem__, text))
        for text, number in special.items():
            self.tokens[number] = text.encode()
        if by_rank(spec, vocabulary):
            ranks = {self.tokens[number]: number for number in vocabulary.values()}
            own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.encode = lambda texts: [own.encode_ordinary(" " + t) for t in texts]
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            library = Tokenizer.from_file(path)
            library.encode_special_tokens = True
            self.encode = lambda texts: [
                e.ids for e in library.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
            ]


def by_rank(spec, vocabulary):
    """Whether byte-pair merging by rank gives the tokens of this file."""
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    extras = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
    if not plain or spec["normalizer"] or any(model.get(x) for x in extras):
        return False
    merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    return [vocabulary.get(m) for m in merges] == list(range(256, 256 + len(merges))) and len(vocabulary) == 256 + len(merges)


class Pieces:
    """Tokenizer B."""

    def __init__(self, path):
        self.own = SentencePieceProcessor(model_file=path)
        self.tokens = [
            bytes([int(self.own.id_to_piece(i)[3:-1], 16)])
            if self.own.is_byte(i)
            else self.own.id_to_piece(i).replace(PIECE_SPACE, " ").encode()
            for i in range(self.own.get_piece_size())
        ]

    def encode(self, texts):
        return self.own.encode(texts, num_threads=1)


_made = {}


def _loaded(kind, path):
    if (kind, path) not in _made:
        _made[kind, path] = kind(path)
    return _made[kind, path]


def _decoded(raw):
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return ""


def cut(tokenizer, raws):
    """(ids of all texts, number of ids of each); a text that its tokens do not spell has none."""
    found = tokenizer.encode([_decoded(raw) for raw in raws])
    spelt = tokenizer.tokens
    for i, (raw, ids) in enumerate(zip(raws, found)):
        if not raw or b"".join([spelt[k] for k in ids]) != b" " + raw:
            found[i] = []
    sizes = np.array([len(ids) for ids in found], np.int64)
    return found, sizes


def _flat(found, sizes):
    return np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum()))


_DIGITS = np.zeros((1 << 16, 6), np.uint8)
for _k in range(5):
    _value = np.arange(1 << 16) // 10**_k
    _DIGITS[:, 4 - _k] = np.where((_value > 0) | (_k == 0), _value % 10 + ord("0"), 0)


def group_texts(a, b, last_a, last_b, bounds):
    """``a1,a2|b1;a3|b2,b3`` of each text as bytes. ``last_a`` and ``last_b`` are the last tokens of each group, ``bounds``
    the texts' borders among the tokens of both."""
    flag_a, flag_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    flag_a[last_a] = flag_b[last_b] = 1
    first_b = np.concatenate([[0], last_b + 1])  # tokens of B before each group
    group_a, group_b = np.cumsum(flag_a) - flag_a, np.cumsum(flag_b) - flag_b
    line = np.zeros((len(a) + len(b), 6), np.uint8)
    for at, ids, flags, mark in (
        (np.arange(len(a)) + first_b[group_a], a, flag_a, "|"),
        (np.arange(len(b)) + last_a[group_b] + 1 if len(b) else np.zeros(0, np.int64), b, flag_b, ";"),
    ):
        line[at] = _DIGITS[ids]
        line[at, 5] = np.where(flags, ord(mark), ord(","))
    ends = np.concatenate([[0], np.cumsum(np.count_nonzero(line, axis=1))])[bounds]
    raw = line[line != 0].tobytes()
    return [raw[x : max(x, y - 1)] for x, y in zip(ends[:-1], ends[1:])]


def links(a, b, lengths_a, lengths_b):
    """(last tokens of A, last tokens of B) of the groups: where tokens of both end at the same byte."""
    _, last_a, last_b = np.intersect1d(
        np.cumsum(lengths_a[a]), np.cumsum(lengths_b[b]), assume_unique=True, return_indices=True
    )
    return last_a, last_b


def bitmaps(groups, numbers):
    """One binary value for each run of equal ``groups``, of its ascending, distinct 16-bit ``numbers``."""
    edges = np.flatnonzero(np.diff(groups)) + 1
    starts = np.concatenate([[0], edges]) if len(groups) else edges
    sizes = np.diff(np.append(starts, len(groups)))
    data = np.ascontiguousarray(numbers, "<u2")
    if sizes.max(initial=0) <= SPARSE:
        offsets = np.append(starts, len(groups)).astype(np.int32) * 2
        return starts, pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    out = []
    for low, size in zip(starts.tolist(), sizes.tolist()):
        part = data[low : low + size]
        if size > SPARSE:
            flags = np.zeros(1 << 16, np.uint8)
            flags[part] = 1
            part = np.packbits(flags, bitorder="little")
        out.append(part.tobytes())
    return starts, pa.array(out, pa.binary())


def marked(values):
    """(index, number) of all documents that the bitmaps of a binary column mark."""
    values = values.cast(pa.large_binary())
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(data if data is not None else b"", np.uint8)
    sizes = np.diff(offsets)
    lists = sizes < BITMAP_BYTES
    inside = np.repeat(lists, sizes)
    rows = [np.repeat(np.flatnonzero(lists), sizes[lists] // 2)]
    numbers = [np.ascontiguousarray(data[offsets[0] : offsets[-1]][inside]).view("<u2").astype(np.int64)]
    for i in np.flatnonzero(~lists):
        more = np.flatnonzero(np.unpackbits(data[offsets[i] : offsets[i + 1]], bitorder="little"))
        rows.append(np.full(len(more), i))
        numbers.append(more)
    return np.concatenate(rows), np.concatenate(numbers)


def _nulls(schema, n):
    return [pa.nulls(n, field.type) for field in schema]


class _Postings:
    """The links of some documents of one block of a file, as bitmaps."""

    def __init__(self):
        self.keys, self.size, self.place = [], 0, None

    def add(self, place, pairs, numbers):
        if self.place not in (None, place) or self.size >= FLUSH_LINKS:
            yield from self.flush()
        self.place = place
        self.keys.append(pairs.astype(np.uint64) << np.uint64(16) | numbers.astype(np.uint64))
        self.size += len(pairs)

    def flush(self):
        if self.size:
            keys, times = np.unique(np.concatenate(self.keys), return_counts=True)
            pairs, numbers, more = (keys >> np.uint64(16)).astype(np.int64), keys & np.uint64(0xFFFF), times - 1
            for plane in range(1 + int(more.max()).bit_length()):
                chosen = slice(None) if plane == 0 else np.flatnonzero(more >> (plane - 1) & 1)
                starts, values = bitmaps(pairs[chosen], numbers[chosen])
                if len(starts):
                    n = len(starts)
                    yield [
                        pa.array(np.full(n, self.place[0])),
                        pa.array(np.full(n, self.place[1])),
                        pa.array(pairs[chosen][starts]),
                        pa.array(np.full(n, plane, np.int32)),
                        values,
                    ]
        self.keys, self.size, self.place = [], 0, None


_DOC_FIELDS = [pa.field(n, t) for n, t in (
    ("doc_id", pa.int64()), ("row", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("groups", pa.string()),
)]
_INDEX_FIELDS = [pa.field(n, t) for n, t in (
    ("file_id", pa.int64()), ("block", pa.int64()), ("pair", pa.int64()), ("plane", pa.int32()), ("docs", pa.binary()),
)]
_NAMES = [f.name for f in _INDEX_FIELDS + _DOC_FIELDS]


def _aligned(a_path, b_path, keep_groups):
    def run(batches):
        one, two = _loaded(ByteLevel, a_path), _loaded(Pieces, b_path)
        lengths = [np.array([len(t) for t in x.tokens], np.int64) for x in (one, two)]
        postings = _Postings()

        def posted(rows):
            for columns in rows:
                yield pa.RecordBatch.from_arrays(columns + _nulls(_DOC_FIELDS, len(columns[0])), _NAMES)

        for batch in batches:
            files, rows = (batch.column(c).to_numpy() for c in ("file_id", "row"))
            for low, high, data, offsets in parts(batch, "text"):
                raw = data.tobytes()
                raws = [raw[x:y] for x, y in zip(offsets[:-1], offsets[1:])]
                (found_a, sizes_a), (found_b, sizes_b) = cut(one, raws), cut(two, raws)
                for i in np.flatnonzero((sizes_a == 0) | (sizes_b == 0)):
                    found_a[i], found_b[i], sizes_a[i], sizes_b[i] = [], [], 0, 0
                a, b = _flat(found_a, sizes_a), _flat(found_b, sizes_b)
                last_a, last_b = links(a, b, *lengths)
                ends_a, ends_b = (np.concatenate([[0], np.cumsum(s)]) for s in (sizes_a, sizes_b))
                borders = np.searchsorted(last_a, ends_a)
                groups = group_texts(a, b, last_a, last_b, ends_a + ends_b)
                n = high - low
                linked = pa.array(np.diff(borders))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(files[low:high]),
                        *_nulls(_INDEX_FIELDS[1:], n),
                        batch.column("doc_id").slice(low, n),
                        pa.array(rows[low:high]),
                        pa.array(sizes_a),
                        pa.array(sizes_b),
                        linked,
                        linked,
                        pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in groups]),
                        pa.array([g.decode() for g in groups]) if keep_groups else pa.nulls(n, pa.string()),
                    ],
                    _NAMES,
                )
                pairs = a[last_a] << 16 | b[last_b]
                for i in np.flatnonzero(np.diff(borders)):
                    own = pairs[borders[i] : borders[i + 1]]
                    place = int(files[low + i]), int(rows[low + i]) >> 16
                    yield from posted(postings.add(place, own, np.full(len(own), rows[low + i] & 0xFFFF)))
        yield from posted(postings.flush())

    return run


def align(docs, a_path=None, b_path=None, keep_groups=False):
    """(documents, postings): the counts and groups of every document, and the bitmaps of the token pairs it has.

    documents has doc_id, file_id, row, n_a, n_b, n_groups, n_links, groups_sha256 and, on request, groups; postings has
    file_id, block, pair (id of A * 2^16 + id of B), plane and docs, with one row or more for a pair, block and plane.
    """
    a_path, b_path = a_path or public_tokenizers.path(BYTE_LEVEL), b_path or public_tokenizers.path(PIECES)
    texts = located(docs.select("doc_id", "text")).select(
        F.col("doc.doc_id").cast("long").alias("doc_id"),
        F.xxhash64("file").alias("file_id"),
        "row",
        as_text(F.col("doc.text")).alias("text"),
    )
    both = written(mapped(texts, _aligned(a_path, b_path, keep_groups), f"{_INDEX}, {_DOCUMENT}"), "alignment")
    documents = both.where("pair is null").drop("block", "pair", "plane", "docs")
    return documents, both.where("pair is not null").select(*_PLACE, "docs")


def _merged(batches):
    """OR of the bitmaps with the same place; rows come sorted by place, a group may go on in the next batch."""

    def flush(table):
        table = table.combine_chunks()
        keys = [table.column(c).to_numpy() for c in _PLACE]
        new = np.zeros(len(table), bool)
        new[:1] = True
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
        group = np.cumsum(new) - 1
        row, number = marked(table.column("docs").chunk(0))
        both = np.unique(group[row] << 16 | number)
        starts, values = bitmaps(both >> 16, both & 0xFFFF)
        sizes = np.diff(np.append(starts, len(both)))
        first = np.flatnonzero(new)
        return pa.RecordBatch.from_arrays(
            [*[pa.array(key[first]) for key in keys], values, pa.array(sizes)], [*_PLACE, "docs", "popcount"]
        )

    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        last = np.ones(len(table), bool)
        for c in _PLACE:
            values = table.column(c).to_numpy()
            last &= values == values[-1]
        n = int(len(table) - last[::-1].argmin()) if not last.all() else 0
        held = table.slice(n)
        if n:
            yield flush(table.slice(0, n))
    if held is not None and len(held):
        yield flush(held)


def merge(postings):
    """One bitmap for each pair, block and plane, with its popcount."""
    dealt = postings.repartition(F.col("pair"), F.col("file_id"), F.col("block")).sortWithinPartitions(*_PLACE)
    return written(mapped(dealt, _merged, f"{_INDEX}, popcount long"), "bitmaps")


def pair_counts(merged):
    """pair, documents, links, best (no other token of A has more links with its token of B)."""
    weight = F.when(F.col("plane") > 0, F.call_function("shiftleft", F.lit(1).cast("long"), F.col("plane") - 1)).otherwise(F.lit(1))
    counts = merged.groupBy("pair").agg(
        F.sum(F.when(F.col("plane") == 0, F.col("popcount")).otherwise(0)).alias("documents"),
        F.sum(F.col("popcount") * weight).alias("links"),
    )
    counts = written(counts, "pairs")
    of_b = F.col("pair").bitwiseAND(F.lit(0xFFFF))
    most = counts.groupBy(of_b.alias("b")).agg(F.max("links").alias("most"))  # a row for each token of B at most
    joined = counts.withColumn("b", of_b).join(F.broadcast(most), "b")
    return joined.select("pair", "documents", "links", (F.col("links") == F.col("most")).alias("best"))


def _scored(batches):
    """Adds up what the bitmaps of a block give its documents; rows come sorted by block."""
    place, best, total = None, None, None

    def flush():
        at = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(at), place[0])),
                pa.array(place[1] * (1 << 16) + at),
                pa.array(best[at]),
                pa.array(total[at]),
            ],
            ["file_id", "row", "n_best", "count_sum"],
        )

    for batch in batches:
        files, blocks, planes, counts, bests = (
            batch.column(c).to_numpy(zero_copy_only=False) for c in ("file_id", "block", "plane", "links", "best")
        )
        row, number = marked(batch.column("docs"))
        weight = np.left_shift(np.int64(1), np.maximum(planes.astype(np.int64) - 1, 0))
        edges = np.flatnonzero((np.diff(files) != 0) | (np.diff(blocks) != 0)) + 1
        order = np.argsort(row, kind="stable")
        row, number = row[order], number[order]
        for low, high in zip([0, *edges], [*edges, len(batch)]):
            if place != (here := (int(files[low]), int(blocks[low]))):
                if place is not None:
                    yield flush()
                place, best, total = here, np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
            part = slice(*np.searchsorted(row, [low, high]))
            np.add.at(total, number[part], (weight * counts)[row[part]])
            np.add.at(best, number[part], (weight * bests)[row[part]])
    if place is not None:
        yield flush()


def scores(merged, pairs):
    """file_id, row, n_best, count_sum of every document with a link."""
    joined = merged.select(*_PLACE, "docs").join(pairs.select("pair", "links", "best"), "pair")
    dealt = joined.repartition(F.col("file_id"), F.col("block")).sortWithinPartitions("file_id", "block")
    return mapped(dealt, _scored, "file_id long, row long, n_best long, count_sum long")


def report(docs, a_path=None, b_path=None):
    documents, postings = align(docs, a_path, b_path)
    merged = merge(postings)
    found = documents.join(scores(merged, pair_counts(merged)), ["file_id", "row"], "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")]
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256")
