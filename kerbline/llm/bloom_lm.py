"""Language-model scores from a log-frequency Bloom filter.

Counts of tokens and of adjacent pairs are quantised to powers of two: level j stands for counts from 2^(j-1) up to 2^j.
An n-gram of level j is entered as (n-gram, 1) to (n-gram, j), so its level is found by probing 1, 2, ... until a probe
fails. All tokens and pairs are entered. The filter is cut into ranges of the n-grams' hashes, as many as the input needs
for each to stay small, and no task holds more than one of them.

One pass asks everything. Texts are taken in parts of some MB; each part sends its distinct n-grams, sorted and packed, with
how often the texts to learn from hold them, to the ranges they belong to. There the counts meet, the range's piece of the
filter is filled, and the same n-grams are probed: the levels found, a byte each in the order asked, go back to the part,
and tokens also get their exact counts, for the base score. The part's texts meet their levels in one shuffle and are scored.
No n-gram moves twice, and nothing is broadcast: the filter stays where it is and the probes travel.

The model interpolates pairs with single tokens: P(w|u) = l * c(uw)/c(u) + (1 - l) * P(w), l = c(u) / (c(u) + KAPPA),
P(w) = (c(w) + ALPHA) / (N + ALPHA * (V + 1)), with the counts that the filter gives. A text's score is the sum of log10 P
over its tokens and the end, which is also what the first token follows.

Tokens are told apart by 64-bit hashes, pairs by 48 bits, of which any two share one far less often than the filter errs.

Edge cases: null text counts as empty and has one token, the end; without texts to learn from N and V are 0 and all scores
0; repeated rows are separate texts; a null in ``learn`` counts as false; texts of any length are scored whole, tokens of
any length are one token; further columns may have any names.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kerbline.llm.buffers import LOWER, SYMBOL_CODES, Hasher, mix, word_bounds
from kerbline.llm.frames import as_text, located, mapped, written

END = b"\n"  # no word holds white space
ALPHA, KAPPA = 0.1, 5.0
BITS_PER_ENTRY, PROBES = 10, 6
PAIR = np.uint64(0x9FB21C651E98DF25)
PAIR_BITS = 48
#: A range's share of the texts, in bytes, and the least number of ranges, for which the rest of a pair takes five bytes.
RANGE_BYTES, LEAST_RANGES = 8 << 20, 256
#: Texts that may share a part: 2^PART_BITS bytes at most, unless it is a single text. A task holds so many bytes in all.
PART_BITS, HELD_BYTES = 23, 24 << 20
_CHUNK = ["file_id", "size", "block"]
_PLACE = "file_id long, size int, block long, first long, last long"
_ASKED = f"range long, {_PLACE}, pairs binary, times binary, more binary, tokens binary, token_times binary"
_ANSWERED = f"range long, {_PLACE}, levels binary, token_levels binary, counts binary, n long, v long, bits binary"


def _hashes(data, starts, ends):
    return mix(Hasher(SYMBOL_CODES[data]).of(starts, ends))


END_CODE = _hashes(np.frombuffer(END, np.uint8), np.array([0]), np.array([len(END)]))[0]


def token_codes(data, offsets):
    """(codes, rows) of all tokens in text order; the end of a text is its last token."""
    data = LOWER[data]
    starts, ends, rows = word_bounds(data, offsets)
    n_rows = len(offsets) - 1
    last = np.cumsum(np.bincount(rows, minlength=n_rows))
    return np.insert(_hashes(data, starts, ends), last, END_CODE), np.insert(rows, last, np.arange(n_rows))


def pair_codes(codes, rows):
    """Code of each token with the one before it; the first follows the end."""
    before = np.full(len(codes), END_CODE, np.uint64)
    before[1:] = np.where(rows[1:] == rows[:-1], codes[:-1], END_CODE)
    return mix(before * PAIR + codes) >> np.uint64(64 - PAIR_BITS)


def level_of(counts):
    """Level of each count: 1 for 1, 2 for 2 and 3, 3 for 4 to 7; 0 for 0."""
    return np.frexp(counts.astype(float))[1] * (counts > 0)


def middle(level):
    """Middle of the counts that each level stands for."""
    return np.where(level > 0, 2.0 ** (level - 0.5), 0.0)


class Filter:
    """One range's piece of the filter."""

    def __init__(self, bits):
        self.bits = bits
        self.size = np.uint64(8 * len(bits))

    @classmethod
    def of(cls, codes, levels):
        """The filter of n-grams with these codes and levels."""
        entries = int(levels.sum())
        own = cls(np.zeros(-(-entries * BITS_PER_ENTRY // 8), np.uint8))
        for level in range(1, int(levels.max(initial=0)) + 1):
            for place in own._spots(codes[levels >= level], level):
                np.bitwise_or.at(own.bits, place >> 3, (1 << (place & 7)).astype(np.uint8))
        return own

    def _spots(self, codes, level):
        """Places of (n-gram, level), one array for each probe."""
        code = mix(codes + np.uint64(level * int(PAIR) & (1 << 64) - 1))
        step = (code >> np.uint64(32)) | np.uint64(1)
        for _ in range(PROBES):
            yield (code % self.size).astype(np.int64)
            code = code + step

    def levels(self, codes):
        """Level of each n-gram, 0 where it is not held: probes of rising levels until one fails."""
        out = np.zeros(len(codes), np.int64)
        alive, level = np.arange(len(codes) if self.size else 0), 1
        while len(alive):
            held = np.ones(len(alive), bool)
            for place in self._spots(codes[alive], level):
                held &= (self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0
            alive = alive[held]
            out[alive] = level
            level += 1
        return out


def range_count(n_bytes):
    """A power of two."""
    return max(LEAST_RANGES, 1 << max(0, -(-n_bytes // RANGE_BYTES) - 1).bit_length())


def chunked(rows, text, learn):
    """file_id, size, block, row, text and learn of located rows, and their other columns as ``own``.

    Texts of a like size (``size`` is the number of bits of their length, from 12 in steps of 3) that lie near each other in
    a file share a chunk of at most 2^PART_BITS bytes, or one text; a chunk is read in one or more parts.
    """
    length = F.octet_length(text)
    bits = F.when(length > 0, F.floor(F.log2(F.greatest(length, F.lit(1)))) + 1).otherwise(0)
    size = F.greatest(F.lit(12), F.ceil(bits / 3) * 3).cast("int")
    kept = rows.select(F.xxhash64("file").alias("file_id"), "row", text.alias("text"), learn.alias("learn"), size.alias("size"), "own")
    block = F.expr(f"shiftright(row, greatest(0, {PART_BITS} - size))")
    return kept.withColumn("block", block)


class _Part:
    """Texts of one chunk that are read together."""

    def __init__(self):
        self.rows, self.texts, self.learn, self.size = [], [], [], 0

    def add(self, row, text, learn):
        self.rows.append(row)
        self.texts.append(text)
        self.learn.append(learn)
        self.size += len(text) + 64

    def tokens(self):
        return token_codes(np.frombuffer(b"".join(self.texts), np.uint8), np.cumsum([0, *map(len, self.texts)]))


def _packed(values, width):
    """The lowest ``width`` bytes of each value."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])


def _unpacked(data, width):
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = data.reshape(-1, width)
    return out.view("<u8").ravel()


def _width(ranges):
    return -(-(PAIR_BITS - (ranges.bit_length() - 1)) // 8)


def asked(part, chunk, ranges):
    """A row for each range: the part's distinct pairs and tokens in it, and how often texts to learn from hold them."""
    codes, rows = part.tokens()
    learn = np.array(part.learn, np.int64)[rows]
    kinds = []
    for found, shift in ((pair_codes(codes, rows), PAIR_BITS), (codes, 64)):
        distinct, place = np.unique(found, return_inverse=True)
        times = np.bincount(place, weights=learn).astype(np.int64)
        borders = np.searchsorted(distinct >> np.uint64(shift - (ranges.bit_length() - 1)), np.arange(ranges + 1))
        kinds.append((distinct, times, borders))
    (pairs, times, at), (tokens, token_times, token_at) = kinds
    low = _packed(pairs, _width(ranges))
    once = np.minimum(times, 255).astype(np.uint8)
    used = np.flatnonzero((np.diff(at) > 0) | (np.diff(token_at) > 0))
    spans = [(slice(at[r], at[r + 1]), slice(token_at[r], token_at[r + 1])) for r in used]
    n = len(used)
    columns = [pa.array(used.astype(np.int64))]
    columns += [pa.array([value] * n, kind) for value, kind in zip(chunk, (pa.int64(), pa.int32(), pa.int64()))]
    columns += [pa.array([value] * n, pa.int64()) for value in (part.rows[0], part.rows[-1])]
    columns.append(pa.array([low[s].tobytes() for s, _ in spans], pa.binary()))
    columns.append(pa.array([once[s].tobytes() for s, _ in spans], pa.binary()))
    columns.append(pa.array([(times[s][once[s] == 255]).tobytes() for s, _ in spans], pa.binary()))
    columns.append(pa.array([tokens[s].tobytes() for _, s in spans], pa.binary()))
    columns.append(pa.array([token_times[s].astype("<u4").tobytes() for _, s in spans], pa.binary()))
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _ASKED.split(", ")])


def _ask(ranges):
    def run(batches):
        held, size = {}, 0
        for batch in batches:
            chunks = zip(*(batch.column(c).to_pylist() for c in _CHUNK))
            rows, learn, texts = (batch.column(c) for c in ("row", "learn", "text"))
            for chunk, row, text, own in zip(chunks, rows.to_pylist(), texts, learn.to_pylist()):
                part = held.setdefault(chunk, _Part())
                part.add(row, text.as_py(), own)
                size += len(part.texts[-1]) + 64
                while size > HELD_BYTES:
                    chunk = max(held, key=lambda c: held[c].size)
                    size -= held[chunk].size
                    yield asked(held.pop(chunk), chunk, ranges)
        for chunk, part in held.items():
            yield asked(part, chunk, ranges)

    return run


def _joined(column, kind):
    """(values of all rows together, borders of the rows)."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    raw = [v.as_buffer() for v in values]
    sizes = np.array([len(b) for b in raw]) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(raw), kind), np.concatenate([[0], np.cumsum(sizes)])


def _answer(ranges):
    """Fills the filter of one range and probes it for all parts."""
    width = _width(ranges)

    def run(table):
        data, at = _joined(table.column("pairs"), np.uint8)
        pairs, at = _unpacked(data, width), at // width
        times, _ = _joined(table.column("times"), np.uint8)
        times = times.astype(np.int64)
        times[times == 255] = _joined(table.column("more"), "<i8")[0]
        tokens, token_at = _joined(table.column("tokens"), "<u8")
        token_times = _joined(table.column("token_times"), "<u4")[0]
        distinct, place = np.unique(pairs, return_inverse=True)
        totals = np.bincount(place, weights=times, minlength=len(distinct)).astype(np.int64)
        words, word_place = np.unique(tokens, return_inverse=True)
        word_totals = np.bincount(word_place, weights=token_times, minlength=len(words)).astype(np.int64)
        # the codes of pairs are below 2^48, so that they differ from those of tokens
        codes, counts = np.concatenate([distinct, words | np.uint64(1 << 63)]), np.concatenate([totals, word_totals])
        own = Filter.of(codes, level_of(counts))
        levels = own.levels(codes).astype(np.uint8)
        of_pairs, of_words = levels[: len(distinct)][place], levels[len(distinct) :][word_place]
        of_counts = word_totals[word_place]
        n = len(table)

        def dealt(values, borders):
            return pa.array([values[a:b].tobytes() for a, b in zip(borders[:-1], borders[1:])] + [None], pa.binary())

        number = table.column("range")[0].as_py()
        columns = [pa.array([number] * (n + 1), pa.int64())]
        for c in (*_CHUNK, "first", "last"):
            values = table.column(c).combine_chunks()
            columns.append(pa.concat_arrays([values, pa.nulls(1, values.type)]))
        columns += [dealt(of_pairs, at), dealt(of_words, token_at), dealt(of_counts, token_at)]
        columns += [pa.array([None] * n + [value], pa.int64()) for value in (int(word_totals.sum()), int((word_totals > 0).sum()))]
        columns.append(pa.array([None] * n + [own.bits.tobytes()], pa.binary()))
        return pa.Table.from_arrays(columns, [c.split()[0] for c in _ANSWERED.split(", ")])

    return run


def _log_probabilities(codes, rows, n_rows, own, joint, n, v):
    """log10 P of each text, from the levels of its tokens and pairs."""
    own, joint = middle(own), middle(joint)
    end = own[-1]  # the last token is the end
    context = np.full(len(codes), end)
    context[1:] = np.where(rows[1:] == rows[:-1], own[:-1], end)
    joint = np.where((own > 0) & (context > 0), np.minimum(joint, context), 0.0)  # held only if both tokens are
    weight = context / (context + KAPPA)
    alone = (own + ALPHA) / (n + ALPHA * (v + 1))
    share = np.divide(joint, context, out=np.zeros(len(codes)), where=context > 0)
    return np.bincount(rows, weights=np.log10(weight * share + (1 - weight) * alone), minlength=n_rows)


def _score(n, v):
    """Scores of the texts of a chunk, from the answers to its parts."""
    scale = n + ALPHA * (v + 1)

    def run(texts, answers):
        texts = texts.sort_by("row")
        answers = answers.sort_by([("first", "ascending"), ("range", "ascending")])
        row_of = texts.column("row").to_numpy()
        own_column, raw = texts.column("own"), texts.column("text")
        first, last = (answers.column(c).to_numpy() for c in ("first", "last"))
        starts = np.flatnonzero(np.diff(first, prepend=-1)) if len(first) else []
        out = [[] for _ in range(5)]
        for a, b in zip(starts, [*starts[1:], len(first)]):
            low, high = np.searchsorted(row_of, [first[a], last[a] + 1])
            part = _Part()
            for text in raw.slice(low, high - low):
                part.add(0, text.as_py(), 0)
            codes, rows = part.tokens()
            places = [np.unique(found, return_inverse=True)[1] for found in (pair_codes(codes, rows), codes)]
            answer = answers.slice(a, b - a)
            joint, own, counts = (_joined(answer.column(c), k)[0] for c, k in (("levels", "u1"), ("token_levels", "u1"), ("counts", "<i8")))
            joint, own, counts = joint[places[0]].astype(np.int64), own[places[1]].astype(np.int64), counts[places[1]]
            size = high - low
            out[0].append(own_column.slice(low, size).combine_chunks())
            out[1].append(np.bincount(rows, minlength=size))
            out[2].append(np.bincount(rows, weights=counts > 0, minlength=size).astype(np.int64))
            out[3].append(np.bincount(rows, weights=np.log10((counts + ALPHA) / scale), minlength=size))
            out[4].append(_log_probabilities(codes, rows, size, own, joint, n, v))
        names = ["own", "n_tokens", "n_known", "base_score", "score"]
        columns = [pa.concat_arrays(out[0]) if out[0] else own_column.combine_chunks()]
        columns += [pa.array(np.concatenate(c) if c else np.zeros(0)) for c in out[1:]]
        return pa.Table.from_arrays(columns, names)

    return run


def answers(texts, ranges):
    """What the ranges answer to the parts of ``texts`` (see ``chunked``), and for each range a row with the number of its
    tokens and of its distinct ones in the texts to learn from, and its bits of the filter."""
    slim = texts.select(*_CHUNK, "row", "learn", "text")
    requests = mapped(slim, _ask(ranges), _ASKED)
    return written(requests.groupBy("range").applyInArrow(_answer(ranges), _ANSWERED), "answers")


def score(docs, learn, ranges=None):
    """n_tokens, n_known, train_tokens, base_score and score of every row of ``docs`` (column ``text``), learning from those
    where the column ``learn`` is true; with the other columns of ``docs``, but for the text."""
    added = {"n_tokens", "n_known", "train_tokens", "base_score", "score"}
    own = [c for c in docs.columns if c.lower() not in added and c != "text"]
    rows = located(docs).select(
        "file", "row", F.struct(*[F.col("doc").getField(c).alias(c) for c in own]).alias("own"), "doc"
    )
    learning = F.coalesce(F.col("doc").getField(learn), F.lit(False))
    texts = chunked(rows, as_text(F.col("doc").getField("text")), learning)
    if ranges is None:
        ranges = range_count(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    found = answers(texts, ranges)
    n, v = (x or 0 for x in found.agg(F.sum("n"), F.sum("v")).first())
    schema = texts.select("own").schema
    for name, kind in (("n_tokens", "long"), ("n_known", "long"), ("base_score", "double"), ("score", "double")):
        schema = schema.add(name, kind)
    back = found.where("file_id IS NOT NULL").select(*_CHUNK, "range", "first", "last", "levels", "token_levels", "counts")
    mine = texts.select(*_CHUNK, "row", "text", "own")
    scored = mine.groupBy(*_CHUNK).cogroup(back.groupBy(*_CHUNK)).applyInArrow(_score(n, v), schema)
    return scored.select(
        *[F.col("own").getField(c).alias(c) for c in own],
        "n_tokens",
        "n_known",
        F.lit(int(n)).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
