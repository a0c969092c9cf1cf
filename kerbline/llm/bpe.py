"""Byte-level BPE: pre-tokenisation by scans over code-point classes, cached pair merging, decoding by offsets.

Pre-tokenisation reproduces the pattern of the public 50k vocabulary without a regular expression. Every code point
becomes a symbol (letter, number, other, kinds of white space, apostrophe before a contraction), which is a function from
automaton states to states. Function composition is associative: the chunk is cut into equal blocks, all blocks are run at
once from every possible state, the block functions are composed to get each block's entry state, and a second run over
the blocks marks the boundaries. Slices between boundaries are looked up in a cache of merged pieces; a miss merges pairs
by rank with a heap, so one long slice costs n log n.

Results: ``ids`` and ``starts`` hold unsigned 32-bit little-endian integers, one per token: the id and the byte offset in
the text. Decoding places each token's bytes at its offset.

Edge cases: null and empty texts have no tokens and decode to nothing. Bytes that are not UTF-8 are class "other" and
decode to themselves. White space at the end of a text stays together. Texts of any length are encoded whole. Repeated
rows and empty tables need nothing special. Other columns are kept; a column named like a result is replaced.
"""

import base64
import heapq
import unicodedata
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from kerbline.llm import buffers
from kerbline.llm.frames import as_text, fresh, mapped, schema_with

VOCABULARY = "byte_bpe_50k.tiktoken"
CACHE = 300_000
CACHED_BYTES = 64
CHUNK = 1 << 20
LETTER, NUMBER, OTHER, SPACE = range(4)
#: Symbols of the automaton; FIRST is added for the first code point of a text.
S_LETTER, S_NUMBER, S_OTHER, S_SHORT, S_LONG, S_INNER, S_LAST, S_BLANK, FIRST = *range(8), 8
#: States: the running slice, a blank that joins the next slice, a contraction with so many letters to come, or a cut.
IN_LETTER, IN_NUMBER, IN_OTHER, IN_SPACE, JOIN, ONE_MORE, TWO_MORE, CUT = range(8)
STATES, BOUNDARY = 8, 8
#: White space of the Unicode property White_Space.
WHITE_SPACE = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
BLOCK = 1024
SHORT, NO_RANK = 128, 1 << 30
_made = {}


def class_table():
    """Class of every code point; built once in a worker."""
    if "classes" not in _made:
        table = np.full(0x110000, OTHER, np.uint8)
        for code in range(0x110000):
            kind = unicodedata.category(chr(code))[0]
            if kind in "LN":
                table[code] = LETTER if kind == "L" else NUMBER
        table[list(WHITE_SPACE)] = SPACE
        _made["classes"] = table
    return _made["classes"]


def _step(state, symbol):
    """Next state, plus BOUNDARY where a slice begins at this code point."""
    if symbol >= FIRST:
        state, symbol = CUT, symbol - FIRST
    if state == ONE_MORE:
        return CUT
    if state == TWO_MORE:
        return ONE_MORE
    if symbol in (S_SHORT, S_LONG):
        if state not in (IN_OTHER, JOIN):
            return (ONE_MORE if symbol == S_SHORT else TWO_MORE) + BOUNDARY
        symbol = S_OTHER
    if symbol <= S_OTHER:
        return symbol if state in (symbol, JOIN) else symbol + BOUNDARY
    if symbol == S_INNER:
        return IN_SPACE if state == IN_SPACE else IN_SPACE + BOUNDARY
    return (CUT if symbol == S_LAST else JOIN) + BOUNDARY


TRANSITIONS = np.array([[_step(s, x) for s in range(STATES)] for x in range(2 * FIRST)], np.uint8)
#: By symbol * STATES + state.
NEXT, IS_BOUNDARY = (TRANSITIONS & 7).ravel().astype(np.intp), (TRANSITIONS >= BOUNDARY).ravel()


def symbols(codes, firsts):
    """Symbol of each code point, from its class and at most two code points behind it in the same text."""
    kind = class_table()[codes]
    n = len(codes)
    ahead = np.full(n, OTHER, np.uint8)
    ahead[:-1] = kind[1:]
    ends = np.zeros(n, bool)
    ends[:-1] = firsts[1:]
    ends[-1:] = True
    out = np.array([S_LETTER, S_NUMBER, S_OTHER, S_INNER], np.uint8)[kind]
    last = (kind == SPACE) & ~ends & (ahead != SPACE)
    out[last] = np.where(codes[last] == 32, S_BLANK, S_LAST)
    marks = np.flatnonzero((codes == 39) & ~ends)
    one = codes[marks + 1]
    out[marks[np.isin(one, [ord(c) for c in "stmd"])]] = S_SHORT
    room = (marks + 2 < n) & ~ends[np.minimum(marks + 1, n - 1)]
    marks, one = marks[room], one[room]
    two = codes[marks + 2]
    pairs = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]
    out[marks[np.any([(one == a) & (two == b) for a, b in pairs], 0)]] = S_LONG
    return np.where(firsts, out + FIRST, out)


def boundaries(codes, firsts, block=BLOCK):
    """Where slices begin, by composing the transition functions of blocks of code points."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    stream = symbols(codes, firsts)
    width = -(-n // block)
    size = min(block, n)
    grid = np.zeros(width * size, np.uint8)
    grid[:n] = stream
    steps = np.ascontiguousarray(grid.reshape(width, size).T).astype(np.intp) * STATES
    functions = np.tile(np.arange(STATES, dtype=np.intp), (width, 1))
    for i, symbol in enumerate(steps):
        functions = NEXT[symbol[:, None] + functions]
        # a few symbols on, nearly all functions are constant, and stay so: one state per block is then enough
        if functions.shape[1] > 1 and i % 16 == 15 and (functions == functions[:, :1]).all():
            functions = functions[:, :1]
    functions = np.array(np.broadcast_to(functions, (width, STATES)))
    # inclusive scan of the block functions by doubling: the composition is associative
    reach = 1
    while reach < width:
        functions[reach:] = np.take_along_axis(functions[reach:], functions[:-reach], 1)
        reach *= 2
    state = np.full(width, CUT, np.intp)
    state[1:] = functions[:-1, CUT]
    marks = np.empty((size, width), bool)
    for i, symbol in enumerate(steps):
        symbol = symbol + state
        marks[i], state = IS_BOUNDARY[symbol], NEXT[symbol]
    return np.flatnonzero(marks.T.ravel()[:n])


def merge(piece, ranks):
    """Token ids of one slice: the pair of lowest rank is joined, leftmost first, until none is left."""
    if piece in ranks:
        return [ranks[piece]]
    return merge_short(piece, ranks) if len(piece) <= SHORT else merge_long(piece, ranks)


def merge_short(piece, ranks):
    """By scanning the ranks of all pairs for each merge: fastest for the usual slices of a few bytes."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [ranks.get(a + b, NO_RANK) for a, b in zip(parts, parts[1:])]
    while pairs:
        least = min(pairs)
        if least == NO_RANK:
            break
        i = pairs.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], NO_RANK)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], NO_RANK)
    return [ranks[part] for part in parts]


def merge_long(piece, ranks):
    """With a heap of pairs: n log n for slices of any length."""
    n = len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    end = list(range(1, n + 1))
    heap = [(ranks[piece[i : i + 2]], i, i + 2) for i in range(n - 1) if piece[i : i + 2] in ranks]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or end[j] != stop:
            continue
        end[i], after[i], alive[j] = stop, after[j], False
        if after[i] < n:
            before[after[i]] = i
            pair = piece[i : end[after[i]]]
            if pair in ranks:
                heapq.heappush(heap, (ranks[pair], i, end[after[i]]))
        if before[i] >= 0:
            pair = piece[before[i] : stop]
            if pair in ranks:
                heapq.heappush(heap, (ranks[pair], before[i], stop))
    return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]


class Pieces(dict):
    """Cache from a slice to its ids as bytes of unsigned 32-bit integers; emptied when it is full. Slices of more than
    ``CACHED_BYTES`` are merged each time, so that the cache has a bound in bytes."""

    def __init__(self, ranks):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece):
        packed = np.array(merge(piece, self.ranks), "<u4").tobytes()
        if len(piece) <= CACHED_BYTES:
            if len(self) >= CACHE:
                self.clear()
            self[piece] = packed
        return packed


def load(path):
    """(ranks by bytes, bytes by id) of a tiktoken file."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return ranks, tokens


class Codec:
    """Encoder and decoder of one vocabulary inside a worker."""

    def __init__(self, path):
        ranks, tokens = load(path)
        self.pieces = Pieces(ranks)
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.places = np.concatenate([[0], np.cumsum(self.lengths)])
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)

    def encode(self, data, offsets):
        """(ids, byte offsets of the tokens, tokens per row) of a chunk."""
        codes, spots = buffers.codepoints(data, offsets)
        firsts = np.zeros(len(codes), bool)
        firsts[spots[:-1][np.diff(spots) > 0]] = True
        marks = boundaries(codes, firsts)
        width = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
        width[(codes >= 0xD800) & (codes < 0xE000)] = 1  # a byte that is not UTF-8
        at = np.concatenate([[0], np.cumsum(width)])
        cuts = np.append(at[marks], len(data))
        raw = data.tobytes()
        bounds = cuts.tolist()
        pieces = self.pieces
        packed = [pieces[raw[a:b]] for a, b in pairwise(bounds)]
        ids = np.frombuffer(b"".join(packed), "<u4")
        ends = np.cumsum(self.lengths[ids]) if len(ids) else np.zeros(0, np.int64)
        per_row = np.searchsorted(ends, offsets[1:], "right") - np.searchsorted(ends, offsets[:-1], "right")
        starts = ends - self.lengths[ids] - np.repeat(offsets[:-1], per_row)
        return ids, starts.astype("<u4"), per_row

    def decode(self, ids, starts, per_row):
        """(bytes, bytes per row): the bytes of every token at its offset in its row."""
        ids, starts = np.frombuffer(ids, "<u4"), np.frombuffer(starts, "<u4")
        size = self.lengths[ids]
        rows = np.repeat(np.arange(len(per_row)), per_row)
        ends = starts.astype(np.int64) + size
        n_bytes = np.zeros(len(per_row), np.int64)
        np.maximum.at(n_bytes, rows, ends)
        base = np.concatenate([[0], np.cumsum(n_bytes)])[:-1][rows] + starts
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        out = np.zeros(n_bytes.sum(), np.uint8)
        out[np.repeat(base, size) + step] = self.blob[np.repeat(self.places[ids], size) + step]
        return out, n_bytes


def codec(path):
    """The worker's codec of a vocabulary; read once in a worker."""
    if path not in _made:
        _made[path] = Codec(path)
    return _made[path]


def _binaries(values, per_row):
    """A binary column whose rows hold so many bytes of ``values`` each."""
    offsets = np.concatenate([[0], np.cumsum(per_row)]).astype(np.int64)
    buffer = pa.py_buffer(np.ascontiguousarray(values).tobytes())
    return pa.Array.from_buffers(pa.large_binary(), len(per_row), [None, pa.py_buffer(offsets), buffer]).cast(pa.binary())


def _encoding(path, raw):
    def run(batches):
        own = codec(path)
        for batch in batches:
            for low, high, data, offsets in buffers.parts(batch, raw, CHUNK):
                ids, starts, per_row = own.encode(data, offsets)
                values = {"ids": _binaries(ids, 4 * per_row), "starts": _binaries(starts, 4 * per_row)}
                yield buffers.with_columns(batch.slice(low, high - low).drop_columns([raw]), values)

    return run


def _decoding(path):
    def run(batches):
        own = codec(path)
        for batch in batches:
            for low, high, ids, offsets in buffers.parts(batch, "ids", CHUNK):
                starts, spots = buffers.column(batch.slice(low, high - low), "starts")
                starts = starts[spots[0] : spots[-1]]
                out, n_bytes = own.decode(ids.tobytes(), starts.tobytes(), np.diff(offsets) // 4)
                yield buffers.with_columns(batch.slice(low, high - low), {"decoded": _binaries(out, n_bytes)})

    return run


def encode(docs, path=None):
    """Add ids and starts to ``docs`` (column ``text``)."""
    path = path or public_tokenizers.path(VOCABULARY)
    (raw,) = fresh(docs, "raw")
    added = {"ids": "binary", "starts": "binary"}
    plain = docs.select([f"`{c}`" for c in docs.columns if c.lower() not in added])
    return mapped(plain.withColumn(raw, as_text(F.col("text"))), _encoding(path, raw), schema_with(plain, **added))


def decode(encoded, path=None):
    """Add decoded (bytes) to rows with ids and starts."""
    path = path or public_tokenizers.path(VOCABULARY)
    plain = encoded.select([f"`{c}`" for c in encoded.columns if c.lower() != "decoded"])
    return mapped(plain, _decoding(path), schema_with(plain, decoded="binary"))


def round_trip(docs, path=None):
    """``decode`` of ``encode`` in one pass: a task has one Python worker and one codec, where the two calls in a row have
    two of each, which stay on the executor for the steps after."""
    path = path or public_tokenizers.path(VOCABULARY)
    (raw,) = fresh(docs, "raw")
    added = {"ids": "binary", "starts": "binary", "decoded": "binary"}
    plain = docs.select([f"`{c}`" for c in docs.columns if c.lower() not in added])
    encoding, decoding = _encoding(path, raw), _decoding(path)
    whole = plain.withColumn(raw, as_text(F.col("text")))
    return mapped(whole, lambda batches: decoding(encoding(batches)), schema_with(plain, **added))


def digests(decoded):
    """n_tokens, ids_sha256 and decoded_sha256 in place of ids, starts and decoded."""
    n = (F.octet_length("ids") / 4).cast("long")
    hashes = {"n_tokens": n, "ids_sha256": F.sha2("ids", 256), "decoded_sha256": F.sha2("decoded", 256)}
    return decoded.withColumns(hashes).drop("ids", "starts", "decoded")
