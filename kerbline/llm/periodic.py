"""Runs of periodic words, found by block convolution.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), at least ``LEAST`` words and
``TIMES`` * q words long, that no neighbouring word extends with that period.

Scale B = 1, 2, 4, ... looks for periods from B up to 2B - 1. The words are cut into blocks of B. A run of four periods
holds a whole block in its first 2B - 1 words, and that block occurs again q words later, so it is enough to find for each
block the distances from B up to 2B - 1 at which it occurs without a mismatch. These are the zeros of the sum of squared
differences of word numbers between block and window, which an integer number-theoretic transform gives for all distances
at once, modulo a prime and without rounding. A sum that is zero only modulo the prime is told apart when its distance is
extended: stretches of words equal to the word d places on are runs of period d, if long enough.

Two exact tests keep blocks out of the transform. A block with a word that does not come again within 2B - 1 words has no
occurrence. A block whose window lies inside a run found at a smaller scale only repeats that run.

All texts of a chunk are one sequence in which no two texts share a number, so every step is a few array operations per
chunk. Work is row-local: no shuffle.

Edge cases: null, empty and blank texts have no words and no runs; texts of any length are read whole, blocks of over
``CAP`` words are searched by their first ``CAP``; a null doc_id hashes as empty text; repeated rows are separate texts;
empty tables give no rows; further columns may have any names.
"""

import hashlib
from collections import defaultdict
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kerbline.llm.buffers import parts
from kerbline.llm.frames import as_text, mapped

LEAST, TIMES = 6, 4
#: 119 * 2^23 + 1, which has roots of unity of every order up to 2^23; 3 generates its units.
PRIME, GENERATOR = 998_244_353, 3
CAP = 1 << 18
CELLS = 1 << 18
_MODULUS = np.uint64(PRIME)
_roots = {}


def roots(order, inverse=False):
    """The first half of the powers of a root of unity of this order."""
    if (order, inverse) not in _roots:
        root = pow(GENERATOR, (PRIME - 1) // order, PRIME)
        root = pow(root, -1, PRIME) if inverse else root
        powers, step = np.ones(max(order // 2, 1), np.uint64), 1
        while step < len(powers):
            powers[step : 2 * step] = powers[:step] * np.uint64(pow(root, step, PRIME)) % _MODULUS
            step *= 2
        _roots[order, inverse] = powers
    return _roots[order, inverse]


def _plus(x, y):
    total = x + y
    return np.minimum(total, total - _MODULUS)  # below the modulus the difference wraps round and is large


def _minus(x, y):
    total = x - y
    return np.minimum(total, total + _MODULUS)


def transform(rows):
    """Number-theoretic transform of every row, in bit-reversed order. Row length is a power of two."""
    rows, half = rows.copy(), rows.shape[1] // 2
    while half:
        pairs = rows.reshape(len(rows), -1, 2, half)
        low, high = pairs[:, :, 0].copy(), pairs[:, :, 1]
        difference = _minus(low, high) * roots(2 * half) % _MODULUS
        pairs[:, :, 0] = _plus(low, high)
        pairs[:, :, 1] = difference
        half //= 2
    return rows


def inverse_transform(rows):
    """The rows of which ``rows`` are the transforms."""
    rows, half, size = rows.copy(), 1, rows.shape[1]
    while half < size:
        pairs = rows.reshape(len(rows), -1, 2, half)
        low, high = pairs[:, :, 0].copy(), pairs[:, :, 1] * roots(2 * half, inverse=True) % _MODULUS
        pairs[:, :, 0] = _plus(low, high)
        pairs[:, :, 1] = _minus(low, high)
        half *= 2
    return rows * np.uint64(pow(size, -1, PRIME)) % _MODULUS


def squared_differences(blocks, windows):
    """Sum of squared differences, modulo the prime, of each block and every stretch of its length in its window.

    ``blocks`` is (n, B), ``windows`` (n, 2B - 1); the result is (n, B). The cyclic product has 2B places: the places
    asked for are those that no other wraps onto.
    """
    n, width = blocks.shape
    ahead = np.zeros((n, 2 * width), np.uint64)
    ahead[:, :width] = blocks[:, ::-1]
    behind = np.zeros((n, 2 * width), np.uint64)
    behind[:, : 2 * width - 1] = windows
    products = inverse_transform(transform(ahead) * transform(behind) % _MODULUS)[:, width - 1 : 2 * width - 1]
    squares = np.zeros((n, 2 * width), np.uint64)
    np.cumsum(windows * windows % _MODULUS, axis=1, out=squares[:, 1:])
    of_windows = (squares[:, width:] - squares[:, :width]) % _MODULUS
    of_blocks = (blocks * blocks % _MODULUS).sum(1, keepdims=True) % _MODULUS
    return _minus(_plus(of_blocks, of_windows), products * np.uint64(2) % _MODULUS)


def gaps(codes):
    """How many places on each number comes again; the length of the sequence where it does not."""
    order = np.argsort(codes, kind="stable")
    out = np.full(len(codes), len(codes), np.int64)
    same = codes[order[1:]] == codes[order[:-1]]
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def occurrences(codes, scale, starts, cap=CAP):
    """(block start, distance) of the occurrences, ``scale`` to 2 * ``scale`` - 1 places on, of the blocks at ``starts``."""
    width = min(scale, cap)
    padded = np.concatenate([codes, np.zeros(3 * scale, np.int64)]).astype(np.uint64)
    rows = max(1, CELLS // (2 * width))
    found_starts, found_distances = [], []
    for low in range(0, len(starts), rows):
        at = starts[low : low + rows]
        blocks = padded[at[:, None] + np.arange(width)]
        for shift in range(scale, 2 * scale, width):
            windows = padded[at[:, None] + shift + np.arange(2 * width - 1)]
            row, distance = np.nonzero(squared_differences(blocks, windows) == 0)
            found_starts.append(at[row])
            found_distances.append(distance + shift)
    return np.concatenate(found_starts), np.concatenate(found_distances)


def stretches(codes, low, high, distance):
    """(start, end) of the runs with this period among the places from ``low`` up to ``high``."""
    same = np.zeros(high - low - distance + 2, np.int8)
    same[1:-1] = codes[low : high - distance] == codes[low + distance : high]
    turns = np.flatnonzero(np.diff(same))
    starts, ends = turns[::2] + low, turns[1::2] + low + distance
    long = ends - starts >= max(LEAST, TIMES * distance)
    return zip(starts[long].tolist(), ends[long].tolist())


def find_runs(codes, offsets, cap=CAP):
    """{(start, end): period} of all runs; ``codes`` has numbers below the prime that no two texts share."""
    found = {}
    longest = int(np.diff(offsets).max(initial=0))
    again, scale = gaps(codes), 1
    widest = again
    while TIMES * scale <= longest:
        starts = np.flatnonzero(widest < 2 * scale) * scale
        starts = starts[starts + 2 * scale <= len(codes)]
        if len(starts):
            reach = np.zeros(len(codes) + 1, np.int64)
            for start, end in found:
                reach[start] = max(reach[start], end)
            reach = np.maximum.accumulate(reach)
            starts = starts[reach[starts] < np.minimum(starts + 3 * scale - 1, len(codes))]
        if len(starts):
            at, distance = occurrences(codes, scale, starts, cap)
            inside = at + distance + min(scale, cap) <= len(codes)
            at, distance = at[inside], distance[inside]
            text = np.searchsorted(offsets, at, "right") - 1
            new = (at + distance + scale <= offsets[text + 1]) & (reach[at] < at + distance + scale)
            for t, d in sorted(set(zip(text[new].tolist(), distance[new].tolist()))):
                for run in stretches(codes, int(offsets[t]), int(offsets[t + 1]), d):
                    found.setdefault(run, d)  # the same stretch has its smallest period from a smaller scale
        scale *= 2
        pairs = widest[: len(widest) // 2 * 2].reshape(-1, 2)
        widest = pairs.max(1)
    return found


def periodic_tail(words, crc):
    """The words as the query reads them: where the hash of the id ends in 0, repeated from some word on."""
    n, g = len(words), crc // 10
    if crc % 10 or not n:
        return words
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    return words[:start] + (words[start : start + period] * (-(-(n - start) // period)))[: n - start]


def _numbered(texts):
    """(numbers of all words, offsets of the texts); equal words of a text have equal numbers."""
    codes, offsets, base = [], [0], 1
    for words in texts:
        numbers = defaultdict(count(base).__next__)
        codes.extend(map(numbers.__getitem__, words))
        offsets.append(len(codes))
        base += len(numbers)
    return np.array(codes, np.int64), np.array(offsets, np.int64)


def runs_of(texts):
    """For each list of words, its runs as (start, length, period), by start, then period."""
    codes, offsets = _numbered(texts)
    out = [[] for _ in texts]
    for (start, end), period in find_runs(codes, offsets).items():
        text = int(np.searchsorted(offsets, start, "right")) - 1
        out[text].append((start - int(offsets[text]), end - start, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def kept_words(words, runs):
    """The words that no run contains after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return list(compress(words, np.cumsum(edge[:-1]) == 0))


def _searched(change):
    def run(batches):
        for batch in batches:
            crcs = batch.column("crc").to_pylist()
            found, kept = [], []
            for low, high, data, offsets in parts(batch, "text"):
                raw = data.tobytes()
                texts = [raw[a:b].split() for a, b in zip(offsets[:-1], offsets[1:])]
                if change:
                    texts = [periodic_tail(words, crc) for words, crc in zip(texts, crcs[low:high])]
                runs = runs_of(texts)
                found += [[dict(zip(("start", "length", "period"), r)) for r in each] for each in runs]
                kept += [b" ".join(kept_words(words, each)) for words, each in zip(texts, runs)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, _RUNS), pa.array(kept, pa.binary())], ["doc_id", "runs", "collapsed"]
            )

    return run


_RUNS = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))


def search(docs, change=False):
    """doc_id, runs (start, length, period; by start, then period) and collapsed (bytes) of every document.

    ``change`` first makes the texts of every tenth document, by the hash of its id, periodic from some word on.
    """
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    slim = docs.select("doc_id", crc.alias("crc"), as_text(F.col("text")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(
        slim,
        _searched(change),
        f"doc_id {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed binary",
    )


def _digests(batches):
    for batch in batches:
        found = batch.column("runs").to_pylist()
        best = [min(runs, key=lambda r: (-r["length"], r["start"], r["period"]), default=None) for runs in found]
        lines = ["".join(f"{r['start']},{r['length']},{r['period']}\n" for r in runs).encode() for runs in found]
        columns = {"n_runs": pa.array([len(runs) for runs in found], pa.int64())}
        for name in ("start", "length", "period"):
            columns[name] = pa.array([r and r[name] for r in best], pa.int64())
        columns["exponent_milli"] = pa.array([r and 1000 * r["length"] // r["period"] for r in best], pa.int64())
        columns["runs_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in lines])
        columns["collapsed_sha256"] = pa.array([hashlib.sha256(x.as_py()).hexdigest() for x in batch.column("collapsed")])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns.values()], ["doc_id", *columns])


def report(docs):
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string"
    return mapped(search(docs, change=True), _digests, f"{schema}, collapsed_sha256 string")
