"""Arrow columns as numpy buffers, and hashes of substrings, for code that runs inside tasks."""

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers = {}


def column(batch, name):
    """(bytes, offsets) of a binary column, each as one numpy array; null counts as empty."""
    values = batch.column(name).cast(pa.large_binary())
    if values.null_count:
        values = values.fill_null(b"")
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    return np.frombuffer(data if data is not None else b"", np.uint8), offsets


def chunks(offsets, limit=CHUNK_BYTES):
    """Ranges of whole rows with at most ``limit`` bytes each; a longer row gets a range of its own."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, high
        low = high


def parts(batch, name, limit=CHUNK_BYTES):
    """(first row, last row + 1, bytes, offsets from 0) for each chunk of a binary column."""
    data, offsets = column(batch, name)
    for low, high in chunks(offsets, limit):
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]


def powers(n, base=BASE):
    """base^i and base^-i modulo 2^64 for i < n."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        inverse = pow(base, -1, 1 << 64)
        size = 1 << (n - 1).bit_length()
        up, down = np.full(size, base, np.uint64), np.full(size, inverse, np.uint64)
        up[0] = down[0] = 1
        have = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size <= 4 * CHUNK_BYTES:
            _powers[base] = have
    return have[0][:n], have[1][:n]


def mix(x):
    """Scatter the bits of 64-bit integers (finaliser of splitmix64)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


SYMBOL_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Hasher:
    """Hashes of any substrings of one buffer, from prefix sums of code[i] * base^i modulo 2^64."""

    def __init__(self, codes, base=BASE):
        self.n = len(codes)
        up, self.down = powers(self.n + 1, base)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(codes * up[: self.n], out=self.sums[1:])

    def of(self, starts, ends):
        return (self.sums[ends] - self.sums[starts]) * self.down[starts]


def sums_by_row(flags, offsets):
    """How many flags are set in each row."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def word_bounds(data, offsets):
    """(starts, ends, row) of every run of bytes that are not ASCII white space; runs stop at row ends."""
    inside = ~SPACES[data]
    first = np.zeros(len(data), bool)
    if len(data):
        first[1:] = ~inside[:-1]
        edges = offsets[:-1]
        first[edges[edges < len(data)]] = True
    starts = np.flatnonzero(inside & first)
    last = np.ones(len(data), bool)
    if len(data):
        last[:-1] = ~inside[1:]
        edges = offsets[1:] - 1
        last[edges[edges >= 0]] = True
    ends = np.flatnonzero(inside & last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def with_columns(batch, added):
    """The batch with further columns behind its own."""
    arrays, names = list(batch.columns), list(batch.schema.names)
    for name, values in added.items():
        arrays.append(values)
        names.append(name)
    return pa.RecordBatch.from_arrays(arrays, names)


def codepoints(data, offsets):
    """(code points, offsets counted in code points) of UTF-8 rows; a byte that is not UTF-8 becomes one surrogate."""
    raw = data.tobytes()
    texts = [raw[a:b].decode("utf-8", "surrogateescape") for a, b in zip(offsets[:-1], offsets[1:])]
    spots = np.zeros(len(offsets), np.int64)
    np.cumsum([len(t) for t in texts], out=spots[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), spots
