"""Removal of repeated windows by a depth-limited radix sort of suffixes.

The suffixes that matter start a window of ``WINDOW`` bytes. They are ordered by most-significant-digit passes, and only
as deep as the window, so groups that are equal after the last pass are exactly the repeated windows. Neighbouring
suffixes travel together as one unit as long as they share their digits:

* first digit: the rarest-hash ``GRAM`` bytes inside the window and their offset. All adjacent windows with the same one
  form a run. A run whose gram occurs nowhere else is done: its windows occur once.
* second digit: the bytes common to 16 adjacent windows of a run (385 of 400), for the runs still alive.
* third digit: the whole window.

In each pass a group of equal digits (``core``) is looked at by its full bytes (``span``). Units with equal spans are
repeated as a whole. If a group has several spans, one unit of each goes on to the next pass, cut finer. Passes are
aggregations and joins on 64-bit hashes of the digits; two windows count as equal if the hashes of both agree, at least
128 bits in all. A passage in a third of all documents is one span in most units, which the aggregation combines before
the shuffle; joins on it are split by adaptive execution. The text itself is read once for the first pass; later passes
only move the texts that have units alive, found through a blocked Bloom filter.

Edge cases: null text counts as empty; texts shorter than the window lose nothing; matches never cross rows; repeated
rows are repeated windows; empty tables give no rows; texts of any length are read in overlapping segments; further
columns may have any names.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kerbline.llm import bloom
from kerbline.llm.buffers import SYMBOL_CODES, Hasher, column, mix, with_columns
from kerbline.llm.frames import as_text, held, located, mapped, written

WINDOW = 400
GRAM = 64
BLOCK = 16
SEGMENT = 1 << 20
UNIT = "file_id long, row long, s long, e long, p long, core long, span long"
_NAMES = ("file_id", "row", "s", "e", "p", "core", "span")


def sliding_min(values, width):
    """Minimum of every ``width`` adjacent values, from running minima in blocks of that width."""
    n = len(values) - width + 1
    room = -(-len(values) // width) * width
    grid = np.full(room, np.iinfo(np.uint64).max, np.uint64)
    grid[: len(values)] = values
    grid = grid.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, 1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def runs(data, window=WINDOW, gram=GRAM):
    """(s, e, p, core, span) of the runs of one text: windows starting at s..e have their least gram at p."""
    hasher = Hasher(SYMBOL_CODES[data])
    spots = np.arange(len(data) - gram + 1)
    hashes = mix(hasher.of(spots, spots + gram))
    # the gram with the least hash, the first of equals: place below the upper 40 bits of the hash
    packed = (hashes & np.uint64(0xFFFFFFFFFF000000)) | spots.astype(np.uint64)
    least = (sliding_min(packed, window - gram + 1) & np.uint64(0xFFFFFF)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(least)) + 1
    s = np.concatenate([[0], cuts])
    e = np.concatenate([cuts - 1, [len(least) - 1]])
    p = least[s]
    span = mix(hasher.of(s, e + window) ^ mix(((p - s) << 20 | (e - s)).astype(np.uint64)))
    return s, e, p, hashes[p], span


def _segments(n, window):
    """Overlapping segments, so that every window lies in exactly one; they bound memory for very long texts."""
    for low in range(0, max(0, n - window + 1), SEGMENT):
        yield low, min(n, low + SEGMENT + window - 1)


def _units(columns):
    arrays = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)) for a in arrays], list(_NAMES))


def _first_pass(window, gram):
    def run(batches):
        for batch in batches:
            data, offsets = column(batch, "text")
            files, rows = (batch.column(c).to_numpy() for c in ("file_id", "row"))
            out, size = [[] for _ in _NAMES], 0
            for i in np.flatnonzero(np.diff(offsets) >= window):
                text = data[offsets[i] : offsets[i + 1]]
                for low, high in _segments(len(text), window):
                    s, e, p, core, span = runs(text[low:high], window, gram)
                    n = len(s)
                    found = (np.full(n, files[i]), np.full(n, rows[i]), s + low, e + low, p + low, core, span)
                    for values, more in zip(out, found):
                        values.append(more)
                    size += n
                if size > 200_000:
                    yield _units(out)
                    out, size = [[] for _ in _NAMES], 0
            yield _units(out)

    return run


def blocks(hasher, s, e, p, window=WINDOW, size=BLOCK):
    """(s, e, p, core, span) of the blocks of a run: starts with the same (p - start) // size."""
    number = np.arange((p - e) // size, (p - s) // size + 1)
    last = p - number * size
    first = last - size + 1
    low, high = np.maximum(first, s), np.minimum(last, e)
    core = mix(hasher.of(last, first + window) ^ mix(number.astype(np.uint64)))
    span = mix(hasher.of(low, high + window) ^ mix(((low - first) << 20 | (high - first)).astype(np.uint64)))
    return low, high, np.full(len(number), p), core, span


def windows(hasher, s, e, p, core, window=WINDOW):
    """(s, e, p, core, span) of the single windows of a block."""
    starts = np.arange(s, e + 1)
    core = mix(np.full(len(starts), core, np.int64).view(np.uint64) + (p - starts).astype(np.uint64))
    return starts, starts, np.full(len(starts), p), core, hasher.of(starts, starts + window)


def _finer_pass(cut, window):
    """Cut the units of each text: from runs to blocks, or from blocks to windows."""

    def run(batches):
        for batch in batches:
            data, offsets = column(batch, "text")
            files, rows = (batch.column(c).to_numpy() for c in ("file_id", "row"))
            for i, units in enumerate(batch.column("units")):
                text = data[offsets[i] : offsets[i + 1]]
                out, size, base, hasher = [[] for _ in _NAMES], 0, None, None
                for unit in sorted(units.as_py(), key=lambda u: u["s"]):
                    if base is None or unit["e"] + window > base + hasher.n:
                        base = unit["s"]  # a unit is shorter than a segment, so one that starts here fits in
                        hasher = Hasher(SYMBOL_CODES[text[base : base + SEGMENT + 4 * window]])
                    s, e, p = (unit[k] - base for k in "sep")
                    more = cut(hasher, s, e, p, unit["core"])
                    n = len(more[0])
                    found = (np.full(n, files[i]), np.full(n, rows[i]), *(x + base for x in more[:3]), *more[3:])
                    for values, x in zip(out, found):
                        values.append(x)
                    size += n
                    if size > 200_000:
                        yield _units(out)
                        out, size = [[] for _ in _NAMES], 0
                yield _units(out)

    return run


def narrow(units):
    """(repeated, alive): units repeated as a whole, and one unit of each span in groups that have several."""
    units = held(units)
    cores = units.groupBy("core").agg(F.count("*").alias("n"), F.min("span").alias("low"), F.max("span").alias("high"))
    # written, so that both sides of the join are plain exchanges, of which adaptive execution splits the large ones
    cores = written(cores.where("n > 1").select("core", (F.col("low") != F.col("high")).alias("several")), "cores")
    shared = written(units.join(cores, "core"), "shared")
    units.unpersist()
    spans = shared.groupBy("core", "span", "several").agg(
        F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("file_id", "row", "s", "e", "p")]
    )
    spans = written(spans, "spans")
    repeated = shared.join(spans.where("n > 1").select("core", "span"), ["core", "span"])
    return repeated.select("file_id", "row", "s", "e"), spans.where("several").select(*_NAMES[:-1])


def _with_text(texts, units):
    """The texts that have units, each with the array of its units."""
    place = ["file_id", "row"]
    lists = units.groupBy(*place).agg(F.collect_list(F.struct(*[c for c in units.columns if c not in place])).alias("units"))
    lists = written(lists, "units")
    _, maybe = bloom.split(texts, F.struct(*place), lists, F.struct(*place))
    return maybe.join(lists, place)


def repeated_units(texts, window=WINDOW, gram=GRAM):
    """(file_id, row, s, e): windows starting at s..e occur more than once; together, all such windows."""
    units = mapped(texts.select("file_id", "row", "text"), _first_pass(window, gram), UNIT)
    found, alive = narrow(units)
    cuts = (
        lambda hasher, s, e, p, core: blocks(hasher, s, e, p, window),
        lambda hasher, s, e, p, core: windows(hasher, s, e, p, core, window),
    )
    for cut in cuts:
        finer = mapped(_with_text(texts.select("file_id", "row", "text"), alive), _finer_pass(cut, window), UNIT)
        repeated, alive = narrow(finer)
        found = found.unionByName(repeated)
    return found


def _removed(n, units, window):
    """Flags of the bytes that repeated windows cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, [u["s"] for u in units], 1)
    np.add.at(edge, [u["e"] + window for u in units], -1)
    return np.cumsum(edge[:n]) > 0


def _cut_out(window):
    def run(batches):
        for batch in batches:
            data, offsets = column(batch, "text")
            kept, removed, spans = [], [], []
            for i, units in enumerate(batch.column("units")):
                text = data[offsets[i] : offsets[i + 1]]
                gone = _removed(len(text), units.as_py() or [], window)
                kept.append(text[~gone].tobytes())
                removed.append(int(gone.sum()))
                spans.append(int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum()))
            values = {"kept": pa.array(kept, pa.binary()), "n_removed": pa.array(removed, pa.int64())}
            values["n_spans"] = pa.array(spans, pa.int64())
            yield with_columns(batch.select(["doc_id", "n_bytes"]), values)

    return run


def remove_repeats(docs, window=WINDOW, gram=GRAM):
    """doc_id, n_bytes, kept (bytes), n_removed and n_spans of every document."""
    texts = located(docs).select(
        "doc.doc_id", F.xxhash64("file").alias("file_id"), "row", as_text(F.col("doc.text")).alias("text")
    )
    found = repeated_units(texts, window, gram)
    place = ["file_id", "row"]
    lists = written(found.groupBy(*place).agg(F.collect_list(F.struct("s", "e")).alias("units")), "repeats")
    sure, maybe = bloom.split(texts, F.struct(*place), lists, F.struct(*place))
    size = F.octet_length("text").cast("long").alias("n_bytes")
    none = F.lit(0).cast("long")
    sure = sure.select("doc_id", size, F.col("text").alias("kept"), none.alias("n_removed"), none.alias("n_spans"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, kept binary, n_removed long, n_spans long"
    cut = mapped(maybe.join(lists, place, "left").select("doc_id", size, "text", "units"), _cut_out(window), schema)
    return sure.unionByName(cut)


def report(docs, window=WINDOW, gram=GRAM):
    """Counts, digest and ``text``: the remaining bytes as text, where a cut inside a code point leaves U+FFFD."""
    out = remove_repeats(docs, window, gram)
    text = F.make_valid_utf8(F.col("kept").cast("string")).alias("text")
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), text)
