"""Join of documents whose sets of word shingles are alike: rare-first prefix filtering, verified once per pair.

Two sets of sizes m <= n with at least ``PERCENT`` % Jaccard similarity share at least a = ceil(PERCENT (m + n) / (100 +
PERCENT)) shingles. Put every set into one order, rarest shingle first; then

* length: 100 m >= PERCENT n,
* prefix: each set of n has one of the shared shingles among its first n - ceil(PERCENT n / 100) + 1,
* position: if the first shared one is at places i and j, min(m - i, n - j) >= a,
* suffix: what follows it differs in at most m + n - 2a - i - j shingles; counts in ``CELLS`` cells of the suffixes give a
  lower bound of that.

Documents with the same set are one class, and a class is joined once. Only classes that can have a partner get that far:
a class with more than n - ceil(PERCENT n / 100) shingles that no other class has is out. For that, shingles whose hash
lies in the lowest ``SHARE`` are counted, which finds fewer such shingles but never too many.

Large groups of near copies would make all pairs of their members. So the links are found in rounds. In the first
``ROUNDS``, members that share a prefix shingle with more than ``SMALL`` holders are only compared with one hub of that
shingle, the member that has the fewest rarer shingles, and linked ones get the same label. The last round compares all
pairs that share a prefix shingle and have different labels: it gives the links that the hubs did not, and prefix shingles
whose holders have one label are done. Components are those of all links.

Edge cases: a text of fewer words than a shingle is one shingle, the whole sequence; null, empty and blank texts have the
empty set and are linked with nothing, not even each other; repeated rows are documents of one class; a null doc_id is never
a component's id unless all of its documents have none; empty tables give no rows; texts of any length are read whole;
further columns may have any names. Shingles are told apart by 64-bit hashes, sets by their sizes and 128 bits.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kerbline.llm import bloom
from kerbline.llm.buffers import LOWER, SYMBOL_CODES, Hasher, mix, parts, word_bounds
from kerbline.llm.components import components
from kerbline.llm.frames import as_text, located, mapped, written

SHINGLE, PERCENT = 3, 90
SHARE = 0.4
SMALL = 8
ROUNDS = 2
CELLS = 16
_FACTORS = mix(np.arange(101, 117, dtype=np.uint64)) | np.uint64(1)
_SALTS = mix(np.arange(201, 203, dtype=np.uint64))


def shingles(data, offsets, shingle=SHINGLE):
    """(hashes, row) of the distinct shingles of each row, by row, then hash."""
    data = LOWER[data]
    starts, ends, row = word_bounds(data, offsets)
    words = mix(Hasher(SYMBOL_CODES[data]).of(starts, ends))
    sizes = np.bincount(row, minlength=len(offsets) - 1)
    n = max(0, len(words) - shingle + 1)
    hashes, whole = np.zeros(n, np.uint64), row[:n] == row[shingle - 1 :][:n]
    for i in range(shingle):
        hashes += words[i : i + n] * _FACTORS[i]
    hashes, of_row = mix(hashes[whole]), row[:n][whole]
    few = np.flatnonzero((sizes > 0) & (sizes < shingle))
    first = np.concatenate([[0], np.cumsum(sizes)])
    short = np.zeros(len(few), np.uint64)
    for i in range(shingle - 1):
        has = sizes[few] > i
        short[has] += words[first[few[has]] + i] * _FACTORS[shingle + i]
    hashes, of_row = np.concatenate([hashes, mix(short + np.uint64(1))]), np.concatenate([of_row, few])
    order = np.lexsort((hashes, of_row))
    hashes, of_row = hashes[order], of_row[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of_row[1:] != of_row[:-1])
    return hashes[new], of_row[new]


def _set_digests(hashes, row, n_rows):
    """(size, digest, digest) of each row's set."""
    borders = np.searchsorted(row, np.arange(n_rows + 1))
    out = [np.diff(borders)]
    for salt in _SALTS:
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(mix(hashes ^ salt), out=sums[1:])
        out.append((sums[borders[1:]] - sums[borders[:-1]]).view(np.int64))
    return out


def _class_key(size, one, two):
    """The set in 64 bits, for the test of lonely shingles."""
    return mix(one.view(np.uint64) + mix(two.view(np.uint64)) + size.astype(np.uint64)).view(np.int64)


def _sets(shingle):
    def run(batches):
        for batch in batches:
            for low, high, data, offsets in parts(batch, "text"):
                size, one, two = _set_digests(*shingles(data, offsets, shingle), high - low)
                own = [batch.column(c).slice(low, high - low) for c in ("doc_id", "file_id", "row")]
                arrays = [*own, pa.array(size), pa.array(one), pa.array(two), pa.array(_class_key(size, one, two))]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "file_id", "row", "n", "one", "two", "key"])

    return run


def _sampled(shingle, least, share):
    limit = np.uint64(min(int(share * 2.0**64), 2**64 - 1))

    def run(batches):
        for batch in batches:
            for low, high, data, offsets in parts(batch, "text"):
                hashes, row = shingles(data, offsets, shingle)
                size, one, two = _set_digests(hashes, row, high - low)
                chosen = (hashes <= limit) & (size[row] >= least)
                keys = _class_key(size, one, two)[row[chosen]]
                yield pa.RecordBatch.from_arrays([pa.array(hashes[chosen].view(np.int64)), pa.array(keys)], ["token", "key"])

    return run


def _tokens(shingle):
    def run(batches):
        for batch in batches:
            for low, high, data, offsets in parts(batch, "text"):
                hashes, row = shingles(data, offsets, shingle)
                borders = np.searchsorted(row, np.arange(high - low + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(borders), pa.array(hashes.view(np.int64)))
                own = [batch.column(c).slice(low, high - low) for c in ("node", "n")]
                yield pa.RecordBatch.from_arrays([*own, lists], ["node", "n", "tokens"])

    return run


def spare(n, percent=PERCENT):
    """How many shingles of a set of n its partners may lack: n - ceil(percent * n / 100)."""
    return n * (100 - percent) // 100


def least_size(percent=PERCENT):
    """The smallest set that can be linked with a different one, of one shingle more."""
    return -(-percent // (100 - percent))


def _prefix(percent):
    """Rows of the prefix shingles that more than one set has, with counts of the cells of what follows each."""

    def run(batches):
        for batch in batches:
            out = [[] for _ in range(5)]
            for node, n, alone, tokens in zip(*(batch.column(c) for c in ("node", "n", "alone", "tokens"))):
                node, n, alone, tokens = node.as_py(), n.as_py(), alone.as_py(), tokens.values.to_numpy()
                length = spare(n, percent) + 1
                if alone >= length:
                    continue
                cells = (tokens.view(np.uint64) & np.uint64(CELLS - 1)).astype(np.int64)
                passed = np.cumsum(cells[:length, None] == np.arange(CELLS), axis=0, dtype=np.int32)
                after = np.bincount(cells, minlength=CELLS).astype(np.int32) - passed
                places = np.arange(alone, length, dtype=np.int32)
                for values, more in zip(out, (tokens[places], places, after[places])):
                    values.append(more)
                out[3].append(np.full(len(places), node))
                out[4].append(np.full(len(places), n))
            token, place, after, node, n = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in out)
            borders = pa.array(np.arange(len(token) + 1, dtype=np.int32) * CELLS)
            cells = pa.ListArray.from_arrays(borders, pa.array(after.ravel().astype(np.int32)))
            arrays = [pa.array(token), pa.array(place.astype(np.int32)), pa.array(node), pa.array(n), cells]
            yield pa.RecordBatch.from_arrays(arrays, ["token", "place", "node", "n", "cells"])

    return run


def _may_link(a, b, percent):
    """Length, position and suffix filter of two prefix rows of the same shingle."""
    need = f"(({percent} * ({a}.n + {b}.n) + {100 + percent - 1}) DIV {100 + percent})"
    apart = f"aggregate(zip_with({a}.cells, {b}.cells, (x, y) -> abs(x - y)), 0, (s, x) -> s + x)"
    return (
        f"100 * least({a}.n, {b}.n) >= {percent} * greatest({a}.n, {b}.n)"
        f" AND least({a}.n - {a}.place, {b}.n - {b}.place) >= {need}"
        f" AND {apart} <= {a}.n + {b}.n - 2 * {need} - {a}.place - {b}.place"
    )


def verified(pairs, sets, percent=PERCENT):
    """The pairs (u, v) whose sets are alike, each checked once."""
    left, right = (sets.select(F.col("node").alias(k), F.col("tokens").alias(f"tokens_{k}")) for k in "uv")
    both = pairs.distinct().join(left, "u").join(right, "v")
    shared = F.size(F.array_intersect("tokens_u", "tokens_v"))
    union = F.size("tokens_u") + F.size("tokens_v") - shared
    return written(both.where(100 * shared >= percent * union).select("u", "v"), "verified")


def class_table(docs):
    """node, n, key, doc_id (smallest), file_id, row (of one document) and one, two of each set that is not empty."""
    classes = docs.where("n > 0").groupBy("n", "one", "two", "key")
    classes = classes.agg(F.min("doc_id").alias("doc_id"), F.min(F.struct("file_id", "row")).alias("place"))
    named = classes.select(
        F.monotonically_increasing_id().alias("node"), "n", "one", "two", "key", "doc_id", "place.file_id", "place.row"
    )
    return written(named, "classes")


def possible(texts, classes, shingle=SHINGLE, percent=PERCENT, share=SHARE):
    """The classes that can have a partner: few enough of their shingles are theirs alone."""
    least = least_size(percent)
    tokens = mapped(texts.select("text"), _sampled(shingle, least, share), "token long, key long")
    holders = tokens.groupBy("token").agg(F.min("key").alias("key"), F.max("key").alias("other"))
    lonely = holders.where("key = other").groupBy("key").agg(F.count("*").alias("lonely"))
    large = classes.where(F.col("n") >= least)
    kept = large.join(lonely, "key", "left").where(f"coalesce(lonely, 0) <= n * {100 - percent} DIV 100")
    return written(kept.select("node", "n", "file_id", "row"), "possible")


def rare_first(texts, chosen, shingle=SHINGLE):
    """node, n, tokens in the common order and alone, the number of them that no other chosen set has."""
    place = F.struct("file_id", "row")
    _, maybe = bloom.split(texts.select("file_id", "row", "text"), place, chosen, place)
    found = maybe.join(chosen, ["file_id", "row"]).select("node", "n", "text")
    sets = written(mapped(found, _tokens(shingle), "node long, n long, tokens array<long>"), "sets")
    grams = sets.select("node", "n", F.explode("tokens").alias("token"))
    common = written(grams.groupBy("token").agg(F.count("*").alias("sets")).where("sets > 1"), "common")
    ranked = grams.join(common, "token", "left").groupBy("node", "n")
    ranked = ranked.agg(F.sort_array(F.collect_list(F.struct(F.coalesce("sets", F.lit(1)).alias("sets"), "token"))).alias("t"))
    alone = F.size(F.filter("t.sets", lambda s: s == 1))
    return written(ranked.select("node", "n", F.col("t.token").alias("tokens"), alone.alias("alone")), "ranked")


def _labelled(prefix, labels):
    joined = prefix.join(labels.select("node", F.col("root").alias("label")), "node", "left")
    return joined.withColumn("label", F.coalesce("label", "node"))


_ROW = ("place", "node", "n", "cells", "label")


def _pairs(left, right, percent, once="true"):
    """(u, v) of rows a and b of the same shingle with different labels that pass the filters."""
    both = left.join(right, "token").where(f"a.label <> b.label AND ({once})").where(_may_link("a", "b", percent))
    return both.select(F.least("a.node", "b.node").alias("u"), F.greatest("a.node", "b.node").alias("v"))


def hub_pairs(prefix, percent=PERCENT, first=True):
    """(u, v): the holders of a prefix shingle and its hub; after the first round the hub is among those that do not have
    the label of the first hub."""
    rank = F.struct("place", "node", "label")
    per = prefix.groupBy("token").agg(
        F.count("*").alias("holders"), F.min("label").alias("low"), F.max("label").alias("high"), F.min(rank).alias("first")
    )
    per = per.where((F.col("holders") > SMALL) & (F.col("low") < F.col("high"))).select("token", "first")
    rows = prefix.join(written(per, "groups"), "token")
    eligible = rows.where("node = first.node" if first else "label <> first.label")
    hubs = eligible.groupBy("token").agg(F.min(F.struct(*_ROW)).alias("b"))  # by place, then node
    return _pairs(rows.select("token", F.struct(*_ROW).alias("a")), written(hubs, "hubs"), percent)


def remaining_pairs(prefix, percent=PERCENT):
    """(u, v): all pairs that share a prefix shingle and have different labels. Those with the shingle's commonest label are
    only paired with the others."""
    per = prefix.groupBy("token", "label").agg(F.count("*").alias("holders"))
    per = per.groupBy("token").agg(F.count("*").alias("labels"), F.max(F.struct("holders", "label")).alias("most"))
    per = per.where("labels > 1").select("token", F.col("most.label").alias("main"))
    rows = written(prefix.join(written(per, "open"), "token"), "open-rows")
    all_, row = rows.select("token", F.struct(*_ROW).alias("a")), F.struct(*_ROW, "main").alias("b")
    others = rows.where("label <> main").select("token", row)
    return _pairs(all_, others, percent, "a.label = b.main OR a.node < b.node")


def link_classes(sets, percent=PERCENT, rounds=ROUNDS):
    """(node, root) of every class that is linked with a smaller one."""
    prefix = written(
        mapped(
            sets.where(f"alone <= n * {100 - percent} DIV 100"),
            _prefix(percent),
            "token long, place int, node long, n long, cells array<int>",
        ),
        "prefix",
    )
    labels = prefix.sparkSession.createDataFrame([], "node long, root long")
    links = None
    for round_ in range(rounds + 1):
        rows = _labelled(prefix, labels)
        pairs = hub_pairs(rows, percent, round_ == 0) if round_ < rounds else remaining_pairs(rows, percent)
        found = verified(pairs, sets, percent)
        links = found if links is None else links.unionByName(found)
        labels = components(links)
    return labels


def join(docs, shingle=SHINGLE, percent=PERCENT, rounds=ROUNDS, share=SHARE):
    """doc_id, n_shingles and component_id of every document."""
    texts = located(docs.select("doc_id", "text")).select(
        F.col("doc.doc_id").cast("long").alias("doc_id"),
        F.xxhash64("file").alias("file_id"),
        "row",
        as_text(F.col("doc.text")).alias("text"),
    )
    schema = "doc_id long, file_id long, row long, n long, one long, two long, key long"
    sets = written(mapped(texts, _sets(shingle), schema), "documents")
    classes = class_table(sets)
    chosen = possible(texts, classes, shingle, percent, share)
    labels = link_classes(rare_first(texts, chosen, shingle), percent, rounds)
    rooted = classes.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_class = written(rooted.join(least, "root").select("n", "one", "two", "component_id"), "components")
    some = sets.where("n > 0").join(of_class, ["n", "one", "two"])
    none = sets.where("n = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    return some.select(*columns).unionByName(none.select(*columns))
