"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint has a bit for each bit of the shingles' 64-bit hashes, set if it is set in over half of them. To find all
pairs within ``distance`` bits, the 64 bits are put into m groups. If group i has a threshold t_i, and the thresholds sum
to distance - m + 1, then any two fingerprints within the distance differ in at most t_i bits in at least one group i.

* Bits that are correlated over all fingerprints go into the same group, so that the groups are nearly independent.
* Each fingerprint gets thresholds of its own, by dynamic programming on the estimated number of candidates: exact counts
  of the commonest values of each group (a bounded table), the mean of the rest otherwise. A threshold of -1 leaves a
  group out, so a fingerprint with a common value in one group is probed through others.
* Every fingerprint is indexed under its value in every group, and probed under all values within its threshold; probes
  and index meet in a join that checks the full distance before a row leaves it.
* The number of groups is the one with the least expected work for the number of distinct fingerprints; any is exact.

Equal fingerprints are one node. Components are found over the links between different fingerprints.

Edge cases: null and empty texts have no words and fingerprint 0, which links like any other; a text with fewer words
than a shingle is one shingle; a null doc_id never is a component's id unless all are null; repeated rows are linked;
empty tables give no rows; long texts are hashed whole in slices of bounded size; further columns may have any names.
"""

import re
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from kerbline.llm import bloom
from kerbline.llm.buffers import column
from kerbline.llm.components import components
from kerbline.llm.frames import as_text, located, mapped, written

BITS = 64
SHINGLE, DISTANCE, SEED = 3, 3, 42
#: A probe or index row costs as much as checking so many candidates.
ROW_COST = 30
COMMON_VALUES = 4096
SLICE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_slices(text, size=SLICE):
    """The words of a text, in lists from slices of about ``size`` bytes."""
    start = 0
    while start < len(text):
        gap = _SPACE.search(text, start + size)
        end = gap.start() if gap else len(text)
        yield text[start:end].split()
        start = end


def fingerprint(text, shingle=SHINGLE):
    """Signed 64-bit fingerprint of a text given as bytes."""
    counts, n, tail = np.zeros(BITS, np.int64), 0, []
    for words in word_slices(text.lower()):
        words = tail + words
        tail = words[max(0, len(words) - shingle + 1) :]
        if len(words) >= shingle:
            shingles = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
            raw = b"".join([xxhash.xxh64_digest(s, SEED) for s in shingles])
            n += len(raw) // 8
            counts += np.unpackbits(np.frombuffer(raw, np.uint8)).reshape(-1, BITS).sum(0, dtype=np.int64)
    if not n:
        if not tail:
            return 0
        raw, n = xxhash.xxh64_digest(b" ".join(tail), SEED), 1
        counts = np.unpackbits(np.frombuffer(raw, np.uint8)).astype(np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big", signed=True)


def fingerprints(rows, shingle=SHINGLE):
    """doc_id, file, row and fp of every document of ``rows`` (see ``located``)."""

    def run(batches):
        for batch in batches:
            data, offsets = column(batch, "text")
            view = memoryview(data)
            found = [fingerprint(bytes(view[a:b]), shingle) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("file"), batch.column("row"), pa.array(found, pa.int64())],
                ["doc_id", "file", "row", "fp"],
            )

    slim = rows.select(F.col("doc.doc_id").cast("long").alias("doc_id"), "file", "row", as_text(F.col("doc.text")).alias("text"))
    return mapped(slim, run, "doc_id long, file string, row long, fp long")


def _bits_of(values):
    """(n, 64) array of bits, lowest first."""
    raw = np.ascontiguousarray(values, "<i8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1, bitorder="little")


def _together(batches):
    """(i, j, n): how often bits i and j are both set; under i = j, how often a bit is set; under -1 the rows."""
    total, rows = np.zeros((BITS, BITS)), 0
    for batch in batches:
        bits = _bits_of(batch.column("fp").to_numpy(zero_copy_only=False)).astype(np.float32)
        for low in range(0, len(bits), 1 << 16):
            part = bits[low : low + (1 << 16)]
            total += part.T @ part
        rows += len(bits)
    i, j = np.triu_indices(BITS)
    n = np.append(total[i, j].astype(np.int64), rows)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(i, -1), pa.int32()), pa.array(np.append(j, -1), pa.int32()), pa.array(n)], ["i", "j", "n"]
    )


def correlations(fps):
    """Absolute correlation of each pair of bits over all fingerprints, and the number of fingerprints."""
    sums = mapped(fps.select("fp"), _together, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))
    both, rows = np.zeros((BITS, BITS)), 0
    for r in sums.collect():  # 2,081 rows
        if r["i"] < 0:
            rows = r["n"]
        else:
            both[r["i"], r["j"]] = both[r["j"], r["i"]] = r["n"]
    share = np.diag(both) / max(rows, 1)
    spread = np.sqrt(np.outer(share * (1 - share), share * (1 - share)))
    covariance = both / max(rows, 1) - np.outer(share, share)
    return np.abs(np.divide(covariance, spread, out=np.zeros_like(both), where=spread > 0)), rows


def group_count(rows, distance=DISTANCE):
    """The number of groups with the least expected work for one fingerprint."""

    def work(m):
        width, spare = BITS // m, distance - m + 1
        radius = [spare // m + (i < spare % m) for i in range(m)]
        probes = sum(sum(comb(width, r) for r in range(t + 1)) for t in radius)
        return (m + probes) * ROW_COST + probes * rows / 2.0**width

    return min(range(min(2, distance + 1), distance + 2), key=work)


def bit_groups(correlation, m):
    """m groups of nearly equal size: each starts with the strongest free pair and takes the closest free bit."""
    free, groups = set(range(BITS)), []
    for i in range(m):
        size = (BITS - sum(map(len, groups))) // (m - i)
        order = sorted(free)
        own = list(max(combinations(order, 2), key=lambda p: correlation[p])) if size > 1 and i < m - 1 else order[:1]
        while len(own) < size:
            own.append(max(sorted(free - set(own)), key=lambda b: correlation[b, own].mean()))
        groups.append(sorted(own))
        free -= set(own)
    return groups


def values_in(fps, group):
    """The value of each fingerprint in a group of bits."""
    bits = _bits_of(fps)[:, group].astype(np.int64)
    return bits @ (np.int64(1) << np.arange(len(group), dtype=np.int64))


def _flips(width, radius):
    """Masks of all changes of at most ``radius`` bits, by number of bits."""
    masks = [np.zeros(1, np.int64)]
    for r in range(1, radius + 1):
        masks.append(np.array([sum(1 << b for b in bits) for bits in combinations(range(width), r)], np.uint64).view(np.int64))
    return masks


class Plan:
    """Groups of bits and candidate statistics; shipped to the tasks."""

    def __init__(self, groups, common, rows, distance=DISTANCE):
        m = len(groups)
        self.groups, self.spare = groups, distance - m + 1
        self.radius = max(0, -(-self.spare // m)) + (m > 1)
        self.masks = [_flips(len(g), self.radius) for g in groups]
        self.common = [(np.array(sorted(c), np.int64), np.array([c[v] for v in sorted(c)], np.int64)) for c in common]
        self.rest = [max(0, rows - sum(c.values())) / 2.0 ** len(g) for g, c in zip(groups, common)]

    def keys(self, fps):
        """Index key of each fingerprint in each group."""
        return [values_in(fps, g) ^ self._place(i) for i, g in enumerate(self.groups)]

    @staticmethod
    def _place(i):
        return np.int64(i) << np.int64(58)

    def costs(self, fps):
        """(n, thresholds from -1) of each group: row costs plus estimated candidates."""
        out = []
        for i, group in enumerate(self.groups):
            values, (names, counts) = values_in(fps, group), self.common[i]
            cost = np.zeros((len(fps), self.radius + 2))
            for r, masks in enumerate(self.masks[i]):
                found = np.full(len(fps), len(masks) * self.rest[i])
                if len(names) and r < 2:
                    for mask in masks:
                        near = values ^ mask
                        spot = np.minimum(np.searchsorted(names, near), len(names) - 1)
                        found += np.where(names[spot] == near, counts[spot], 0)
                cost[:, r + 1] = cost[:, r] + found + len(masks) * ROW_COST
            out.append(cost)
        return out

    def thresholds(self, fps):
        """(n, m) thresholds with the least cost that sum to distance - m + 1, by dynamic programming over the groups."""
        costs, n = self.costs(fps), len(fps)
        m, steps = len(costs), self.radius + 2
        goal = self.spare + m  # thresholds counted from -1
        best = np.full((goal + 1, n), np.inf)
        best[0] = 0
        choice = np.zeros((m, goal + 1, n), np.int8)
        for i, cost in enumerate(costs):
            after = np.full((goal + 1, n), np.inf)
            for total in range(goal + 1):
                for step in range(min(steps, total + 1)):
                    value = best[total - step] + cost[:, step]
                    better = value < after[total]
                    after[total][better] = value[better]
                    choice[i, total][better] = step
            best = after
        left, out = np.full(n, goal), np.zeros((n, m), np.int64)
        for i in reversed(range(m)):
            out[:, i] = choice[i, left, np.arange(n)]
            left = left - out[:, i]
        return out - 1

    def probes(self, fps):
        """(key, fp) of all probes."""
        thresholds = self.thresholds(fps)
        for i, keys in enumerate(self.keys(fps)):
            for r, masks in enumerate(self.masks[i]):
                own = thresholds[:, i] >= r
                if own.any():
                    yield (keys[own][:, None] ^ masks[None, :]).ravel(), np.repeat(fps[own], len(masks))


def _pairs(keys, fps):
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(fps, pa.int64())], ["key", "fp"])


def plan_for(fps, distance=DISTANCE):
    """(plan, index rows): the bits in groups, and the commonest values of each group over all fingerprints."""
    correlation, rows = correlations(fps)
    groups = bit_groups(correlation, group_count(rows, distance))
    blank = Plan(groups, [{} for _ in groups], rows, distance)

    def index(batches):
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False)
            for keys in blank.keys(values):
                yield _pairs(keys, values)

    index_rows = mapped(fps.select("fp"), index, "key long, fp long")
    sizes = index_rows.groupBy("key").agg(F.count("*").alias("n"))
    top = sizes.where("n > 1").orderBy(F.desc("n"), "key").limit(COMMON_VALUES * len(groups)).collect()
    common = [{} for _ in groups]
    for r in top:
        place = r["key"] >> 58 if len(groups) > 1 else 0
        common[place][r["key"] ^ (place << 58)] = r["n"]
    return Plan(groups, common, rows, distance), index_rows


def links(fps, distance=DISTANCE):
    """(u, v) of all pairs of different fingerprints within ``distance`` bits, u < v; ``fps`` has each once."""
    plan, index_rows = plan_for(fps, distance)
    shared = fps.sparkSession.sparkContext.broadcast(plan)  # bounded: COMMON_VALUES for each group

    def probe(batches):
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False)
            for low in range(0, len(values), 1 << 14):
                for keys, own in shared.value.probes(values[low : low + (1 << 14)]):
                    for part in range(0, len(keys), 1 << 20):
                        yield _pairs(keys[part : part + (1 << 20)], own[part : part + (1 << 20)])

    probes = mapped(fps.select("fp"), probe, "key long, fp long")
    near = F.bit_count(F.col("probe.fp").bitwiseXOR(F.col("index.fp"))) <= distance
    pair = (F.col("probe.key") == F.col("index.key")) & (F.col("probe.fp") != F.col("index.fp")) & near
    found = probes.alias("probe").join(index_rows.alias("index"), pair)
    low, high = F.least("probe.fp", "index.fp"), F.greatest("probe.fp", "index.fp")
    return found.select(low.alias("u"), high.alias("v")).distinct()


def near_groups(rows, shingle=SHINGLE, distance=DISTANCE):
    """doc_id, file, row, fp, root (a fingerprint of the group) and component_id of every document of ``rows``."""
    prints = written(fingerprints(rows, shingle), "fingerprints")
    fps = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    fps = written(fps, "distinct")
    roots = components(links(fps, distance)).withColumnRenamed("node", "fp")
    roots = fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(roots.drop("least").join(ids, "root"), "fp")


def hex_of(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def survivors(groups):
    """The document of each group that stays, by file and row: the smallest doc_id, null last, then the first place."""
    chosen = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return chosen.groupBy("root").agg(F.min(F.struct("file", "row")).alias("place")).select("place.*")


def report(docs, shingle=SHINGLE, distance=DISTANCE):
    groups = near_groups(located(docs), shingle, distance)
    return groups.select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def distinct_groups(docs, shingle=SHINGLE, distance=DISTANCE):
    """The documents without the near-duplicates of the one that stays in each group."""
    rows = located(docs)
    groups = near_groups(rows, shingle, distance).select("doc_id", "file", "row", "root", "component_id")
    groups = written(groups, "groups")
    stay = survivors(groups).withColumn("stays", F.lit(True))
    gone = groups.join(stay, ["file", "row"], "left").where(F.col("stays").isNull())
    return bloom.without(rows, gone.select(F.xxhash64("file").alias("file_id"), "row"))
