"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are folded first: letters lower-cased, every run of other characters one blank. Each n-gram of one to three folded
characters falls into one of 2^16 buckets. Training counts buckets per language inside the tasks and adds the counts up
in Spark into a table, of which the matrix of smoothed log-probabilities (languages x buckets) is made block by block, at
most ``LANGUAGES`` rows at a time. A block is broadcast, and tasks score a chunk of texts at a time as a sparse
row-times-matrix product in numpy. With more languages the texts are read once for each block, and each text's best language
of a block, its score and the sum of all scores meet in an aggregation; neither the driver nor a worker ever holds more than
one block, so any number of languages is learned.

Edge cases: a null text, or one without a letter, gives ``und`` and score 0, and so does an empty training set. Equal
scores give the language that sorts first. Rows without a label are not learned from. Repeated rows count repeatedly.
Very long texts are scored whole. Other columns are kept; a column named like a result is replaced.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kerbline.llm import buffers
from kerbline.llm.frames import as_text, fresh, located, mapped, schema_with, written

ORDERS = 3
BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
LANGUAGES = 128
TALLIED = 16
SMOOTHING = 0.5
UNKNOWN = "und"
_tables = {}


def fold_table():
    """Lower-case code point of every letter, 0 for everything else; built once in a worker."""
    if "fold" not in _tables:
        table = np.zeros(0x110000, np.uint32)
        for code in range(0x110000):
            char = chr(code)
            if char.isalpha():
                low = char.lower()
                table[code] = ord(low) if len(low) == 1 else code
        _tables["fold"] = table
    return _tables["fold"]


def folded(data, offsets):
    """(folded characters, row of each, letters per row)."""
    codes, spots = buffers.codepoints(data, offsets)
    codes = fold_table()[codes]
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(spots))
    letters = buffers.sums_by_row(codes != 0, spots)
    keep = codes != 0
    keep[1:] |= codes[:-1] != 0
    return codes[keep], rows[keep], letters


def grams(codes, rows):
    """(bucket, row) arrays of all n-grams, one pair for each order."""
    multipliers = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
    for order in range(1, ORDERS + 1):
        n = len(codes) - order + 1
        if n <= 0:
            return
        code = np.full(n, order * 0x27D4EB2F & 0xFFFFFFFF, np.uint32)
        for i in range(order):
            code += codes[i : i + n] * multipliers[i]
            code ^= code >> np.uint32(15)
            code *= np.uint32(0x2C1B3C6D)
        code ^= code >> np.uint32(13)
        own = rows[:n] == rows[order - 1 :]
        if order == 1:
            own &= codes != 0
        yield (code >> np.uint32(32 - BUCKET_BITS))[own].astype(np.int64), rows[:n][own]


def _count(batches):
    """(lang, bucket, n) of a task; bucket -1 holds the number of texts. Few languages are tallied at a time."""
    tallies = {}

    def rows():
        for lang, (texts, counts) in tallies.items():
            used = np.flatnonzero(counts)
            n = len(used) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * n, pa.string()),
                    pa.array(np.append(used, -1).astype(np.int32)),
                    pa.array(np.append(counts[used], texts)),
                ],
                ["lang", "bucket", "n"],
            )
        tallies.clear()

    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        for low, high, data, offsets in buffers.parts(batch, "text"):
            names, code = np.unique(langs[low:high].astype(str), return_inverse=True)
            codes, rows_of, _ = folded(data, offsets)
            keys = np.concatenate([code[row] * BUCKETS + bucket for bucket, row in grams(codes, rows_of)] or [code[:0]])
            keys, times = np.unique(keys, return_counts=True)
            edges = np.searchsorted(keys, np.arange(len(names) + 1) * BUCKETS)
            for i, name in enumerate(names):
                if name not in tallies and len(tallies) >= TALLIED:
                    yield from rows()
                texts, sums = tallies.get(name, (0, None))
                sums = np.zeros(BUCKETS, np.int64) if sums is None else sums
                own = slice(edges[i], edges[i + 1])
                sums[keys[own] - i * BUCKETS] += times[own]
                tallies[name] = texts + int((code == i).sum()), sums
    yield from rows()


class Model:
    """Counts by language and bucket, as a table, and the number of texts of each language; iterating it makes one block of
    (languages, log priors, log-probabilities by language and bucket) at a time."""

    def __init__(self, counts, sizes, smoothing):
        self.counts, self.sizes, self.smoothing = counts, sizes, smoothing
        names = sorted(sizes)
        self.names = [names[low : low + LANGUAGES] for low in range(0, len(names), LANGUAGES)]

    def __len__(self):
        return len(self.names)

    def __iter__(self):
        for langs in self.names:
            own = self.counts.where((F.col("bucket") >= 0) & F.col("lang").isin(langs))
            place = F.array_position(F.array(*map(F.lit, langs)), F.col("lang")).cast("int") - 1
            found = own.select(place.alias("place"), "bucket", "n").toArrow()  # at most LANGUAGES * BUCKETS rows
            matrix = np.full((len(langs), BUCKETS), self.smoothing)
            matrix[found.column("place").to_numpy(), found.column("bucket").to_numpy()] += found.column("n").to_numpy()
            logs = np.log(matrix / matrix.sum(1, keepdims=True)).astype(np.float32)
            sizes = np.array([self.sizes[lang] for lang in langs], float)
            yield langs, np.log(sizes / max(1, sum(self.sizes.values()))), logs


def fit(docs, smoothing=SMOOTHING):
    """The model of columns ``text`` and ``lang``."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    slim = known.select(F.col("lang").cast("string").alias("lang"), as_text(F.col("text")).alias("text"))
    counts = mapped(slim, _count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = written(counts, "languages")
    return Model(counts, {r["lang"]: r["n"] for r in counts.where("bucket = -1").collect()}, smoothing)


def block_scores(block, found, n):
    """(place of the best language in the block, its log score, sum of all scores relative to it) of each row."""
    langs, priors, logs = block
    total = np.tile(priors, (n, 1))
    for bucket, row in found:
        for i in range(len(langs)):
            total[:, i] += np.bincount(row, weights=logs[i][bucket], minlength=n)
    best = total.argmax(1)
    top = total[np.arange(n), best]
    return best, top, np.exp(total - top[:, None]).sum(1)


def scores(blocks, data, offsets):
    """(best language index over all blocks or -1, posterior probability) of each row."""
    n = len(offsets) - 1
    best, top, odds, low = np.full(n, -1), np.full(n, -np.inf), np.zeros(n), 0
    codes, rows, letters = folded(data, offsets)
    found = list(grams(codes, rows))
    for block in blocks:
        own, here, sums = block_scores(block, found, n)
        best = np.where(here > top, low + own, best)
        most = np.maximum(top, here)
        odds = odds * np.exp(top - most) + sums * np.exp(here - most)
        top, low = most, low + len(block[0])
    if not low:
        return best, np.zeros(n)
    return np.where(letters > 0, best, -1), np.where(letters > 0, 1 / odds, 0.0)


def predict(docs, model):
    """Add lang_pred and score to ``docs`` (column ``text``)."""
    added = {"lang_pred": "string", "score": "double"}
    plain = docs.select([f"`{c}`" for c in docs.columns if c.lower() not in added])
    if len(model) > 1:
        return _predict_by_blocks(plain, model)
    context = docs.sparkSession.sparkContext
    shared = [context.broadcast(block) for block in model]  # bounded: LANGUAGES * BUCKETS floats
    (raw,) = fresh(docs, "raw")
    known = [lang for langs in model.names for lang in langs]

    def run(batches):
        names = np.array([*known, UNKNOWN], object)
        for batch in batches:
            for low, high, data, offsets in buffers.parts(batch, raw):
                best, score = scores((block.value for block in shared), data, offsets)
                values = {"lang_pred": pa.array(names[best], pa.string()), "score": pa.array(score)}
                yield buffers.with_columns(batch.slice(low, high - low).drop_columns([raw]), values)

    return mapped(plain.withColumn(raw, as_text(F.col("text"))), run, schema_with(plain, **added))


def _block_results(shared):
    def run(batches):
        langs, priors, logs = shared.value
        names = np.array(langs, object)
        for batch in batches:
            for low, high, data, offsets in buffers.parts(batch, "text"):
                codes, rows, letters = folded(data, offsets)
                best, top, odds = block_scores((langs, priors, logs), list(grams(codes, rows)), high - low)
                best = np.where(letters > 0, names[best], UNKNOWN)
                values = [batch.column(c).slice(low, high - low) for c in ("file_id", "row")]
                values += [pa.array(best, pa.string()), pa.array(top), pa.array(odds)]
                yield pa.RecordBatch.from_arrays(values, ["file_id", "row", "lang", "top", "odds"])

    return run


def _predict_by_blocks(docs, model):
    """One pass over the texts for each block of languages; results of a text are put together by its place in the files."""
    context = docs.sparkSession.sparkContext
    rows = located(docs)
    texts = rows.select(F.xxhash64("file").alias("file_id"), "row", as_text(F.col("doc.text")).alias("text"))
    found = None
    for number, block in enumerate(model):
        shared = context.broadcast(block)  # bounded: LANGUAGES * BUCKETS floats
        part = mapped(texts, _block_results(shared), "file_id long, row long, lang string, top double, odds double")
        part = written(part.withColumn("number", F.lit(-number)), "scores")
        shared.destroy()
        found = part if found is None else found.unionByName(part)
    best = F.max(F.struct("top", "number", "lang"))
    per = found.groupBy("file_id", "row").agg(best.alias("best"), F.collect_list(F.struct("top", "odds")).alias("all"))
    sums = F.aggregate("all", F.lit(0.0), lambda total, x: total + x["odds"] * F.exp(x["top"] - F.col("best.top")))
    lang = F.col("best.lang")
    per = per.select("file_id", "row", lang.alias("lang_pred"), F.when(lang != UNKNOWN, 1 / sums).otherwise(0.0).alias("score"))
    placed = rows.select("doc", F.xxhash64("file").alias("file_id"), "row").join(per, ["file_id", "row"])
    return placed.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns], "lang_pred", "score")


def crc_remainder(ids, modulus):
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(ids.cast("string"), F.lit(""))) % modulus
