"""Quality rules: counts of each text, and its divergence from language references.

A reference holds, for one language, how often each character class and each of its commonest words occurs over all
documents of that language. It needs at least ``REFERENCE_TEXTS`` different texts and ``REFERENCE_WORDS`` words: a label
with less says nothing about a language, and its texts are judged by the other references. No text is its own measure: its
counts are taken off the reference of its own label, and off the one over all documents, before the two are compared.

A document is compared with every reference by Jensen-Shannon distance (base 2, 0 to 1); the nearest reference counts, so a
missing or wrong language label does not matter. A document fails if its characters are
further than ``CLASS_LIMIT``, or its words further than ``WORD_LIMIT``, from all references. Short texts say little about
either: below ``CLASS_WORDS`` or ``COMMON_WORDS`` words the respective test is not made.

The word distance is told relative to the reference: a text with none of its common words is at a distance that depends on
how much of the language they cover. ``WORD_SHARE`` of that distance, if it is below ``WORD_LIMIT``, is scaled to
``WORD_LIMIT``, so words alone that a language does not know fail. The reference over all documents mixes languages and is
not used for words where there is another one.

A text whose script is that of no reference, like Russian where all languages are written in Latin letters, is compared with
nothing that says anything about it: neither test is made, and both distances are 0. So it is where there is no reference.

References: one for every language, one over the documents without a label, and one over all documents, if they meet the
guards above; each is at most ``TOP_WORDS`` words. They are broadcast in blocks of ``LANGUAGES``, and a text keeps its least distances from block to block.

Edge cases: null and empty texts have no words and fail the base rules; a null label counts as a label of its own, and so do
rows without a column ``lang``; repeated rows are judged alike and are one text for the guard; an empty table gives no rows;
very long texts are processed whole, one per chunk.
"""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kerbline.llm import buffers
from kerbline.llm.frames import as_text, fresh, mapped, schema_with, written

#: Fixed: the characters that the contract counts as symbols.
SYMBOLS = b"#*$%&|<>"
CLASS_NAMES = ("upper", "lower", "digit", "space", "line", "stop", "quote", "symbol", "control", "beyond ASCII")
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
LANGUAGES, TOP_WORDS = 64, 200
#: Guards of the references: different texts and words.
REFERENCE_TEXTS, REFERENCE_WORDS = 20, 4_000
CLASS_WORDS, COMMON_WORDS = 40, 60
CLASS_LIMIT, WORD_LIMIT = 0.30, 0.55
WORD_SHARE = 0.97
ALL, UNLABELLED = "*", "*null"
#: Scripts by the first two bytes of a letter: 0 is Latin, -1 no letter of a script.
SCRIPTS = 40
SLICES = 32
FLUSH = 100_000


def _class_table():
    table = np.full(256, CLASS_NAMES.index("symbol"), np.int64)
    table[:32] = table[127] = CLASS_NAMES.index("control")
    table[list(b" \t")] = CLASS_NAMES.index("space")
    table[list(b"\n\r\x0b\x0c")] = CLASS_NAMES.index("line")
    table[65:91], table[97:123] = CLASS_NAMES.index("upper"), CLASS_NAMES.index("lower")
    table[48:58] = CLASS_NAMES.index("digit")
    table[list(b".,;:!?")] = CLASS_NAMES.index("stop")
    table[list(b"'\"()-")] = CLASS_NAMES.index("quote")
    table[128:] = CLASS_NAMES.index("beyond ASCII")
    return table


def _script_table():
    table = np.full((256, 256), -1, np.int64)
    table[65:91], table[97:123], table[0xC3:0xCD] = 0, 0, 0
    spans = (0xCD, 0xCF), (0xD0, 0xD4), (0xD5, 0xD6), (0xD7, 0xD7), (0xD8, 0xDD), (0xDE, 0xDF), (0xE3, 0xE9), (0xEA, 0xED)
    for i, (low, high) in enumerate(spans):
        table[low : high + 1] = i + 1
    table[0xE0] = 16 + ((np.arange(256) >> 1) & 15)
    table[0xE1] = 32 + ((np.arange(256) >> 3) & 7)
    return table


SCRIPT_OF = _script_table()
CLASS_OF = _class_table()
IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))


def _continues(data):
    """Bytes of a code point behind its first."""
    return (data & 0xC0) == 0x80


def class_counts(data, offsets):
    """Code points of each class in each row."""
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    first = ~_continues(data)
    cells = rows[first] * len(CLASS_NAMES) + CLASS_OF[data[first]]
    return np.bincount(cells, minlength=(len(offsets) - 1) * len(CLASS_NAMES)).reshape(-1, len(CLASS_NAMES))


def script_counts(data, offsets):
    """Letters of each script in each row."""
    n_rows = len(offsets) - 1
    first = np.flatnonzero(~_continues(data))
    script = SCRIPT_OF[data[first], data[np.minimum(first + 1, len(data) - 1)]]
    rows = np.repeat(np.arange(n_rows), np.diff(offsets))[first]
    cells = (rows * SCRIPTS + script)[script >= 0]
    return np.bincount(cells, minlength=n_rows * SCRIPTS).reshape(-1, SCRIPTS)


def main_script(counts):
    """Script of more than half of the letters of each row, or -1."""
    return np.where(2 * counts.max(1) > counts.sum(1), counts.argmax(1), -1)


def repeated_words(hashes, rows, n_rows, window=WINDOW):
    """Words of each row in windows of ``window`` words found twice or more in the row."""
    n = len(hashes)
    if n < window:
        return np.zeros(n_rows, np.int64)
    spread = buffers.Hasher(buffers.mix(hashes))
    starts = np.arange(n - window + 1)
    starts = starts[rows[starts] == rows[starts + window - 1]]
    keys = spread.of(starts, starts + window) + buffers.mix(rows[starts].astype(np.uint64) + np.uint64(1))
    _, group, size = np.unique(keys, return_inverse=True, return_counts=True)
    hits = starts[size[group] > 1]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, hits, 1)
    np.add.at(edge, hits + window, -1)
    return np.bincount(rows[np.cumsum(edge[:n]) > 0], minlength=n_rows)


def repeated_lines(text):
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def base_counts(data, offsets):
    """The five base counts of each row, and the words' bounds, rows and hashes."""
    n_rows = len(offsets) - 1
    starts, ends, rows = buffers.word_bounds(data, offsets)
    hashes = buffers.Hasher(buffers.SYMBOL_CODES[data]).of(starts, ends)
    raw = data.tobytes()
    counts = {
        "n_words": np.bincount(rows, minlength=n_rows),
        "word_chars": buffers.sums_by_row(~buffers.SPACES[data] & ~_continues(data), offsets),
        "n_symbols": buffers.sums_by_row(IS_SYMBOL[data], offsets),
        "n_dup_lines": np.array([repeated_lines(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], np.int64),
        "n_repeat_words": repeated_words(hashes, rows, n_rows),
    }
    return counts, starts, ends, rows


def _tallies(batches):
    """(lang, key, n) of a task: words under w, character classes under c, scripts under s; texts without a label under ``UNLABELLED``."""
    words, classes, scripts = {}, {}, {}

    def rows():
        out = [(lang, b"w" + key, n) for lang, tally in words.items() for key, n in tally.items()]
        out += [(lang, b"c%d" % i, int(n)) for lang, sums in classes.items() for i, n in enumerate(sums)]
        out += [(lang, b"s%d" % i, int(n)) for lang, sums in scripts.items() for i, n in enumerate(sums) if n]
        words.clear()
        classes.clear()
        scripts.clear()
        langs, keys, counts = zip(*out) if out else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(keys, pa.binary()), pa.array(counts, pa.int64())], ["lang", "key", "n"]
        )

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for low, _, data, offsets in buffers.parts(batch, "text"):
            sums, letters = class_counts(data, offsets), script_counts(data, offsets)
            raw = buffers.LOWER[data].tobytes()
            for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
                lang = langs[low + i] if langs[low + i] is not None else UNLABELLED
                words.setdefault(lang, Counter()).update(raw[a:b].split())
                classes[lang] = classes.get(lang, 0) + sums[i]
                scripts[lang] = scripts.get(lang, 0) + letters[i]
            if sum(map(len, words.values())) > FLUSH:
                yield rows()
    yield rows()


def _different_texts(slim):
    """{label: number of different texts}, with the number of all under ``ALL``."""
    label = F.coalesce("lang", F.lit(UNLABELLED)).alias("lang")
    digests = slim.select(label, F.xxhash64("text").alias("digest"))
    count = F.count_distinct("digest").alias("n")
    rows = digests.groupBy("lang").agg(count).unionAll(digests.agg(count).select(F.lit(ALL), "n")).collect()
    return {r["lang"]: r["n"] for r in rows}


def references(docs, top_words=TOP_WORDS, texts=REFERENCE_TEXTS, words=REFERENCE_WORDS):
    """{language: (class counts, {word: count}, other words, main script)}, with one under ``ALL`` for all documents and one
    under ``UNLABELLED`` for those without a language; those with less than so many texts and words are left out."""
    slim = docs.select(F.col("lang").cast("string").alias("lang"), as_text(F.col("text")).alias("text"))
    tallies = mapped(slim, _tallies, "lang string, key binary, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    tallies = written(tallies, "tallies")
    everything = tallies.groupBy("key").agg(F.sum("n").alias("n")).withColumn("lang", F.lit(ALL))
    wanted = tallies.unionByName(everything)
    is_word = F.substring("key", 1, 1) == F.lit(b"w")
    # first in slices of the vocabulary, so that what meets for a language is SLICES * top_words rows, however many tasks
    # there are; each rank limit is also applied in every task before its exchange
    ranked = [F.desc("n"), "key"]
    top = wanted.where(is_word).withColumn("slice", F.pmod(F.xxhash64("key"), F.lit(SLICES)))
    for keys in (("lang", "slice"), ("lang",)):
        place = F.row_number().over(W.partitionBy(*keys).orderBy(*ranked))
        top = top.withColumn("rank", place).where(F.col("rank") <= top_words)
    totals = wanted.where(is_word).groupBy("lang").agg(F.sum("n").alias("n"))
    out = {}
    for r in wanted.where(~is_word).collect():
        key = bytes(r["key"])
        own = out.setdefault(r["lang"], (np.zeros(len(CLASS_NAMES)), {}, np.zeros((1, SCRIPTS))))
        if key[:1] == b"c":
            own[0][int(key[1:])] = r["n"]
        else:
            own[2][0, int(key[1:])] = r["n"]
    for r in top.select("lang", "key", "n").collect():
        out[r["lang"]][1][bytes(r["key"])[1:]] = r["n"]
    sums = {r["lang"]: r["n"] for r in totals.collect()}
    different = _different_texts(slim)
    return {
        k: (c, w, sums.get(k, 0) - sum(w.values()), int(main_script(x)[0]))
        for k, (c, w, x) in sorted(out.items())
        if sums.get(k, 0) >= words and different.get(k, 0) >= texts
    }


def js_distance(p, q):
    """Jensen-Shannon distance of each row of ``p`` from ``q``, which has one row or as many; rows without counts are at
    distance 0."""
    total = p.sum(1, keepdims=True)
    p = np.divide(p, total, out=np.zeros(p.shape), where=total > 0)
    sums = q.sum(-1, keepdims=True)
    q = np.divide(q, sums, out=np.zeros(q.shape), where=sums > 0)
    m = (p + q) / 2

    def part(x):
        x = np.broadcast_to(x, m.shape)
        ratio = np.divide(x, m, out=np.ones(m.shape), where=x > 0)
        return (x * np.log2(ratio)).sum(1)

    divergence = np.clip((part(p) + part(q)) / 2, 0, 1)
    return np.where(total[:, 0] > 0, np.sqrt(divergence), 0.0)


def _scale(counts):
    """What brings ``WORD_SHARE`` of the distance of a text without common words to ``WORD_LIMIT``; 1 if it is above."""
    blank = np.zeros((1, len(counts)))
    blank[0, -1] = 1
    return max(1.0, WORD_LIMIT / (WORD_SHARE * max(js_distance(blank, counts)[0], 1e-9)))


def _without(counts, own, belongs):
    """The counts of a reference for each row: less the row's own where it belongs to the reference."""
    return np.maximum(counts - np.where(belongs[:, None], own, 0), 0)


class Judge:
    """Distances of texts from a block of references; shipped to the tasks."""

    def __init__(self, references):
        self.names = list(references)
        self.classes = [c for c, _, _, _ in references.values()]
        self.scripts = {script for name, (_, _, _, script) in references.items() if name != ALL}
        vocabulary = sorted({word for _, words, _, _ in references.values() for word in words})
        place = {word: i for i, word in enumerate(vocabulary)}
        raw = np.frombuffer(b"".join(vocabulary), np.uint8)
        ends = np.cumsum([0, *map(len, vocabulary)])
        hashes = buffers.Hasher(buffers.SYMBOL_CODES[raw]).of(ends[:-1], ends[1:])
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.words = []
        for name, (_, words, other, _) in references.items():
            spots = np.full(len(vocabulary), -1, np.int32)
            spots[[place[w] for w in words]] = np.arange(len(words))
            counts = np.array([*words.values(), other], float)
            self.words.append((name, spots, counts, _scale(counts)))

    def named(self):
        """Whether the block has a reference other than that over all documents."""
        return any(name != ALL for name in self.names)

    def distances(self, data, offsets, starts, ends, rows, labels, over_all=True):
        n, size = len(offsets) - 1, len(self.hashes)
        of_class, of_words = np.full(n, np.inf), np.full(n, np.inf)
        chars = class_counts(data, offsets).astype(float)
        for name, counts in zip(self.names, self.classes):
            belongs = (labels == name) | (name == ALL)
            of_class = np.minimum(of_class, js_distance(chars, _without(counts, chars, belongs)))
        if not size:
            return of_class, of_words
        found = buffers.Hasher(buffers.SYMBOL_CODES[buffers.LOWER[data]]).of(starts, ends)
        spot = np.minimum(np.searchsorted(self.hashes, found), size - 1)
        known = self.hashes[spot] == found
        word, row = self.order[spot[known]], rows[known]
        n_words = np.bincount(rows, minlength=n)
        for name, spots, counts, scale in self.words:
            if name == ALL and not over_all:
                continue
            width = len(counts)
            at = spots[word]
            mine = at >= 0
            own = np.bincount(row[mine] * width + at[mine], minlength=n * width).reshape(n, width).astype(float)
            own[:, -1] = n_words - own.sum(1)
            belongs = (labels == name) | (name == ALL)
            of_words = np.minimum(of_words, js_distance(own, _without(counts, own, belongs)) * scale)
        return of_class, of_words


def judges(spark, refs):
    """Broadcasts of the references in blocks: at most LANGUAGES * TOP_WORDS words each."""
    names = list(refs)
    blocks = [names[i : i + LANGUAGES] for i in range(0, len(names), LANGUAGES)] or [[]]
    return [spark.sparkContext.broadcast(Judge({name: refs[name] for name in block})) for block in blocks]


def _verdicts(shared, data, offsets, labels, class_limit, word_limit):
    """Result columns of each row of a chunk."""
    counts, starts, ends, rows = base_counts(data, offsets)
    judges = [block.value for block in shared]
    over_all = not any(judge.named() for judge in judges)
    found = [judge.distances(data, offsets, starts, ends, rows, labels, over_all) for judge in judges]
    of_class, of_words = (np.min(x, 0) for x in zip(*found))
    of_class, of_words = (np.where(np.isinf(x), 0.0, np.minimum(x, 1.0)) for x in (of_class, of_words))
    script = main_script(script_counts(data, offsets))
    foreign = (script > 0) & ~np.isin(script, [x for judge in judges for x in judge.scripts])
    of_class, of_words = np.where(foreign, 0.0, of_class), np.where(foreign, 0.0, of_words)
    n = counts["n_words"]
    failed = (n < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * n)
    near = ((n < CLASS_WORDS) | (of_class <= class_limit)) & ((n < COMMON_WORDS) | (of_words <= word_limit))
    values = {name: pa.array(x, pa.int64()) for name, x in counts.items()}
    values |= {"base_failed": pa.array(failed), "class_distance": pa.array(of_class)}
    return values | {"word_distance": pa.array(of_words), "kept": pa.array(~failed & near)}


def _label(docs):
    """The text's label as the references know it."""
    named = any(c.lower() == "lang" for c in docs.columns)
    return F.coalesce(F.col("lang").cast("string") if named else F.lit(None).cast("string"), F.lit(UNLABELLED))


def judge(docs, refs, class_limit=CLASS_LIMIT, word_limit=WORD_LIMIT):
    """Add the base counts, base_failed, both distances and kept to ``docs`` (column ``text``)."""
    shared = judges(docs.sparkSession, refs)
    raw, label = fresh(docs, "raw", "label")
    added = dict.fromkeys(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), "long")
    added |= {"base_failed": "boolean", "class_distance": "double", "word_distance": "double", "kept": "boolean"}
    plain = docs.select([f"`{c}`" for c in docs.columns if c.lower() not in added])

    def run(batches):
        for batch in batches:
            labels = np.array(batch.column(label).to_pylist(), object)
            for low, high, data, offsets in buffers.parts(batch, raw):
                values = _verdicts(shared, data, offsets, labels[low:high], class_limit, word_limit)
                yield buffers.with_columns(batch.slice(low, high - low).drop_columns([raw, label]), values)

    whole = plain.withColumns({raw: as_text(F.col("text")), label: _label(plain)})
    return mapped(whole, run, schema_with(plain, **added))


def passing(docs, refs, class_limit=CLASS_LIMIT, word_limit=WORD_LIMIT):
    """The documents that are kept, with their own columns only; the text goes to the tasks once."""
    shared = judges(docs.sparkSession, refs)
    place = [c.lower() for c in docs.columns].index("text")
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    whole = docs.select(doc, _label(docs).alias("label"))

    def run(batches):
        for batch in batches:
            texts = batch.column("doc").field(place).cast(pa.large_binary())
            texts = pa.RecordBatch.from_arrays([texts], ["text"])
            labels = np.array(batch.column("label").to_pylist(), object)
            for low, high, data, offsets in buffers.parts(texts, "text"):
                kept = _verdicts(shared, data, offsets, labels[low:high], class_limit, word_limit)["kept"]
                yield batch.slice(low, high - low).select(["doc"]).filter(kept)

    return mapped(whole, run, whole.select("doc").schema).select("doc.*")
