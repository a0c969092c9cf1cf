"""Mixing sources to target weights along a curriculum.

Every source has a number of words to give (its target) and a schedule: a piecewise linear weight over training time,
scaled so that its integral is the target. The documents of a source are strung together in the order of the MD5 of their
ids, once for each pass; a document lies at a cumulative word offset, and inverting the integrated schedule at that offset
gives its training position between 0 and 1. Sorting by position gives the training order.

Targets: sources in code point order, null last, weigh 3, 1, 2, repeating, and share ``SHARE`` of all words; none is above
``PASSES`` times its source's words, what is left over is shared by weight among the others. With targets
min(PASSES * words, level * weight) the level is the largest of (share - words of the k first to fill up) / (weights of the
others), over all k, so one sum over the sources in order of words / weight gives it.

Whole documents are taken: a copy of a document is in if its middle lies before the target. Then each source gets one
copy more or less, of the document whose size is nearest to what is missing or too much, if that comes closer.

The sums along a source go through a fixed number of slices of the id hash: first sums per slice, then within slices, so
a source that holds most rows is spread over all tasks. Only the table of sources, one row each, meets in one task.

Edge cases: null text has size 0 and null source is a source of its own; a document of size 0, or with a null id, is
handled like any other (the null id hashes as empty text); repeated rows are separate documents; empty tables and sources
without words get target 0 and take nothing; any further columns are kept and may have any names.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kerbline.llm.frames import located, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
PASSES = 2
#: Weights at equally spaced times from start to end, repeating like the weights of the sources.
SCHEDULES = ((1, 2, 1), (2, 1), (1, 3))
SLICE_DIGITS = 3
WORD = r"[^\x20\x09-\x0D]+"


def text_size(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_key(source):
    """Text that sorts like the source by code point, null last."""
    return F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source.cast("string")))


def position_sql(share, schedule):
    """SQL: the time by which a source with this schedule has given ``share`` (SQL, 0 to 1) of its words."""
    width = 1.0 / (len(schedule) - 1)
    areas = [(a + b) / 2 * width for a, b in zip(schedule, schedule[1:])]
    cases, done = [], 0.0
    for i, (a, b) in enumerate(zip(schedule, schedule[1:])):
        area = f"({share} * {sum(areas)!r}D - {done!r}D)"
        time = f"{i * width!r}D + CASE WHEN {area} > 0 THEN 2 * {area} / ({a!r}D + sqrt(greatest({a * a!r}D + {2 * (b - a) / width!r}D * {area}, 0D))) ELSE 0D END"
        done += areas[i]
        cases.append(f"WHEN {share} * {sum(areas)!r}D <= {done!r}D THEN {time}" if i + 2 < len(schedule) else f"ELSE {time}")
    body = " ".join(cases) if len(cases) > 1 else f"WHEN true THEN {time}"
    return f"least(CASE {body} END, 1D)"


def targets(sizes, weights=WEIGHTS, share=SHARE, passes=PASSES):
    """One row per source: skey, place (rank from 0), source_size and target."""
    sources = sizes.groupBy("skey").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("place", (F.row_number().over(W.orderBy("skey")) - 1).cast("int"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights)) + 1)
    sources = sources.withColumn("weight", weight)
    full = F.lit(float(passes)) * F.col("source_size")
    order = W.orderBy(full / F.col("weight"), "skey")
    before = F.coalesce(F.sum(full).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    total = F.sum("source_size").over(W.partitionBy())
    sources = sources.withColumns({"before": before, "rest": rest, "total": total})
    level = F.max((F.lit(float(share)) * F.col("total") - F.col("before")) / F.col("rest")).over(W.partitionBy())
    return sources.select("skey", "place", "source_size", F.least(full, level * F.col("weight")).alias("target"))


def assign(rows, weights=WEIGHTS, share=SHARE, passes=PASSES, schedules=SCHEDULES):
    """Where and how often each document of ``rows`` (see ``located``) is taken: file, row, doc_id, size, source_size,
    target, copies, positions."""
    slim = rows.select(
        "file",
        "row",
        "doc.doc_id",
        source_key(F.col("doc.source")).alias("skey"),
        text_size(F.col("doc.text")).alias("size"),
        F.md5(F.coalesce(F.col("doc.doc_id").cast("string"), F.lit("")).cast("binary")).alias("order"),
    )
    slim = written(slim.withColumn("slice", F.substring("order", 1, SLICE_DIGITS)), "sizes")
    sources = targets(slim, weights, share, passes)
    slices = slim.groupBy("skey", "slice").agg(F.sum("size").alias("words"))
    along = W.partitionBy("skey").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    slices = slices.withColumn("ahead", F.coalesce(F.sum("words").over(along), F.lit(0))).drop("words")
    slices = slices.join(sources, "skey")
    inside = W.partitionBy("skey", "slice").orderBy("order", "doc_id", "size", "file", "row")
    inside = inside.rowsBetween(W.unboundedPreceding, -1)
    placed = slim.withColumn("start", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(slices, ["skey", "slice"]).withColumn("start", F.col("start") + F.col("ahead"))
    copies = sum(
        ((F.lit(2 * i) * F.col("source_size") + F.lit(2) * F.col("start") + F.col("size")) < F.lit(2) * F.col("target"))
        .cast("int")
        for i in range(passes)
    )
    placed = written(placed.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0)), "placed")

    # small tables, one row per source, are written: joins with them are broadcast within the session's bound, or split
    gaps = placed.groupBy("skey").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("gap"))
    gaps = written(gaps, "gaps")
    near = placed.where("size > 0").join(gaps, "skey")
    can = (F.col("gap") > 0) & (F.col("copies") < passes) | (F.col("gap") < 0) & (F.col("copies") > 0)
    off = F.abs(F.abs("gap") - F.col("size"))
    near = near.where(can & (off < F.abs("gap"))).groupBy("skey").agg(F.min(off).alias("least"), F.first("gap").alias("gap"))
    fitting = placed.where("size > 0").join(written(near, "near"), "skey")
    can_now = (F.col("gap") > 0) & (F.col("copies") < passes) | (F.col("gap") < 0) & (F.col("copies") > 0)
    fitting = fitting.where(can_now & (F.abs(F.abs("gap") - F.col("size")) == F.col("least")))
    fitting = fitting.groupBy("skey").agg(F.min("start").alias("start"), F.first(F.signum("gap")).cast("int").alias("change"))
    fitting = written(fitting.withColumn("chosen", F.lit(True)), "fitting")
    out = placed.join(fitting, ["skey", "start"], "left")
    change = F.when(F.col("chosen") & (F.col("size") > 0), F.col("change")).otherwise(0)
    out = out.withColumn("copies", (F.col("copies") + change).cast("int"))

    def position(i):
        part = f"least(({i} * source_size + start) / nullif(target, 0D), 1D)"
        kinds = " ".join(f"WHEN {k} THEN {position_sql(part, s)}" for k, s in enumerate(schedules))
        return F.expr(f"CASE WHEN copies > {i} THEN CASE place % {len(schedules)} {kinds} END END")

    return out.select(
        "file", "row", "doc_id", "size", "source_size", "target", "copies", F.array(*[position(i) for i in range(passes)]).alias("positions")
    )


def mix(docs, **options):
    """The documents in training order, one row per copy: ``doc`` (a struct of their columns) and ``position``."""
    rows = located(docs)
    taken = assign(rows, **options).where("copies > 0").select("file", "row", F.explode("positions").alias("position"))
    taken = taken.where(F.col("position").isNotNull())
    return rows.join(taken, ["file", "row"]).orderBy("position", "file", "row").select("doc", "position")


def report(docs, **options):
    """One row per document in order of its first position: doc_id, size, source_size, target, taken, position."""
    out = assign(located(docs), **options)
    first = F.round(F.element_at("positions", 1), 6)
    out = out.withColumn("taken", F.col("copies") * F.col("size")).withColumn("position", first)
    out = out.orderBy(F.col("position").asc_nulls_last(), "doc_id", "file", "row")
    return out.select("doc_id", "size", "source_size", "target", "taken", "position")
