"""Exact deduplication with streaming state.

Texts are equal when they are identical without ASCII white space. The keyed state lives in RocksDB, never expires, and
holds for each digest: how many rows came, the identifier of the row that stays so far (most code points in the original
text, then smallest doc_id), and its content locator (Parquet file and row). It is an ordinary streaming aggregation, so
state, recovery and checkpoints are Spark's. Each micro-batch writes the digests it changed; the newest entry of a digest
counts.

A hit, a row whose digest the state holds for another row too, is checked on its full bytes against the content at the
locator. Rows that only share the digest are split off and grouped by their bytes. A blocked Bloom filter of the digests
with hits keeps the texts of all other rows out of that check's shuffle.

Edge cases: a null text counts as empty, all empty texts are equal; a null doc_id sorts last; repeated rows (same doc_id
and text) are separate rows, of which one stays; empty tables give no rows; very long texts are digested whole; further
columns may have any names.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from kerbline.llm import bloom
from kerbline.llm.frames import located, written
from kerbline.session import ROCKSDB, scratch_dir

WHITE_SPACE = " \t\n\x0b\x0c\r"
BATCH_BYTES = 64 << 30
_LAST_ID = 9223372036854775807


def normalised(text):
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def sha256(text):
    return F.sha2(text, 256)


def _rank():
    """One number per row that orders by code points, then by smallest doc_id: maxima of it aggregate in place."""
    size = F.col("size").cast("decimal(12,0)") * F.lit("18446744073709551616").cast("decimal(20,0)")
    return size - F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_ID)).cast("decimal(20,0)")


def described(rows, digest=sha256):
    """doc_id, locator (file_id, row), normalised text, its digest, and size in code points of the original text."""
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    slim = rows.select(F.col("doc.doc_id").cast("long").alias("doc_id"), F.xxhash64("file").alias("file_id"), "row", text.alias("text"))
    slim = slim.withColumns({"norm": normalised(F.col("text")), "size": F.length("text").cast("long")}).drop("text")
    return slim.withColumn("digest", digest(F.col("norm")))


def grouped(rows, *keys):
    """Size, identifier and locator of each group; a stream of rows keeps them as state without expiry."""
    return (
        rows.withColumn("rank", _rank())
        .groupBy(*keys)
        .agg(
            F.count("*").alias("group_size"),
            F.max_by("doc_id", "rank").alias("keep_id"),
            F.max_by("file_id", "rank").alias("keep_file"),
            F.max_by("row", "rank").alias("keep_row"),
        )
    )


def registry(spark, path, schema, batch_bytes=BATCH_BYTES, max_files=None):
    """Feed the Parquet files below ``path`` through the keyed state; one entry per digest."""
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # without preallocated files a state partition takes a few KB, not 4 MB; commits upload changes only
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    base = scratch_dir(spark, "registry")
    limit = ("maxFilesPerTrigger", max_files) if max_files else ("maxBytesPerTrigger", batch_bytes)
    stream = session.readStream.schema(schema).option(*limit).parquet(path)

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"{base}/entries/batch={number}")

    query = (
        grouped(stream, "digest")
        .writeStream.outputMode("update")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(keep)
        .start()
    )
    query.awaitTermination()
    columns = "digest string, group_size long, keep_id long, keep_file long, keep_row long, batch long"
    try:
        entries = spark.read.schema(columns).parquet(f"{base}/entries")
    except AnalysisException:  # nothing came, so no batch was written
        entries = spark.createDataFrame([], columns)
    newest = [F.max_by(c, "batch").alias(c) for c in ("group_size", "keep_id", "keep_file", "keep_row")]
    return entries.groupBy("digest").agg(*newest)


def impostors(rows, state, digest):
    """Rows whose bytes differ from the content that their digest's entry points to."""
    several = state.where("group_size > 1").select("digest", "keep_file", "keep_row")
    _, maybe = bloom.split(described(rows, digest), F.col("digest"), several, F.col("digest"))
    maybe = written(maybe, "hits")
    held = maybe.select(F.col("file_id").alias("keep_file"), F.col("row").alias("keep_row"), F.col("norm").alias("held"))
    held = several.join(held, ["keep_file", "keep_row"]).select("digest", "held")
    pair = (F.col("hit.digest") == F.col("held.digest")) & (F.col("norm") != F.col("held"))
    return written(maybe.alias("hit").join(held.alias("held"), pair).select("hit.*"), "impostors")


def dedup(docs, **options):
    """One row per document: doc_id, file_id, row, keep_id, group_size, kept and digest."""
    return dedup_rows(located(docs), **options)


def dedup_rows(rows, digest=sha256, batch_bytes=BATCH_BYTES, max_files=None):
    """The same for rows with their locators."""
    spark = rows.sparkSession
    path = scratch_dir(spark, "arrivals")
    described(rows, digest).drop("norm").write.parquet(path)
    came = spark.read.parquet(path)
    state = written(registry(spark, path, came.schema, batch_bytes, max_files), "state")
    out = came.join(state, "digest")
    false_hits = impostors(rows, state, digest)
    if not false_hits.isEmpty():
        own = grouped(false_hits, "digest", "norm")
        own = false_hits.select("file_id", "row", "digest", "norm").join(own, ["digest", "norm"]).drop("digest", "norm")
        own = own.select("file_id", "row", F.struct("group_size", "keep_id", "keep_file", "keep_row").alias("own"))
        lost = false_hits.groupBy("digest").agg(F.count("*").alias("lost"))
        out = out.join(lost, "digest", "left").join(own, ["file_id", "row"], "left")
        left = F.col("group_size") - F.coalesce("lost", F.lit(0))
        out = out.withColumn("group_size", F.coalesce("own.group_size", left))
        for name in ("keep_id", "keep_file", "keep_row"):
            theirs = F.when(F.col("own").isNotNull(), F.col(f"own.{name}")).otherwise(F.col(name))
            out = out.withColumn(name, theirs)
    kept = (F.col("file_id") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))
    return out.select("doc_id", "file_id", "row", "keep_id", "group_size", kept.alias("kept"), "digest")


def distinct_texts(docs, **options):
    """The documents that stay, with all their columns."""
    rows = located(docs)
    return bloom.without(rows, dedup_rows(rows, **options).where(~F.col("kept")).select("file_id", "row"))
