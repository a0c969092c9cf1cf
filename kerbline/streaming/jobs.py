"""The streaming jobs. Each returns a writer for ``run.start`` or ``run.drain``."""

from pyspark.sql import functions as F

from kerbline.functions import codec, text
from kerbline.operators import clustering, hourly, reports
from kerbline.operators.ordering import order_spread
from kerbline.schemas import TRIP, TRIP_ENRICHED
from kerbline.sources import batch_log, count_log, keyed_table, topics
from kerbline.streaming.run import fan_out, per_batch

ITEM_COUNT = 10
#: An enriched message without its time or cluster counts in no report and has no row key.
REQUIRED = ("dt", "cid")
CUBE_COUNTS = ("n_rows", "n_cid")
GOOD, REJECTED = "good", "rejected"


def rejected(target):
    """Where messages go that do not decode, unless a job is told another place."""
    return f"{target.rstrip('/')}-rejected"


def _dead_letters(topic, kind="file", **options):
    def handle(batch, batch_id):
        bad = codec.dead_letters(batch)
        if not bad.isEmpty():
            topics.publish_batch(bad, topic, batch_id, kind, **options)

    return handle


def _on_good(handler):
    return lambda batch, batch_id: handler(codec.good(batch), batch_id)


def observed(decoded):
    """Decoded messages that count themselves: good and rejected ones of every batch are in the query's progress."""
    corrupt = F.col(codec.CORRUPT)
    return decoded.observe("messages", F.count_if(corrupt.isNull()).alias(GOOD), F.count(corrupt).alias(REJECTED))


def count_messages(decoded, checkpoint):
    """Only the counts of decoded messages; nothing is written but the positions."""
    return observed(decoded).writeStream.format("noop").option("checkpointLocation", checkpoint)


def with_dead_letters(decoded, handlers, dead, checkpoint, kind="file", **options):
    """One read of decoded messages: good rows to the handlers, the raw text of the others to the topic ``dead``.

    The numbers of good and rejected messages are observed on the way, for ``totals``.
    """
    decoded = observed(decoded)
    outputs = [_on_good(h) for h in handlers] + [_dead_letters(dead, kind, **options)]
    return fan_out(decoded, outputs, checkpoint)


def decoded_lines(messages, strict=False):
    return codec.decode_csv(messages, strict=strict)


def decoded_enriched(messages, strict=False):
    """Enriched messages with ``_corrupt``, and the message position if the topic was read with it."""
    return codec.decode_json(messages, TRIP_ENRICHED, strict=strict, required=REQUIRED)


def decode_enriched(messages):
    return codec.good(decoded_enriched(messages))


def enrich_messages(trips, centers):
    return codec.encode_enriched(clustering.enrich(trips, centers))


def _publish_enriched(centers, topic, in_order, kind, **options):
    def handle(trips, batch_id):
        trips = trips.select(*TRIP.names)
        rows = clustering.enrich(trips, centers)
        wire = codec.encode_enriched(order_spread(rows, "dt") if in_order else rows)
        topics.publish_batch(wire, topic, batch_id, kind, **options)

    return handle


def enrich(messages, centers, topic, checkpoint, kind="file", dead=None, in_order=False, strict=False, **options):
    """Decode, assign, join the centre, encode and publish, in one read; lines that do not decode go to ``dead``.

    ``in_order`` publishes each batch in time order. In a file topic a batch owns the folder ``batch_id=N``, so a replay
    adds nothing.
    """
    handler = _publish_enriched(centers, topic, in_order, kind, **options)
    lines = decoded_lines(messages, strict)
    return with_dead_letters(lines, [handler], dead or rejected(topic), checkpoint, kind, **options)


def enrich_sorted(messages, centers, topic, checkpoint, kind="file", **options):
    """``enrich`` with each batch published in time order."""
    return enrich(messages, centers, topic, checkpoint, kind, in_order=True, **options)


def reject_lines(messages, topic, checkpoint, kind="file", **options):
    """Publish only the trip lines that do not decode."""
    bad = codec.dead_letters(codec.decode_csv(messages))
    return topics.publish_stream(bad, topic, checkpoint, kind, **options)


def write_batch_counts(path):
    """Handler: the batch's own counts, as a cube tagged with its batch id."""

    def handle(batch, batch_id):
        count_log.write(hourly.cube(batch), path, batch_id)

    return handle


def batch_counts(trips, path, checkpoint):
    """Counts of every micro-batch by itself; the totals over all batches are their sums."""
    return per_batch(trips.select("dt", "cid"), write_batch_counts(path), checkpoint)


def batch_report(spark, path, report):
    """A batch-local report: ``cluster``, ``hour`` or ``windows``, per batch_id."""
    build = {"cluster": hourly.cluster, "hour": hourly.hour, "windows": hourly.windows}[report]
    return build(batch_log.read(spark, path), "batch_id")


def window_totals(spark, path):
    """Running one-hour counts per cluster over all batches: no state, no watermark, no row left out."""
    windows = hourly.windows(count_log.totals(spark, path, CUBE_COUNTS))
    return windows.groupBy("cid", "window_start", "window_end").agg(F.sum("count").alias("count"))


def windows_with_watermark(trips, watermark):
    """Running one-hour counts in state that a watermark bounds: rows later than it are dropped.

    Spark counts them as ``numRowsDroppedByWatermark`` in the progress of the query (``totals``), after it has added up the
    rows of a batch that share a partition, a cluster and a window. A watermark needs TIMESTAMP, so wall-clock times are placed on the UTC line and taken back from it, whatever the session time
    zone.
    """
    since_epoch = "CAST(dt - TIMESTAMP_NTZ '1970-01-01 00:00:00' AS INTERVAL SECOND)"
    on_utc = F.expr(f"timestamp_seconds(CAST({since_epoch} AS DECIMAL(18, 6)))")
    timed = trips.select(on_utc.alias("dt"), "cid").withWatermark("dt", watermark)
    counts = reports.flat_window(reports.window_count(timed))

    def wall_clock(name):
        since = F.make_dt_interval(secs=F.unix_seconds(name))
        return (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since).alias(name)

    return counts.select("cid", wall_clock("window_start"), wall_clock("window_end"), "count")


def append_windows(trips, watermark, path, checkpoint):
    """Windows that the watermark has closed, each written once to a folder of Parquet files: append mode, exactly once."""
    counts = windows_with_watermark(trips, watermark)
    writer = counts.writeStream.outputMode("append").format("parquet").option("path", path)
    return writer.option("checkpointLocation", checkpoint)


def word_counts(lines, column="value"):
    """Words with their counts."""
    return (
        lines.select(F.explode(text.words(column)).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def batch_word_counts(lines, path, checkpoint):
    """Each batch's own word counts; ``word_totals`` adds them up."""

    def handle(batch, batch_id):
        count_log.write(word_counts(batch), path, batch_id)

    return per_batch(lines, handle, checkpoint)


def word_totals(spark, path):
    return count_log.totals(spark, path)


def running_word_counts(lines, path, checkpoint, column="value"):
    """Word counts in state: every batch upserts the new totals of its words, by word."""
    return keep_totals(word_counts(lines, column), ("word",), path, checkpoint)


def keep_totals(counts, keys, path, checkpoint):
    """Keep stateful counts in a keyed table: only changed rows are written per batch."""

    def write(batch, batch_id):
        keyed_table.write_batch(batch, path, keys, batch_id, unique=True)

    return per_batch(counts, write, checkpoint, mode="update", skip_empty=False)


def puts(trips, version):
    """Enriched trips as rows of the keyed table: rowkey, lat, lon and the version."""
    return trips.select(
        text.rowkey("cid", "base", "dt").alias("rowkey"),
        "lat",
        "lon",
        F.col(version).cast("decimal(38,0)").alias("version"),
    )


def write_puts(path, version=topics.POSITION, unique_version=None, table=keyed_table):
    """Handler: upsert the batch into a ``keyed_table`` or ``bucketed_table``; positions of messages are unique, other
    versions are taken as not unique."""
    unique = version == topics.POSITION if unique_version is None else unique_version

    def handle(batch, batch_id):
        rows = puts(topics.numbered(batch) if version == topics.POSITION else batch, version)
        table.write_batch(
            rows, path, ("rowkey",), batch_id, "version", unique_version=unique
        )

    return handle


def upsert(trips, path, checkpoint, version=topics.POSITION):
    """Upsert enriched trips into the keyed table, the latest ``version`` of a key winning: by default the last message."""
    return per_batch(trips, write_puts(path, version), checkpoint)


def upsert_and_count(trips, table_path, counts_path, checkpoint, version=topics.POSITION):
    """Keyed-table upsert and per-batch counts from one read of the stream."""
    handlers = [write_puts(table_path, version), write_batch_counts(counts_path)]
    return fan_out(trips, handlers, checkpoint)


def replay(spark, folder, topic, checkpoint, files_per_batch=None, kind="file", **options):
    """Feed text files line by line into a topic; the trigger sets the pace."""
    source = spark.readStream
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    return topics.publish_stream(source.text(folder), topic, checkpoint, kind, **options)


def tail(messages, checkpoint, rows=20):
    """Print the values of a topic as they arrive."""
    return (
        messages.writeStream.format("console")
        .option("truncate", False)
        .option("numRows", rows)
        .option("checkpointLocation", checkpoint)
    )


def constant_items(spark, count=ITEM_COUNT, per_batch_rows=None):
    """The items (i, i) for i below ``count``, again in every micro-batch."""
    ticks = (
        spark.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", per_batch_rows or count)
        .load()
    )
    number = (F.col("value") % count).cast("int")
    return ticks.select(number.alias("id"), number.alias("value"))


def publish_items(items, topic, checkpoint, kind="file", **options):
    return topics.publish_stream(codec.encode_items(items), topic, checkpoint, kind, **options)
