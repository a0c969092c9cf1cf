"""Message topics: one STRING column ``value`` in, one out.

``kind="kafka"`` uses the Kafka source and sink and needs the public connector on
the classpath. ``kind="file"`` keeps a topic as a folder of text files, one
message per line, so the same jobs run without a broker; messages must then hold
no line break. A file topic should have a single writer, since a folder written
by a streaming sink is read through that sink's commit log.
"""

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.sources import batch_log

POSITION = "position"
EARLIEST = {"startingOffsets": "earliest"}


def _names(topics):
    return [t.strip() for t in topics.split(",") if t.strip()]


def _value(df, position=None):
    columns = [F.col("value").cast("string").alias("value")]
    if position is not None:
        columns.append(position.cast("decimal(28,0)").alias(POSITION))
    return df.select(*columns).where("value IS NOT NULL")


def _place(time, number):
    """One number that orders by time, then by a number below 2^40."""
    return F.unix_micros(time).cast("decimal(16,0)") * F.lit(1 << 40).cast("decimal(13,0)") + number


def _kafka(df, position):
    return _value(df, _place(F.col("timestamp"), F.col("offset") % (1 << 40)) if position else None)


def _files(df, position):
    meta = "_metadata"
    place = _place(F.col(f"{meta}.file_modification_time"), F.col(f"{meta}.file_block_start")) if position else None
    return _value(df, place)


def numbered(batch):
    """A micro-batch with its messages' positions made unique: rows from one place follow each other in one partition."""
    row = F.monotonically_increasing_id() % (1 << 33)
    return batch.withColumn(POSITION, (F.col(POSITION) * F.lit(1 << 33).cast("decimal(10,0)") + row).cast("decimal(38,0)"))


def let_go(archive=None, files_per_batch=None, max_age=None):
    """Options for ``subscribe`` to a file topic that is not kept for ever.

    ``archive``: a folder outside the topic where files move once a later batch has begun, so that listing the topic stays
    short; a consumer of its own is needed, since others no longer find them. ``files_per_batch`` cuts the input into
    batches, also when it is drained. ``max_age``: files older than the newest by more than this, such as ``7d``, are
    passed over.
    """
    options = {"cleanSource": "archive", "sourceArchiveDir": archive} if archive else {}
    return options | {
        name: str(value) for name, value in (("maxFilesPerTrigger", files_per_batch), ("maxFileAge", max_age)) if value
    }


def subscribe(spark, topics, kind="file", position=False, **options):
    """Stream the values of a comma-separated topic list from the earliest message.

    ``position`` adds a number that does not fall from one message to the next: time and offset in a broker, time of the
    file and place in it otherwise. ``numbered`` makes it unique inside a micro-batch.
    """
    if kind == "kafka":
        reader = spark.readStream.format("kafka").options(**{**EARLIEST, **options})
        return _kafka(reader.option("subscribe", topics).load(), position)
    streams = [
        _files(spark.readStream.options(lineSep="\n", **options).text(name), position) for name in _names(topics)
    ]
    return functools.reduce(DataFrame.unionAll, streams)


def read(spark, topics, kind="file", position=False, **options):
    """All messages present now, as a batch."""
    if kind == "kafka":
        reader = spark.read.format("kafka").options(**{**EARLIEST, **options})
        return _kafka(reader.option("subscribe", topics).load(), position)
    return _files(spark.read.options(lineSep="\n", **options).text(_names(topics)), position)


def publish_batch(messages, topic, batch_id, kind="file", **options):
    """Publish one micro-batch; in a file topic it owns the folder ``batch_id=N``.

    A replayed batch holds the same messages, so a folder that is complete stays: a consumer that has read its files
    meets no copies of them.
    """
    if kind == "kafka":
        return publish(messages, topic, kind, **options)
    spark, folder = messages.sparkSession, f"{topic}/batch_id={batch_id}"
    if not batch_log.exists(spark, f"{folder}/_SUCCESS"):
        messages.select("value").write.mode("overwrite").text(folder, lineSep="\n")


def publish(messages, topic, kind="file", **options):
    """Append the ``value`` column of a batch to a topic."""
    writer = messages.select("value").write.mode("append")
    if kind == "kafka":
        writer.format("kafka").options(**options).option("topic", topic).save()
    else:
        writer.options(**options).text(topic, lineSep="\n")


def publish_stream(messages, topic, checkpoint, kind="file", **options):
    """Stream writer that appends ``value`` to a topic; exactly once for files."""
    writer = (
        messages.select("value")
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .options(**options)
    )
    if kind == "kafka":
        return writer.format("kafka").option("topic", topic)
    return writer.format("text").option("path", topic).option("lineSep", "\n")
