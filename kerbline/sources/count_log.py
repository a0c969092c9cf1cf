"""Counts that add up: every micro-batch writes its own, and totals are sums over the log.

No state is kept between batches and no watermark is needed, so no row is ever too late.
"""

from pyspark.sql import functions as F

from kerbline.sources import batch_log
from kerbline.sources.batch_log import BATCH, OLDER


def write(counts, path, batch_id):
    batch_log.append(counts, path, batch_id)


def _sums(rows, counts):
    keys = [c for c in rows.columns if c not in (*counts, BATCH)]
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts])


def totals(spark, path, counts=("count",), schema=None):
    """Sums of the ``counts`` columns over all batches, by all other columns."""
    return _sums(batch_log.read(spark, path, schema), counts)


def copy_totals(spark, path, target, counts=("count",)):
    """Write the log to a new one with two batches: the sums of all batches but the newest, and the newest, which is the
    only one that a restart of the query can replay."""
    rows = batch_log.read(spark, path)
    newest = rows.agg(F.max(BATCH)).first()[0]
    older = _sums(rows.where(F.col(BATCH) < newest), counts).withColumn(BATCH, F.lit(OLDER).cast("bigint"))
    older.unionByName(rows.where(F.col(BATCH) == newest)).write.partitionBy(BATCH).parquet(target)
