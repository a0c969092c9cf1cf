"""Keyed table laid out for reading: Parquet, bucketed and sorted by the row key, one partition per write batch.

All rows of a key, whatever batch wrote them, lie in the buckets of one number. So the current view, ``max_by(column,
batch_id)`` by key, needs no shuffle; a read of one key opens one bucket of each batch; and range and prefix filters on the
key reach sorted files, whose statistics let most of them be skipped.

The table is declared in the session's catalog under a name made from its path, so any session that has the path can read
and write it. A batch id written again replaces that batch only.
"""

import hashlib

from pyspark.sql import functions as F

from kerbline.schemas import KV_ROW
from kerbline.sources import batch_log, keyed_table
from kerbline.sources.batch_log import BATCH

#: Fixed for the life of a table: every session has to declare it with the same number.
BUCKETS = 8


def declare(spark, path, schema=KV_ROW, keys=("rowkey",), buckets=BUCKETS):
    """Name of the table at ``path``; declares it once per session, with the batches that are there already."""
    name = "kerbline_" + hashlib.md5(path.encode()).hexdigest()
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name != BATCH)
        by = ", ".join(f"`{k}`" for k in keys)
        spark.sql(
            f"CREATE TABLE {name} ({columns}, {BATCH} BIGINT) USING parquet PARTITIONED BY ({BATCH}) "
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        if batch_log.exists(spark, path):
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return name


def write_batch(
    batch, path, keys, batch_id, version=None, unique=False, unique_version=False, buckets=BUCKETS
):
    """Upsert ``batch`` under ``batch_id``; see ``keyed_table.write_batch``.

    Rows of a key are reduced to one before they are dealt to the buckets, so a hot key costs one row there, and each
    bucket is written as one sorted file.
    """
    spark = batch.sparkSession
    rows = keyed_table.one_per_key(batch, keys, version, unique, unique_version)
    name = declare(spark, path, rows.schema, keys, buckets)
    columns = ", ".join(f"`{c}`" for c in spark.table(name).columns if c != BATCH)
    spark.sql(
        f"INSERT OVERWRITE TABLE {name} PARTITION ({BATCH} = {int(batch_id)}) SELECT {columns} FROM {{rows}}",
        rows=rows.repartition(buckets, *keys),
    )


def latest(spark, path, keys=("rowkey",), columns=None, schema=KV_ROW, buckets=BUCKETS):
    """Current row of every key, without a shuffle."""
    return keyed_table.current(spark.table(declare(spark, path, schema, keys, buckets)), keys, columns)


def row_of(spark, path, value, key="rowkey", **options):
    """Current row of one key; only its bucket is read."""
    return latest(spark, path, (key,), **options).where(F.col(key) == F.lit(value))


def scan_catalog(spark, path, catalog):
    """Current rows under the names and types of a JSON catalog; see ``keyed_table.scan_catalog``."""
    return keyed_table.scan_catalog(spark, path, catalog, latest)
