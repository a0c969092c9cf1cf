"""Keyed table with upsert semantics over Parquet, as a batch log.

Every write batch holds at most one row per key, sorted by key. The current row of a key is the one with the highest batch
id, and within a batch the one with the highest ``version``. A table has one writer, because batch ids order the writes.

Since a key occurs once per batch, the current view needs only ``max_by(column, batch_id)``: it hash-aggregates with a
map-side part, reads only the columns asked for, and a filter on the key goes down to the Parquet scan.
"""

import json

from pyspark.sql import functions as F

from kerbline.schemas import KV_ROW
from kerbline.sources import batch_log
from kerbline.sources.batch_log import BATCH, OLDER


def one_per_key(batch, keys, version=None, unique=False, unique_version=False):
    """One row per key of a batch: the one with the highest ``version``, or the greatest values.

    ``unique`` states that each key occurs once, as in the output of an aggregation by these keys; the deduplicating
    shuffle is then skipped. ``unique_version`` states that no two rows of a key share a version of fixed width, as with
    message positions: the aggregation then works in place. Otherwise equal versions give the greatest values, so that
    the outcome never depends on row order.
    """
    values = [c for c in batch.columns if c not in keys]
    if unique:
        return batch
    if unique_version:
        return batch.groupBy(*keys).agg(*[F.max_by(c, version).alias(c) for c in values])
    order = ([version] if version else []) + [c for c in values if c != version]
    rows = batch.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_row"))
    return rows.select(*keys, *[F.col("_row")[c].alias(c) for c in values])


def write_batch(batch, path, keys, batch_id, version=None, unique=False, unique_version=False):
    """Upsert ``batch`` under ``batch_id``, reduced by ``one_per_key``."""
    rows = one_per_key(batch, keys, version, unique, unique_version)
    batch_log.append(rows.sortWithinPartitions(*keys), path, batch_id)


def log(spark, path, schema=KV_ROW):
    """Every written row with its numeric batch id."""
    return batch_log.read(spark, path, schema)


def current(rows, keys, columns=None):
    """Current row of every key among rows with their batch id."""
    values = columns or [c for c in rows.columns if c not in (*keys, BATCH)]
    return rows.groupBy(*keys).agg(*[F.max_by(c, BATCH).alias(c) for c in values])


def latest(spark, path, keys=("rowkey",), columns=None, schema=KV_ROW):
    """Current row of every key; without any batch yet, no rows of ``schema``."""
    return current(log(spark, path, schema), keys, columns)


def scan_catalog(spark, path, catalog, read=latest):
    """Current rows under the names and types of a JSON catalog, from any table that ``read`` gives the current rows of.

    The catalog names the row key and maps each logical column to a family, a
    column and a type; columns it leaves out are not read.
    """
    spec = json.loads(catalog)
    key_name = spec["rowkey"]
    wanted = {n: c for n, c in spec["columns"].items() if c["cf"] != "rowkey"}
    stored = [c["col"] for c in wanted.values()]
    if len(set(stored)) != len(stored):
        raise ValueError("catalog maps two columns to one stored column")
    rows = read(spark, path, columns=stored)
    key_names = [n for n, c in spec["columns"].items() if c["cf"] == "rowkey"] or [key_name]
    return rows.select(
        *[F.col("rowkey").alias(n) for n in key_names],
        *[F.col(c["col"]).cast(c["type"]).alias(n) for n, c in wanted.items()],
    )


def copy_current(spark, path, target, keys=("rowkey",)):
    """Write the current rows to a new table, in key order and below all batch ids of a query: the query can go on there, and
    a batch that it replays finds its rows older than itself, as before."""
    rows = latest(spark, path, keys)
    rows.repartitionByRange(*keys).sortWithinPartitions(*keys).write.parquet(f"{target}/{BATCH}={OLDER}")
