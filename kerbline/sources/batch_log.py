"""A log of micro-batches: one Parquet partition for each, ``path/batch_id=N``. A replayed batch replaces its own.

Batch ids come from one streaming query and order what it wrote, so a log has one writer.
"""

from pyspark.sql import functions as F

BATCH = "batch_id"
#: Batch id of what a copy of a log starts with; it comes before all batches of a query.
OLDER = -1


def exists(spark, path):
    """Whether there is a file or folder, in any file system that Spark knows."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def append(df, path, batch_id):
    """Write one batch; the same batch id replaces what it wrote before."""
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def read(spark, path, schema=None):
    """All rows with their batch id. ``schema`` is for a log without batches."""
    if exists(spark, path):
        return spark.read.parquet(path).withColumn(BATCH, F.col(BATCH).cast("bigint"))
    if schema is None:
        raise FileNotFoundError(f"no batch in {path}, and no schema to make an empty one from")
    return spark.createDataFrame([], schema).withColumn(BATCH, F.lit(None).cast("bigint"))
