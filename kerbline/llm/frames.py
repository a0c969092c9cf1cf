"""Small DataFrame helpers that the operators share."""

import uuid

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbline.session import scratch_dir

BATCH_ROWS = 1000


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df, label):
    """Write ``df`` to the shared scratch folder and read it back: later steps start from the files."""
    path = scratch_dir(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def held(df):
    """``df`` kept on the executors' disks for a few reads inside one operator, which unpersists it; what a lost executor
    held is computed again. No files are made in the shared folder."""
    return df.persist(StorageLevel.DISK_ONLY)


def fresh(df, *labels):
    """Names for helper columns that no column of ``df`` has."""
    taken = {name.lower() for name in df.columns}
    names = []
    for label in labels:
        name = f"_{label}"
        while name.lower() in taken:
            name = f"_{label}_{uuid.uuid4().hex[:6]}"
        taken.add(name.lower())
        names.append(name)
    return names


def as_text(column):
    """The text column as bytes; null counts as empty."""
    return F.coalesce(column.cast("binary"), F.lit(b""))


def mapped(df, run, schema):
    """``df.mapInArrow`` in batches of at most ``BATCH_ROWS`` rows: a batch of long texts is held several times over.

    Lowers the session's batch size, which Spark reads when the query starts.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(key)) <= BATCH_ROWS:
        df.sparkSession.conf.set(key, str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def schema_with(df, **added):
    """Schema of ``df`` with further columns, for mapInArrow."""
    out = T.StructType(list(df.schema.fields))
    for name, kind in added.items():
        out = out.add(name, kind)
    return out


def located(df):
    """(doc, file, row): each row of ``df`` as a struct, and its place in Parquet files, a stable identifier and locator.

    Rows that do not come straight from files are written to the shared scratch folder first, so call it once and pass
    its result on: a second call would write other files.
    """
    doc = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("doc")
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    if "_metadata#" in df._jdf.queryExecution().analyzed().metadataOutput().mkString(","):
        try:
            return df.select(doc, *place)
        except AnalysisException:  # not a plain selection of file rows
            pass
    return written(df, "rows").select(doc, *place)
