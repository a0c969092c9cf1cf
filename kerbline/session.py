"""Session defaults and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def get_spark(app_name="kerbline", **conf):
    """Return a session with the settings the jobs expect; ``conf`` overrides them.

    Master, memory and shuffle parallelism come from spark-submit.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark, label):
    """Return a fresh path for intermediate tables.

    It lies in the shared folder named by ``spark.checkpoint.dir``. Without that
    setting only a local master may fall back to a temporary folder, because
    executors on other machines could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/kerbline-{label}-{uuid.uuid4().hex}"
    if spark.conf.get("spark.master", "local").startswith("local"):
        return tempfile.mkdtemp(prefix=f"kerbline-{label}-")
    raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
