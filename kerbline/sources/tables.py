"""The given Parquet tables, and the view of ``events`` as trips."""


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark, sf_dir, name):
    """The same table as a stream.

    The bracket makes the path a glob, which the file stream source accepts for
    a single file as well as for a folder of part files.
    """
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/[{name[0]}]{name[1:]}.parquet")


def trips(events):
    """``events`` as pickups: event_id, dt, lat, lon, base."""
    return events.selectExpr(
        "event_id",
        "ts AS dt",
        "40.5D + ((event_id * 7919) % 5000) / 10000D AS lat",
        "-74.2D + ((event_id * 104729) % 6000) / 10000D AS lon",
        "event_type AS base",
    )
