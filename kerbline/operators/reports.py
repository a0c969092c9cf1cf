"""Pickup counts by time and cluster.

Inputs have ``dt`` and ``cid``. ``count`` counts rows with a cluster id, except
where the row count is asked for.
"""

from pyspark.sql import functions as F

TOP_ROWS = 20


def _time_parts(df, *parts):
    build = {"month": F.month, "day": F.dayofmonth, "hour": F.hour}
    return df.select(*[build[p]("dt").alias(p) for p in parts], "cid")


def count_month_day_hour_cluster(df):
    return (
        _time_parts(df, "month", "day", "hour")
        .groupBy("month", "day", "hour", "cid")
        .agg(F.count("cid").alias("count"))
        .orderBy("day", "hour", "cid")
    )


def busiest_month_day_hour_cluster(df):
    return (
        _time_parts(df, "month", "day", "hour")
        .groupBy("month", "day", "hour", "cid")
        .agg(F.count("cid").alias("count"))
        .orderBy(F.desc("count"), F.desc("cid"))
    )


def count_month_day_cluster(df):
    return (
        _time_parts(df, "month", "day")
        .groupBy("month", "day", "cid")
        .agg(F.count("cid").alias("count"))
        .orderBy(F.desc("count"))
    )


def _hour_cluster(df):
    return _time_parts(df, "hour").groupBy("hour", "cid").agg(F.count("cid").alias("count"))


def count_hour_cluster(df):
    """Busiest hour and place first."""
    return _hour_cluster(df).orderBy(F.desc("count"))


def count_hour_cluster_by_key(df):
    return _hour_cluster(df).orderBy("hour", "cid")


def top_hour_cluster(df, rows=TOP_ROWS):
    """The busiest cells; equal counts rank by hour, then cluster."""
    return _hour_cluster(df).orderBy(F.desc("count"), "hour", "cid").limit(rows)


def count_cluster(df):
    """Rows per cluster, the null cluster included."""
    return df.groupBy("cid").count()


def sql_count_cluster(df):
    return df.sparkSession.sql(
        "SELECT cid, count(cid) AS count FROM {trips} GROUP BY cid ORDER BY count DESC",
        trips=df,
    )


def sql_count_hour(df):
    return df.sparkSession.sql(
        "SELECT hour(dt) AS hr, count(cid) AS ct FROM {trips} GROUP BY hour(dt)", trips=df
    )


def window_count(df, width="1 hour"):
    """Rows per cluster and tumbling window; rows without a time are dropped."""
    return df.groupBy("cid", F.window("dt", width)).count()


def flat_window(counts):
    """Window bounds as plain columns."""
    return counts.select(
        "cid",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "count",
    )


def rollup_windows(counts):
    """Total per cluster from window counts."""
    return counts.sparkSession.sql(
        "SELECT cid, sum(count) AS total_count FROM {trip_counts} GROUP BY cid",
        trip_counts=counts,
    )


def window_listing(counts):
    """Window counts with a short end time, in time order."""
    return counts.orderBy("window.end", "cid").select(
        "cid", F.date_format("window.end", "MMM-dd HH:mm").alias("dt"), "count"
    )


def row_count(df):
    return df.agg(F.count(F.lit(1)).alias("count"))


def pivot_hour_cluster(df, clusters):
    """Hours down, clusters across, pickups in the cells; columns ``c0``, ``c1`` and so on."""
    cells = _hour_cluster(df).withColumn("cluster", F.concat(F.lit("c"), F.col("cid")))
    names = [f"c{c}" for c in clusters]
    return cells.groupBy("hour").pivot("cluster", names).agg(F.sum("count")).orderBy("hour")


def first_rows(df, n, *order):
    """The first n rows in a total order."""
    return df.orderBy(*order).limit(n)


def register(df, name):
    """Make ``df`` queryable by name."""
    df.createOrReplaceTempView(name)
    return df
