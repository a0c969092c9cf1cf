"""Pickups per day, hour and cluster in one pass; every count report follows from it."""

from pyspark.sql import functions as F


def cube(df, *extra):
    """Row and cluster counts at (date, hour, cid) grain.

    The result has at most hours x clusters rows however large the input is, so a
    set of reports costs a single scan.
    """
    return (
        df.select(*extra, F.to_date("dt").alias("date"), F.hour("dt").alias("hour"), "cid")
        .groupBy(*extra, "date", "hour", "cid")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count("cid").alias("n_cid"))
    )


def _sum(name, alias):
    return F.sum(name).alias(alias)


def month_day_hour_cluster(c):
    return c.groupBy(
        F.month("date").alias("month"), F.dayofmonth("date").alias("day"), "hour", "cid"
    ).agg(_sum("n_cid", "count"))


def month_day_cluster(c):
    return c.groupBy(F.month("date").alias("month"), F.dayofmonth("date").alias("day"), "cid").agg(
        _sum("n_cid", "count")
    )


def hour_cluster(c):
    return c.groupBy("hour", "cid").agg(_sum("n_cid", "count"))


def cluster_rows(c, *extra):
    return c.groupBy(*extra, "cid").agg(_sum("n_rows", "count"))


def cluster(c, *extra):
    return c.groupBy(*extra, "cid").agg(_sum("n_cid", "count"))


def hour(c, *extra):
    return c.groupBy(*extra, F.col("hour").alias("hr")).agg(_sum("n_cid", "ct"))


def windows(c, *extra):
    """One-hour windows; rows without a time belong to none."""
    start = F.col("date").cast("timestamp_ntz") + F.make_dt_interval(hours="hour")
    return (
        c.where("date IS NOT NULL")
        .select(*extra, "cid", start.alias("window_start"), F.col("n_rows").alias("count"))
        .withColumn("window_end", F.expr("window_start + INTERVAL 1 HOUR"))
    )
