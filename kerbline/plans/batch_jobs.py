"""The two batch jobs: train and report, and the report set over clustered trips."""

from pyspark.sql import functions as F

from kerbline.operators import clustering, hourly, reports
from kerbline.session import scratch_dir
from kerbline.sources import files


def train_and_report(
    spark,
    trips_path,
    model_path,
    json_path,
    k=20,
    max_iter=5,
    split_key=None,
    cache=False,
    mode="errorifexists",
):
    """Fit on 70 % of a trip CSV, save the model, and assign the other 30 %.

    The split hashes the whole row, or the column ``split_key``. The held-out trips are written once as JSON in time
    order and reported on from there; trips without coordinates have no cluster. ``cache`` keeps the parsed trips between
    the passes. Returns the model and the reports.
    """
    trips = files.csv_scan(spark, trips_path)
    if cache:
        trips = trips.cache()
    split = clustering.hash_split(trips, split_key)
    model = clustering.fit(split.where("in_train"), k=k, max_iter=max_iter)
    clustering.save_model(model, model_path)
    held_out = clustering.nearest(split.where("NOT in_train").drop("in_train"), clustering.centers_of(model))
    files.write_json_sorted(held_out.select("dt", "lat", "lon", "cid", "base"), json_path, mode=mode)
    if cache:
        trips.unpersist()
    return model, report_json(spark, json_path)


def report_set(clustered):
    """All count reports by name, from one scan of the trips.

    The hourly cube is written to the scratch folder first: it is small, every
    report reads it instead of the trips, and a lost executor costs no rescan.
    """
    spark = clustered.sparkSession
    path = scratch_dir(spark, "cube") + "/cube"
    hourly.cube(clustered).write.parquet(path)
    cube = spark.read.parquet(path)
    windows = hourly.windows(cube)
    cells = hourly.month_day_hour_cluster(cube)
    by_hour = hourly.hour_cluster(cube)
    return {
        "month_day_hour_cluster": cells.orderBy("day", "hour", "cid"),
        "month_day_hour_cluster_top": cells.orderBy(F.desc("count"), F.desc("cid")),
        "month_day_cluster": hourly.month_day_cluster(cube).orderBy(F.desc("count")),
        "hour_cluster": by_hour.orderBy(F.desc("count")),
        "hour_cluster_top": by_hour.orderBy(F.desc("count"), "hour", "cid").limit(
            reports.TOP_ROWS
        ),
        "cluster_rows": hourly.cluster_rows(cube),
        "cluster": hourly.cluster(cube).orderBy(F.desc("count")),
        "hour": hourly.hour(cube),
        "windows": windows,
        "window_totals": windows.groupBy("cid").agg(F.sum("count").alias("total_count")),
        "window_listing": windows.orderBy("window_end", "cid").select(
            "cid", F.date_format("window_end", "MMM-dd HH:mm").alias("dt"), "count"
        ),
        "rows": cube.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("count")),
    }


def report_json(spark, path):
    """The report set over clustered trips stored as JSON lines."""
    return report_set(files.json_scan(spark, path))
