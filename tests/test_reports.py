import datetime as dt

import pytest
from pyspark.sql import functions as F

from kerbline.operators import reports
from kerbline.plans import batch_jobs, queries
from kerbline.sources import files


@pytest.fixture(scope="module")
def clustered(spark, sf_dir):
    return queries.clustered(spark, sf_dir).select("dt", "cid").cache()


@pytest.fixture(scope="module")
def edge(spark):
    rows = [
        (dt.datetime(2014, 8, 1, 0, 5), 1),
        (dt.datetime(2014, 8, 1, 0, 59, 59), None),
        (None, None),
        (None, 2),
    ]
    return spark.createDataFrame(rows, "dt timestamp_ntz, cid int")


def _keys(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


def test_sort_orders(clustered):
    got = _keys(reports.count_month_day_hour_cluster(clustered), "day", "hour", "cid")
    assert got == sorted(got)
    got = _keys(reports.busiest_month_day_hour_cluster(clustered), "count", "cid")
    assert got == sorted(got, reverse=True)
    for build in (
        reports.count_month_day_cluster,
        reports.count_hour_cluster,
        reports.sql_count_cluster,
    ):
        got = _keys(build(clustered), "count")
        assert got == sorted(got, reverse=True)
    got = _keys(reports.count_hour_cluster_by_key(clustered), "hour", "cid")
    assert got == sorted(got)


def test_totals_agree(clustered):
    n = clustered.count()
    assert reports.row_count(clustered).first()["count"] == n
    for df, name in (
        (reports.count_cluster(clustered), "count"),
        (reports.sql_count_hour(clustered), "ct"),
        (reports.count_hour_cluster(clustered), "count"),
        (reports.window_count(clustered), "count"),
    ):
        assert df.agg(F.sum(name)).first()[0] == n


def test_null_cluster_and_null_time(edge):
    assert dict(_keys(reports.count_cluster(edge), "cid", "count")) == {1: 1, 2: 1, None: 2}
    assert dict(_keys(reports.sql_count_cluster(edge), "cid", "count")) == {1: 1, 2: 1, None: 0}
    assert dict(_keys(reports.sql_count_hour(edge), "hr", "ct")) == {0: 1, None: 1}
    windows = reports.flat_window(reports.window_count(edge))
    start, end = dt.datetime(2014, 8, 1), dt.datetime(2014, 8, 1, 1)
    assert set(_keys(windows, "cid", "window_start", "window_end", "count")) == {
        (1, start, end, 1),
        (None, start, end, 1),
    }


def test_report_set_equals_the_single_reports(clustered, edge):
    for df in (clustered, edge):
        made = batch_jobs.report_set(df)
        pairs = [
            (made["month_day_hour_cluster"], reports.count_month_day_hour_cluster(df)),
            (made["month_day_cluster"], reports.count_month_day_cluster(df)),
            (made["hour_cluster"], reports.count_hour_cluster(df)),
            (made["hour_cluster_top"], reports.top_hour_cluster(df)),
            (made["cluster_rows"], reports.count_cluster(df)),
            (made["cluster"], reports.sql_count_cluster(df)),
            (made["hour"], reports.sql_count_hour(df)),
            (
                made["windows"].select("cid", "window_start", "window_end", "count"),
                reports.flat_window(reports.window_count(df)),
            ),
            (made["window_totals"], reports.rollup_windows(reports.window_count(df))),
            (made["window_listing"], reports.window_listing(reports.window_count(df))),
            (made["rows"], reports.row_count(df)),
        ]
        for ours, single in pairs:
            assert ours.columns == single.columns
            assert ours.exceptAll(single).isEmpty() and single.exceptAll(ours).isEmpty()


def test_register_makes_a_view(spark, clustered):
    reports.register(clustered, "trips_view")
    assert spark.sql("SELECT count(*) FROM trips_view").first()[0] == clustered.count()


def test_train_and_report(spark, sf_dir, tmp_path):
    source = queries.trips(spark, sf_dir).select("dt", "lat", "lon", "base")
    files.write_csv(source, str(tmp_path / "csv"))
    model, made = batch_jobs.train_and_report(
        spark, str(tmp_path / "csv"), str(tmp_path / "model"), str(tmp_path / "json"), cache=True
    )
    assert len(model.clusterCenters()) == 20
    held_out = made["rows"].first()["count"]
    assert 0 < held_out < source.count()
    again = batch_jobs.report_json(spark, str(tmp_path / "json"))
    assert again["rows"].first()["count"] == held_out
    assert again["hour_cluster"].exceptAll(made["hour_cluster"]).isEmpty()
    with pytest.raises(Exception, match="(?i)exists"):
        batch_jobs.train_and_report(
            spark, str(tmp_path / "csv"), str(tmp_path / "model"), str(tmp_path / "json")
        )
