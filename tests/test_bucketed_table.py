"""The bucketed keyed table: upserts, replay, other sessions, and plans without a shuffle."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kerbline.functions import text
from kerbline.plans import queries
from kerbline.schemas import TRIP_CATALOG
from kerbline.sources import bucketed_table as bt

ROW = "rowkey string, lat double, lon double, version decimal(38,0)"


def _rows(spark, *rows):
    return spark.createDataFrame(rows, ROW)


def _current(spark, path):
    return sorted(((r["rowkey"], r["lat"]) for r in bt.latest(spark, path, columns=["lat"]).collect()), key=repr)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _put(spark, path, batch_id, *rows):
    made = [(key, lat, 0.0, Decimal(version)) for key, lat, version in rows]
    bt.write_batch(_rows(spark, *made), path, ("rowkey",), batch_id, "version")


def test_upsert_replay_and_ties(spark, tmp_path):
    path = str(tmp_path / "kv")
    _put(spark, path, 0, ("a", 1.0, 1), ("a", 2.0, 3), ("a", 9.0, 2), ("b", 1.0, 1), ("b", 5.0, 1))
    assert _current(spark, path) == [("a", 2.0), ("b", 5.0)]
    _put(spark, path, 1, ("b", 7.0, 0), ("c", 7.0, 0))
    assert _current(spark, path) == [("a", 2.0), ("b", 7.0), ("c", 7.0)]
    _put(spark, path, 0, ("a", 4.0, 1), ("b", 4.0, 1))
    assert _current(spark, path) == [("a", 4.0), ("b", 7.0), ("c", 7.0)]
    _put(spark, path, 10, (None, 3.0, 1), ("a", None, 1))
    assert _current(spark, path) == [("a", None), ("b", 7.0), ("c", 7.0), (None, 3.0)]


def test_another_session_finds_the_batches(spark, tmp_path):
    path = str(tmp_path / "kv")
    _put(spark, path, 0, ("a", 1.0, 1))
    name = bt.declare(spark, path)
    spark.sql(f"DROP TABLE {name}")
    assert _current(spark, path) == [("a", 1.0)]
    _put(spark, path, 1, ("a", 2.0, 1))
    assert _current(spark, path) == [("a", 2.0)]


def test_a_table_without_batches_is_empty(spark, tmp_path):
    rows = bt.latest(spark, str(tmp_path / "none"))
    assert rows.count() == 0 and rows.columns == ["rowkey", "lat", "lon", "version"]


@pytest.fixture(scope="module")
def trips(spark, sf_dir):
    return queries._kv_table(spark, sf_dir)


def test_reads_of_the_current_rows_do_not_shuffle(spark, trips):
    scans = [
        bt.latest(spark, trips),
        bt.latest(spark, trips, columns=["lat"]).where(text.key_of_cluster("rowkey", 2)),
        bt.scan_catalog(spark, trips, TRIP_CATALOG).where(text.key_at_most("key", "11")),
    ]
    for rows in scans:
        assert rows.count() > 0
        assert "Exchange" not in _plan(rows)
    assert "StringStartsWith(rowkey,2_)" in _plan(scans[1])
    assert "LessThanOrEqual(rowkey,11)" in _plan(scans[2])


def test_a_key_is_read_from_its_bucket(spark, trips):
    key = bt.latest(spark, trips).select(F.max("rowkey")).first()[0]
    rows = bt.row_of(spark, trips, key)
    assert [r["rowkey"] for r in rows.collect()] == [key]
    assert f"SelectedBucketsCount: 1 out of {bt.BUCKETS}" in _plan(rows)


def test_each_batch_has_a_file_a_bucket_at_most(spark, trips):
    files = spark.table(bt.declare(spark, trips)).select("batch_id", F.input_file_name().alias("file")).distinct()
    assert files.groupBy("batch_id").count().agg(F.max("count")).first()[0] <= bt.BUCKETS
