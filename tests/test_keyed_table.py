import datetime as dt

import pytest
from pyspark.sql import functions as F

from kerbline.functions import text
from kerbline.schemas import TRIP_CATALOG
from kerbline.sources import keyed_table
from kerbline.streaming import jobs

WHEN = dt.datetime(2014, 8, 1)
TRIPS = "event_id long, cid int, base string, dt timestamp_ntz, lat double, lon double"


def _put(spark, path, batch_id, *rows):
    df = spark.createDataFrame([(i, c, b, WHEN, lat, lon) for i, c, b, lat, lon in rows], TRIPS)
    jobs.write_puts(path, "event_id")(df, batch_id)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_latest_row_wins_and_coordinates_are_not_swapped(spark, tmp_path):
    path = str(tmp_path / "t")
    _put(spark, path, 0, (1, 2, "B", 40.7, -73.9), (3, 2, "B", 40.8, -73.8), (2, 2, "B", 1.0, 1.0))
    key = "2_B_2014-08-01 00:00:00"
    assert _rows(keyed_table.latest(spark, path)) == [(key, 40.8, -73.8, 3)]
    _put(spark, path, 1, (1, 2, "B", 40.1, -73.1))
    assert _rows(keyed_table.latest(spark, path)) == [(key, 40.1, -73.1, 1)]


def test_replay_of_a_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch_id in (0, 1, 1, 0):
        _put(spark, path, batch_id, (1, batch_id, "B", 40.7, -73.9), (2, 5, "C", float(batch_id), 0.0))
    assert keyed_table.log(spark, path).count() == 4
    got = {r["rowkey"][0]: r["lat"] for r in keyed_table.latest(spark, path).collect()}
    assert got == {"0": 40.7, "1": 40.7, "5": 1.0}


def test_equal_versions_resolve_the_same_way_in_any_order(spark, tmp_path):
    rows = [(1, 2, "B", lat, -73.9) for lat in (40.1, 40.9, 40.5)]
    for i, order in enumerate((rows, rows[::-1])):
        path = str(tmp_path / f"t{i}")
        _put(spark, path, 0, *order)
        assert keyed_table.latest(spark, path).first()["lat"] == 40.9


def test_a_null_value_overwrites(spark, tmp_path):
    path = str(tmp_path / "t")
    _put(spark, path, 0, (1, 2, "B", 40.7, -73.9))
    _put(spark, path, 1, (2, 2, "B", None, -73.9))
    assert keyed_table.latest(spark, path).first()["lat"] is None


def test_catalog_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    _put(spark, path, 0, *[(i, i, "B", 40.0 + i, -73.9) for i in (0, 1, 2, 10, 11, 19)])
    table = keyed_table.scan_catalog(spark, path, TRIP_CATALOG)
    assert table.columns == ["key", "lat", "lon"]
    low = table.where(text.key_at_most("key", "11"))
    assert sorted(r["lat"] for r in low.collect()) == [40.0, 50.0]
    with pytest.raises(ValueError):
        keyed_table.scan_catalog(
            spark,
            path,
            '{"rowkey": "key", "columns": {"a": {"cf": "x", "col": "lat", "type": "double"},'
            ' "b": {"cf": "y", "col": "lat", "type": "double"}}}',
        )


def test_a_compacted_copy_keeps_the_view_under_replay_and_further_batches(spark, tmp_path):
    path, copy = str(tmp_path / "t"), str(tmp_path / "c")
    for batch_id in range(3):
        _put(spark, path, batch_id, *[(1, i, "B", 40.0 + batch_id, -73.9) for i in range(5)])
    before = _rows(keyed_table.latest(spark, path))
    keyed_table.copy_current(spark, path, copy)
    assert _rows(keyed_table.latest(spark, copy)) == before and keyed_table.log(spark, copy).count() == 5
    _put(spark, copy, 2, *[(1, i, "B", 42.0, -73.9) for i in range(5)])
    assert _rows(keyed_table.latest(spark, copy)) == before
    _put(spark, copy, 3, (1, 0, "B", 9.0, 9.0))
    got = {r["rowkey"][0]: r["lat"] for r in keyed_table.latest(spark, copy).collect()}
    assert got == {"0": 9.0, "1": 42.0, "2": 42.0, "3": 42.0, "4": 42.0}


def test_a_table_without_batches_is_empty(spark, tmp_path):
    rows = keyed_table.latest(spark, str(tmp_path / "none"))
    assert rows.columns == ["rowkey", "lat", "lon", "version"] and rows.isEmpty()
    assert keyed_table.scan_catalog(spark, str(tmp_path / "none"), TRIP_CATALOG).isEmpty()


def test_hot_key_collapses_to_one_row_per_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    trips = spark.range(30_000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 1000).cast("int").alias("cid"),
        F.lit("B").alias("base"),
        F.lit(WHEN).cast("timestamp_ntz").alias("dt"),
        F.col("id").cast("double").alias("lat"),
        F.lit(0.0).alias("lon"),
    )
    jobs.write_puts(path, "event_id")(trips, 0)
    got = keyed_table.latest(spark, path)
    want = trips.groupBy("cid").agg(F.max("lat").alias("lat"))
    assert got.count() == want.count() == keyed_table.log(spark, path).count()
    assert got.select("lat").exceptAll(want.select("lat")).isEmpty()
