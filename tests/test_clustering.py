import math

import pytest
from pyspark.sql import functions as F

from kerbline.operators import clustering
from kerbline.operators.centers import CITY_CENTERS
from kerbline.plans import queries
from kerbline.schemas import CENTER, TRIP_ENRICHED, conform

# Pickups with the cluster a published model gave them.
KNOWN = [
    (40.3495, -74.0667, 3),
    (40.6759, -74.0168, 5),
    (40.6982, -73.9669, 14),
    (40.7134, -74.0091, 19),
    (40.6718, -73.9522, 5),
    (40.6123, -73.956, 5),
    (40.6748, -73.9815, 5),
    (40.6969, -73.9064, 14),
    (40.7133, -73.9414, 14),
    (40.7231, -73.8529, 18),
    (40.7364, -74.0301, 19),
    (40.7366, -73.9906, 0),
    (40.7524, -73.9858, 17),
    (40.7574, -73.9668, 17),
    (40.7047, -73.9349, 14),
    (40.7209, -73.9977, 0),
    (40.7213, -73.9946, 0),
    (40.7272, -73.9917, 0),
    (40.753, -73.9787, 17),
    (40.7247, -73.9957, 0),
]


def _brute(lat, lon, centers):
    return min(range(len(centers)), key=lambda i: (
        (lat - centers[i][0]) * (lat - centers[i][0])
        + (lon - centers[i][1]) * (lon - centers[i][1]), i))


def _grid(k):
    return [(40.5 + (i * 37 % 101) / 200, -74.2 + (i * 53 % 97) / 150) for i in range(k)]


def test_known_assignments(spark):
    df = spark.createDataFrame(KNOWN, "lat double, lon double, want int")
    assert clustering.nearest(df, CITY_CENTERS).where("cid != want").count() == 0


@pytest.mark.parametrize("k", [1, 8, 20, clustering.BLOCK, clustering.BLOCK + 1, 120])
def test_nearest_matches_brute_force_for_any_k(spark, sf_dir, k):
    centers = _grid(k)
    rows = clustering.nearest(queries.trips(spark, sf_dir), centers, "d2").collect()
    for r in rows:
        assert r["cid"] == _brute(r["lat"], r["lon"], centers)
        best = centers[r["cid"]]
        assert math.isclose(r["d2"], (r["lat"] - best[0]) ** 2 + (r["lon"] - best[1]) ** 2)


@pytest.mark.parametrize("k", [3, 110])
def test_ties_go_to_the_lowest_id_and_missing_coordinates_to_none(spark, k):
    centers = [(1.0, 0.0), (-1.0, 0.0), (1.0, 0.0)] + [(50.0, 50.0)] * (k - 3)
    nan = float("nan")
    df = spark.createDataFrame(
        [(0.0, 0.0), (-0.5, 0.0), (None, 0.0), (0.0, None), (nan, 0.0)], "lat double, lon double"
    )
    assert [r["cid"] for r in clustering.nearest(df, centers).collect()] == [0, 1, None, None, None]


def test_enrich_schema_and_rows_without_coordinates(spark):
    df = spark.createDataFrame(
        [(40.7, -73.9, "B1"), (None, -73.9, "B2"), (float("nan"), -73.9, "B3")],
        "lat double, lon double, base string",
    ).withColumn("dt", F.lit("2014-08-01 00:00:00").cast("timestamp_ntz"))
    out = conform(clustering.enrich(df, CITY_CENTERS), TRIP_ENRICHED)
    rows = out.collect()
    assert [r["base"] for r in rows] == ["B1"]
    assert (rows[0]["clat"], rows[0]["clon"]) == CITY_CENTERS[rows[0]["cid"]]


def test_enrich_beyond_the_broadcast_bound_gives_the_same_rows(spark, sf_dir, monkeypatch):
    trips = queries.trips(spark, sf_dir)
    small = clustering.enrich(trips, CITY_CENTERS)
    monkeypatch.setattr(clustering, "BROADCAST_LIMIT", 0)
    large = clustering.enrich(trips, CITY_CENTERS)
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()


@pytest.mark.parametrize("k", [8, 20])
def test_fit_center_table_and_roundtrip(spark, sf_dir, tmp_path, k):
    trips = queries.trips(spark, sf_dir)
    model = clustering.fit(trips, k=k, max_iter=2)
    again = clustering.fit(trips, k=k, max_iter=2)
    assert clustering.centers_of(model) == clustering.centers_of(again)
    table = clustering.center_table(spark, clustering.centers_of(model))
    assert table.schema == CENTER
    assert table.count() == k and table.where("clat IS NULL OR clon IS NULL").isEmpty()
    clustering.save_model(model, str(tmp_path / "m"))
    clustering.save_model(model, str(tmp_path / "m"))
    loaded = clustering.load_model(str(tmp_path / "m"))
    assert clustering.centers_of(loaded) == clustering.centers_of(model)
    own = clustering.cost(trips, clustering.centers_of(model)).first()["cost"]
    assert 0 < own <= clustering.training_cost(model) * (1 + 1e-9)


def test_collapsed_copies_weigh_like_the_copies(spark):
    rows = [(40.7, -73.9)] * 400 + [(40.71, -73.95), (40.8, -74.0), (40.9, -74.1)] * 3
    df = spark.createDataFrame(rows, "lat double, lon double")
    points = clustering.collapse(df)
    assert points.count() == 4
    assert points.agg(F.sum("weight")).first()[0] == len(rows)
    start = [(40.7, -73.9), (40.9, -74.1)]
    got = clustering.refine(df, start, 1)
    groups = [[p for p in rows if _brute(*p, start) == i] for i in (0, 1)]
    for center, group in zip(got, groups):
        assert math.isclose(center[0], sum(p[0] for p in group) / len(group), rel_tol=1e-12)
        assert math.isclose(center[1], sum(p[1] for p in group) / len(group), rel_tol=1e-12)


def test_refine_keeps_a_centre_without_pickups(spark):
    df = spark.createDataFrame([(1.0, 1.0)], "lat double, lon double")
    assert clustering.refine(df, [(1.0, 1.0), (9.0, 9.0)], 2) == [(1.0, 1.0), (9.0, 9.0)]


def test_missing_coordinates_get_no_cluster_and_no_weight(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(40.7, -73.9), (40.8, -73.8), (None, -73.9), (40.7, nan), (inf, -73.9)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    model = clustering.fit(df, k=2, max_iter=2)
    assert sorted(clustering.centers_of(model)) == [(40.7, -73.9), (40.8, -73.8)]
    for assigned in (clustering.predict(model, df), clustering.nearest(df, clustering.centers_of(model))):
        got = [r["cid"] for r in assigned.collect()]
        assert sorted(got[:2]) == [0, 1] and got[2:] == [None, None, None]
        assert assigned.columns == ["lat", "lon", "cid"]
    assert clustering.first_points(df.coalesce(1), 5, "lat") == [(40.7, -73.9), (40.8, -73.8)]


@pytest.mark.parametrize("key", [None, "k"])
def test_hash_split_puts_nulls_in_one_part(spark, key):
    df = spark.createDataFrame([(None, None), ("a", 1), ("b", 2)], "k string, n int")
    split = clustering.hash_split(df, key)
    assert split.where("in_train IS NULL").isEmpty() and split.count() == 3


def test_hash_split_is_stable_under_repartitioning(spark, sf_dir):
    trips = queries.trips(spark, sf_dir)
    one = clustering.hash_split(trips, "event_id").where("in_train").select("event_id")
    two = clustering.hash_split(trips.repartition(13), "event_id").where("in_train")
    assert one.exceptAll(two.select("event_id")).isEmpty()
    assert one.count() == two.count()


def test_random_split_is_complete_and_disjoint(spark, sf_dir):
    trips = queries.trips(spark, sf_dir).select("event_id")
    train, test = clustering.random_split(trips)
    assert train.intersect(test).isEmpty()
    assert train.union(test).exceptAll(trips).isEmpty()
    assert train.count() + test.count() == trips.count()
