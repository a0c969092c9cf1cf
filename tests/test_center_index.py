"""The index of centres against all distances, on centres and points of many shapes."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbline.operators import center_index, clustering
from kerbline.plans import queries


def _grid(n):
    return [(float(i // n), float(i % n)) for i in range(n * n)]


def _circle(n):
    angle = 2 * np.pi * np.arange(n) / n
    return list(zip(np.cos(angle).tolist(), np.sin(angle).tolist()))


def _clumps(n, seed=3):
    rng = np.random.default_rng(seed)
    middles = rng.uniform(-90, 90, (6, 2))
    return (middles[rng.integers(0, 6, n)] + rng.normal(0, 1e-4, (n, 2))).tolist()


SHAPES = {
    "grid": _grid(25),
    "circle": _circle(90),
    "clumps": _clumps(700),
    "line": [(40.0, i / 7) for i in range(80)],
    "repeated": [(1.0, 1.0)] * 60 + [(1.0, 2.0)] * 3,
    "one place": [(40.5, -74.0)] * 55,
    "huge": [(x * 1e9, y * 1e9) for x, y in _grid(9)],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_nearest_is_that_of_all_distances(spark, shape):
    centers = SHAPES[shape]
    rng = np.random.default_rng(7)
    own = np.array(centers)
    middle = (own[:-1] + own[1:]) / 2
    size = max(1e-3, float(np.ptp(own)))
    points = np.concatenate([own[:200], middle[:200], rng.uniform(own.min() - 3 * size, own.max() + 3 * size, (300, 2))])
    rows = [(float(a), float(b)) for a, b in points]
    rows += [(None, 1.0), (1.0, None), (float("nan"), 1.0), (float("inf"), 0.0), (1e200, -1e200), (-1e300, 0.0)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, lat double, lon double")
    found = {r["i"]: (r["cid"], r["d2"]) for r in clustering.nearest(df, centers, "d2").collect()}
    assert len(found) == len(rows)
    for i, (lat, lon) in enumerate(rows):
        if lat is None or lon is None or not np.isfinite([lat, lon]).all():
            assert found[i] == (None, None)
            continue
        distance = [(lat - a) * (lat - a) + (lon - b) * (lon - b) for a, b in centers]
        if min(distance) == float("inf"):
            assert found[i] == (None, None)
            continue
        assert found[i][1] == min(distance)
        assert found[i][0] == distance.index(min(distance))


def test_every_point_of_the_box_is_in_one_leaf():
    cells = center_index.Cells(_clumps(400))
    levels = np.array(cells.keys) >> 48
    assert sorted(set(levels.tolist())) == sorted(cells.levels)
    assert abs((0.25**levels).sum() - 1) < 1e-12
    assert max(len(x) for x, level in zip(cells.lists, levels) if level < cells.last) <= center_index.LEAF
    assert max(map(len, cells.lists)) <= center_index.LISTED


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_plan_does_not_grow_with_the_centres(spark, sf_dir):
    rows = queries.trips(spark, sf_dir)
    few, many = (_plan(clustering.nearest(rows, _grid(n))) for n in (8, 100))
    assert len(many) < 1.5 * len(few)
    assert "BroadcastHashJoin" in many and "hashpartitioning" not in many


def test_ten_thousand_centres(spark):
    rng = np.random.default_rng(1)
    centers = rng.uniform((40.5, -74.2), (41.0, -73.6), (10_000, 2)).tolist()
    begin = time.perf_counter()
    rows = clustering.nearest(queries.trips(spark, "/root/testdata/sf0.1"), centers, "d2")
    rows.write.format("noop").mode("overwrite").save()
    assert time.perf_counter() - begin < 10
    sample = rows.where("event_id % 997 = 0").collect()
    own = np.array(centers)
    for r in sample:
        distance = ((np.array([r["lat"], r["lon"]]) - own) ** 2).sum(1)
        assert r["cid"] == distance.argmin()


def test_a_large_index_is_not_broadcast(spark, sf_dir, monkeypatch):
    rows = queries.trips(spark, sf_dir)
    want = {r["event_id"]: r["cid"] for r in clustering.nearest(rows, _grid(10)).collect()}
    monkeypatch.setattr(center_index, "BROADCAST_CANDIDATES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = clustering.nearest(rows, _grid(10))
        assert "SortMergeJoin" in _plan(out)
        assert {r["event_id"]: r["cid"] for r in out.collect()} == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_stream_is_assigned_too(spark, sf_dir, tmp_path):
    out = clustering.nearest(queries.stream_trips(spark, sf_dir), _grid(12)).select("event_id", "cid")
    query = out.writeStream.format("parquet").option("path", str(tmp_path / "out"))
    query = query.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    batch = clustering.nearest(queries.trips(spark, sf_dir), _grid(12)).select("event_id", "cid")
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == batch.count() and got.exceptAll(batch).count() == 0
    assert got.where(F.col("cid").isNull()).count() == 0
