"""Plan shapes that decide the cost at scale."""

import contextlib
import io
import re

import pytest

from kerbline.functions import text
from kerbline.operators import clustering, hourly, reports
from kerbline.operators.centers import CITY_CENTERS
from kerbline.plans import queries
from kerbline.session import scratch_dir
from kerbline.sources import batch_log, keyed_table
from kerbline.streaming import jobs

HOTSPOT_METHOD_LIMIT = 8000


def _explain(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.fixture(scope="module")
def kv_path(spark, sf_dir):
    return queries._kv_table(spark, sf_dir)


def test_assignment_is_row_local(spark, sf_dir):
    plan = _explain(queries.cluster_assign(spark, sf_dir))
    assert "Exchange" not in plan and "Join" not in plan and "Python" not in plan


@pytest.mark.parametrize("name", ["cluster_assign", "enrich_join", "count_hour_cluster", "csv_decode"])
def test_generated_methods_stay_small_enough_to_compile(spark, sf_dir, name):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _explain(queries.QUERIES[name](spark, sf_dir), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(s) for s in re.findall(r"maxMethodCodeSize:(\d+)", plan)]
    assert sizes and max(sizes) < HOTSPOT_METHOD_LIMIT


def test_filter_on_the_cluster_stays_above_the_assignment(spark, sf_dir):
    rows = queries.clustered(spark, sf_dir).where("cid = 3")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Filter") == 1 and plan.index("Filter") < plan.index("Generate")


@pytest.mark.parametrize("k", [50, 101, 500])
def test_assignment_compiles_for_any_number_of_centres(spark, sf_dir, k):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = clustering.nearest(queries.trips(spark, sf_dir), queries.many_centers(k))
        sizes = re.findall(r"maxMethodCodeSize:(\d+)", _explain(rows, "codegen"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sizes and max(map(int, sizes)) < HOTSPOT_METHOD_LIMIT


def test_upsert_by_position_hash_aggregates(spark, sf_dir, monkeypatch):
    plans = []
    monkeypatch.setattr(batch_log, "append", lambda df, *a: plans.append(_explain(df)))
    write = jobs.write_puts("unused", "event_id", unique_version=True)
    write(queries.keyed(queries.trips(spark, sf_dir)), 0)
    assert "SortAggregate" not in plans[0] and "partial_max_by" in plans[0]


def test_centre_join_is_a_broadcast_join(spark, sf_dir, monkeypatch):
    plan = _explain(queries.enrich_join(spark, sf_dir))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    monkeypatch.setattr(clustering, "BROADCAST_LIMIT", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = _explain(clustering.enrich(queries.trips(spark, sf_dir), CITY_CENTERS))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan


def test_counts_read_two_columns_and_aggregate_before_the_shuffle(spark, sf_dir):
    for build in (reports.count_hour_cluster, hourly.cube):
        plan = _explain(build(queries.clustered(spark, sf_dir)))
        assert "partial_count" in plan
        assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan
        assert "SortAggregate" not in plan


def test_top_rows_need_no_full_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in _explain(queries.QUERIES["topk_hour_cluster"](spark, sf_dir))
    assert "TakeOrderedAndProject" in _explain(queries.limit_n(spark, sf_dir))


def test_key_filters_reach_the_scan_and_the_view_hash_aggregates(spark, kv_path):
    rows = keyed_table.latest(spark, kv_path, columns=["lat"])
    prefix = _explain(rows.where(text.key_of_cluster("rowkey", 2)))
    assert "StringStartsWith(rowkey,2_)" in prefix
    assert "SortAggregate" not in prefix and "partial_max_by" in prefix
    assert "ReadSchema: struct<rowkey:string,lat:double>" in prefix
    bound = _explain(rows.where(text.key_at_most("rowkey", "11")))
    assert "LessThanOrEqual(rowkey,11)" in bound


def test_messages_are_parsed_once(spark, sf_dir):
    for name, parser in (("csv_decode", "from_csv"), ("json_decode", "from_json")):
        plan = _explain(queries.QUERIES[name](spark, sf_dir), "simple")
        assert plan.count(f"{parser}(") == 1


def test_no_query_runs_python_per_row(spark, sf_dir):
    for name in ("word_count", "json_to_map", "window_count_cluster", "pivot_hour_cluster"):
        plan = _explain(queries.QUERIES[name](spark, sf_dir))
        assert "Python" not in plan and "CartesianProduct" not in plan


def test_scratch_folder_follows_the_session_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one.startswith(base) and one != two
