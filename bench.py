"""Time the headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; print one JSON line."""

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from kerbline.functions import codec  # noqa: E402
from kerbline.operators import clustering  # noqa: E402
from kerbline.operators.centers import CITY_CENTERS  # noqa: E402
from kerbline.plans import queries as q  # noqa: E402
from kerbline.session import get_spark, scratch_dir  # noqa: E402
from kerbline.sources import topics  # noqa: E402
from kerbline.streaming import jobs, run  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3

BATCH = [
    "cluster_assign",
    "count_hour_cluster",
    "count_month_day_hour_cluster",
    "count_cluster",
    "sql_count_hour",
    "window_count_cluster",
    "enrich_join",
    "csv_decode",
    "json_decode",
    "word_count",
    "report_bundle",
    "csv_scan",
    "kv_upsert",
    "kv_compact_replay",
    "cluster_assign_many",
    "cluster_assign_pickups",
    "json_typed_map",
]


def fit(spark, sf_dir):
    """K-means with the settings of the published run: k = 20, 10 iterations."""
    return clustering.fit(q.trips(spark, sf_dir), k=20, max_iter=10)


def stream_runs(spark):
    """{name: (run, input rows)}: each run drains a stream over a topic made beforehand, into a fresh place."""
    rows = q.trips(spark, SF_DIR)
    base = scratch_dir(spark, "bench")
    topics.publish(codec.encode_csv(rows), f"{base}/lines")
    topics.publish(codec.encode_enriched(clustering.enrich(rows, CITY_CENTERS)), f"{base}/enriched")
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text")
    topics.publish(documents.selectExpr("replace(text, '\n', ' ') AS value"), f"{base}/words")

    def enrich():
        to = scratch_dir(spark, "bench")
        run.drain(jobs.enrich(topics.subscribe(spark, f"{base}/lines"), CITY_CENTERS, f"{to}/out", f"{to}/cp"))

    def windows():
        to = scratch_dir(spark, "bench")
        decoded = jobs.decoded_enriched(topics.subscribe(spark, f"{base}/enriched"))
        handlers = [jobs.write_batch_counts(f"{to}/counts")]
        run.drain(jobs.with_dead_letters(decoded, handlers, f"{to}/dead", f"{to}/cp"))
        jobs.window_totals(spark, f"{to}/counts").write.format("noop").mode("overwrite").save()

    def words():
        to = scratch_dir(spark, "bench")
        run.drain(jobs.batch_word_counts(topics.subscribe(spark, f"{base}/words"), f"{to}/counts", f"{to}/cp"))
        jobs.word_totals(spark, f"{to}/counts").write.format("noop").mode("overwrite").save()

    def upsert():
        to = scratch_dir(spark, "bench")
        source = topics.subscribe(spark, f"{base}/enriched", position=True)
        decoded = jobs.decoded_enriched(source)
        handlers = [jobs.write_puts(f"{to}/table")]
        run.drain(jobs.with_dead_letters(decoded, handlers, f"{to}/dead", f"{to}/cp"))

    n = rows.count()
    return {
        "stream_enrich": (enrich, n),
        "stream_window_count": (windows, n),
        "stream_word_count": (words, documents.count()),
        "stream_kv_upsert": (upsert, n),
    }


def timed(action, runs):
    best = None
    for _ in range(runs):
        begin = time.perf_counter()
        action()
        took = time.perf_counter() - begin
        best = took if best is None else min(best, took)
    return round(best, 3)


def main():
    spark = get_spark(
        "kerbline-bench",
        **{
            "spark.master": f"local[{CPUS}]",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="kerbline-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def noop(name):
        q.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    noop("count_hour_cluster")
    times, rates = {}, {}
    for name in BATCH:
        times[name] = timed(lambda name=name: noop(name), RUNS)
    for name, (action, rows) in stream_runs(spark).items():
        times[name] = timed(action, RUNS)
        rates[name] = round(rows / times[name])
    times["kmeans_fit_k20_iter10"] = timed(lambda: fit(spark, SF_DIR), 1)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline query time, best of runs",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rows_per_sec": rates,
                "sf": SF_DIR.rstrip("/").split("sf")[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
