import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from kerbline.functions import codec
from kerbline.operators import clustering, reports
from kerbline.operators.centers import CITY_CENTERS
from kerbline.plans import queries
from kerbline.schemas import TRIP_ENRICHED
from kerbline.sources import count_log, keyed_table, tables, topics
from kerbline.streaming import jobs, run

GOOD = "2014-08-01 00:00:00,40.7,-73.9,B1"


def _send(spark, topic, *values):
    topics.publish(spark.createDataFrame([(v,) for v in values], "value string").coalesce(1), topic)
    time.sleep(0.01)


def _enriched(spark, minute, cid, hour=0):
    when = f"2014-08-01 {hour:02d}:{minute:02d}:00"
    return (
        f'{{"cid":{cid},"dt":"{when}","lat":40.7,"lon":-73.9,"base":"B{minute}",'
        '"clat":40.6,"clon":-73.8}'
    )


def _values(df):
    return sorted(r["value"] for r in df.collect())


def test_enrich_restart_adds_only_new_rows_and_rejects_bad_lines(spark, tmp_path):
    lines, out, dead = (str(tmp_path / n) for n in ("lines", "out", "dead"))

    def once():
        source = topics.subscribe(spark, lines)
        run.drain(jobs.enrich(source, CITY_CENTERS, out, str(tmp_path / "cp")))
        run.drain(jobs.reject_lines(source, dead, str(tmp_path / "cp-dead")))
        return topics.read(spark, out).count(), _values(topics.read(spark, dead))

    _send(spark, lines, GOOD, "bad,x")
    assert once() == (1, ["bad,x"])
    assert once() == (1, ["bad,x"])
    _send(spark, lines, GOOD, "2014-08-01 01:00:00,40.8,-73.8,B2")
    assert once() == (3, ["bad,x"])


def test_subscribe_reads_several_topics(spark, tmp_path):
    for name in ("a", "b"):
        _send(spark, str(tmp_path / name), name)
    source = topics.subscribe(spark, f"{tmp_path}/a, {tmp_path}/b")
    run.drain(topics.publish_stream(source, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert _values(topics.read(spark, str(tmp_path / "out"))) == ["a", "b"]
    assert _values(topics.read(spark, f"{tmp_path}/a,{tmp_path}/b")) == ["a", "b"]


def test_kafka_needs_the_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        topics.subscribe(spark, "a,b", kind="kafka", **{"kafka.bootstrap.servers": "broker:9092"})


def test_sorted_enrich_orders_each_batch_and_replay_adds_nothing(spark, tmp_path):
    lines, out = str(tmp_path / "lines"), str(tmp_path / "out")
    _send(spark, lines, *[GOOD.replace("00:00:00", f"00:{m:02d}:00") for m in (30, 10, 20)])
    publish = jobs._publish_enriched(CITY_CENTERS, out, True, "file")
    trips = codec.good(codec.decode_csv(topics.read(spark, lines)))
    for _ in range(2):
        publish(trips, 0)
        rows = jobs.decode_enriched(topics.read(spark, out)).collect()
        assert [r["dt"].minute for r in rows] == [10, 20, 30]


def test_batch_counts_are_batch_local_and_their_totals_run(spark, tmp_path):
    topic = str(tmp_path / "topic")
    base = str(tmp_path)

    def once():
        trips = jobs.decode_enriched(topics.subscribe(spark, topic))
        run.drain(jobs.batch_counts(trips, f"{base}/batch", f"{base}/cp1"))

    _send(spark, topic, _enriched(spark, 1, 7, hour=9), _enriched(spark, 2, 7), "junk")
    once()
    _send(spark, topic, _enriched(spark, 3, 7), _enriched(spark, 4, 8))
    once()
    local = jobs.batch_report(spark, f"{base}/batch", "cluster").collect()
    assert sorted((r["batch_id"], r["cid"], r["count"]) for r in local) == [
        (0, 7, 2),
        (1, 7, 1),
        (1, 8, 1),
    ]
    hours = jobs.batch_report(spark, f"{base}/batch", "hour").collect()
    assert sorted((r["batch_id"], r["hr"], r["ct"]) for r in hours) == [(0, 0, 1), (0, 9, 1), (1, 0, 2)]
    start = dt.datetime(2014, 8, 1)
    want = [(7, start, 2), (7, start + dt.timedelta(hours=9), 1), (8, start, 1)]
    count_log.copy_totals(spark, f"{base}/batch", f"{base}/copy", jobs.CUBE_COUNTS)
    for path in ("batch", "copy"):
        total = jobs.window_totals(spark, f"{base}/{path}").collect()
        assert sorted((r["cid"], r["window_start"], r["count"]) for r in total) == want


def test_last_message_of_a_key_wins(spark, tmp_path):
    topic, base = str(tmp_path / "topic"), str(tmp_path)
    line = _enriched(spark, 1, 7)
    _send(spark, topic, line.replace("40.7", "40.9"), line.replace("40.7", "40.1"))
    time.sleep(1.1)
    _send(spark, topic, line.replace("40.7", "40.5"))
    trips = jobs.decode_enriched(topics.subscribe(spark, topic, position=True))
    run.drain(jobs.upsert(trips, f"{base}/kv", f"{base}/cp"))
    assert [r["lat"] for r in keyed_table.latest(spark, f"{base}/kv").collect()] == [40.5]
    _send(spark, topic, line.replace("40.7", "40.3"), line.replace("40.7", "40.2"))
    run.drain(jobs.upsert(trips, f"{base}/kv", f"{base}/cp"))
    assert [r["lat"] for r in keyed_table.latest(spark, f"{base}/kv").collect()] == [40.2]


def test_one_read_gives_good_rows_and_dead_letters(spark, tmp_path):
    topic, base = str(tmp_path / "topic"), str(tmp_path)
    bad = ["junk", "{}", "", '{"cid":1}', _enriched(spark, 1, 7).replace("40.7", "NaN")]
    _send(spark, topic, _enriched(spark, 1, 7), *bad)
    decoded = jobs.decoded_enriched(topics.subscribe(spark, topic, position=True))
    run.drain(jobs.with_dead_letters(decoded, [jobs.write_puts(f"{base}/kv")], f"{base}/dead", f"{base}/cp"))
    assert [r["rowkey"] for r in keyed_table.latest(spark, f"{base}/kv").collect()] == [
        "7_B1_2014-08-01 00:01:00"
    ]
    assert _values(topics.read(spark, f"{base}/dead")) == sorted(bad)
    strict = jobs.decoded_enriched(topics.subscribe(spark, topic), strict=True)
    with pytest.raises(Exception, match="malformed message"):
        run.drain(jobs.with_dead_letters(strict, [jobs.write_batch_counts(f"{base}/c")], f"{base}/d", f"{base}/cp2"))


@pytest.mark.parametrize("name", ["stream_kv_upsert", "stream_word_count", "stream_enrich", "stream_enrich_sorted"])
def test_streams_are_right_in_several_micro_batches(spark, tmp_path, monkeypatch, name):
    folder = tmp_path / "sf"
    for table in ("events", "documents"):
        rows = spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").limit(90)
        rows.repartition(3).write.parquet(str(folder / f"{table}.parquet"))
    whole = queries.QUERIES[name](spark, str(folder))
    want = sorted(map(tuple, whole.collect()), key=repr)
    one_table, one_topic = tables.stream_table, topics.subscribe

    def in_parts(session, sf_dir, table):
        schema = spark.read.parquet(f"{sf_dir}/{table}.parquet").schema
        reader = session.readStream.schema(schema).option("maxFilesPerTrigger", 1)
        return reader.parquet(f"{sf_dir}/{table}.parquet")

    monkeypatch.setattr(tables, "stream_table", in_parts)
    monkeypatch.setattr(topics, "subscribe", lambda s, t, **k: one_topic(s, t, **{**k, "maxFilesPerTrigger": 1}))
    parts = queries.QUERIES[name](spark, str(folder))
    assert one_table is not in_parts
    assert sorted(map(tuple, parts.collect()), key=repr) == want


def test_append_mode_emits_closed_windows_and_drops_late_rows(spark, tmp_path):
    topic, base = str(tmp_path / "topic"), str(tmp_path)
    waves = [
        [_enriched(spark, 5, 1)],
        [_enriched(spark, 5, 1, hour=5)],
        [_enriched(spark, 5, 1, hour=6)],
        [_enriched(spark, 9, 1), _enriched(spark, 10, 1, hour=9)],
        [_enriched(spark, 0, 1, hour=12)],
    ]
    for wave in waves:
        _send(spark, topic, *wave)
        trips = jobs.decode_enriched(topics.subscribe(spark, topic))
        run.drain(
            jobs.windows_with_watermark(trips, "10 minutes")
            .writeStream.outputMode("append")
            .format("parquet")
            .option("path", f"{base}/out")
            .option("checkpointLocation", f"{base}/cp")
        )
    rows = spark.read.parquet(f"{base}/out").collect()
    assert sorted((r["window_start"].hour, r["count"]) for r in rows) == [
        (0, 1),
        (5, 1),
        (6, 1),
        (9, 1),
    ]


def test_word_totals_over_three_batches_and_a_compaction(spark, tmp_path):
    topic, base = str(tmp_path / "topic"), str(tmp_path)
    for lines in (["a b a"], ["b  c ", "d"], ["a"]):
        _send(spark, topic, *lines)
        run.drain(jobs.batch_word_counts(topics.subscribe(spark, topic), f"{base}/out", f"{base}/cp"))
    want = {"a": 3, "b": 2, "": 1, "c": 1, "d": 1}
    assert {r["word"]: r["count"] for r in jobs.word_totals(spark, f"{base}/out").collect()} == want
    count_log.copy_totals(spark, f"{base}/out", f"{base}/copy")
    assert {r["word"]: r["count"] for r in jobs.word_totals(spark, f"{base}/copy").collect()} == want
    copied = {r["batch_id"] for r in spark.read.parquet(f"{base}/copy").select("batch_id").distinct().collect()}
    assert copied == {-1, 2}


def test_empty_batches_are_skipped(spark, tmp_path):
    seen = []
    topic = str(tmp_path / "topic")
    _send(spark, topic, "junk")
    trips = jobs.decode_enriched(topics.subscribe(spark, topic))
    run.drain(run.per_batch(trips, lambda b, i: seen.append(i), str(tmp_path / "cp")))
    run.drain(run.fan_out(trips, [lambda b, i: seen.append(i)], str(tmp_path / "cp2")))
    assert seen == []
    _send(spark, topic, _enriched(spark, 1, 7))
    run.drain(run.per_batch(trips, lambda b, i: seen.append(i), str(tmp_path / "cp")))
    assert seen == [1]


def test_replay_copies_every_line_in_batches(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    for i in range(3):
        (folder / f"f{i}.txt").write_text(f"line {i}\n\nlast {i}")
        os.utime(folder / f"f{i}.txt", (1_400_000_000 + i, 1_400_000_000 + i))
    query = run.drain(
        jobs.replay(
            spark, str(folder), str(tmp_path / "topic"), str(tmp_path / "cp"), files_per_batch=1
        )
    )
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3
    assert run.rows_read(query) == 9
    got = _values(topics.read(spark, str(tmp_path / "topic")))
    assert got == ["", "", ""] + sorted(f"{w} {i}" for w in ("line", "last") for i in range(3))


def test_constant_items_repeat_every_batch(spark, tmp_path):
    items = jobs.constant_items(spark)
    topic, cp = str(tmp_path / "topic"), str(tmp_path / "cp")
    want = sorted(f'{{"id":"{i}","value":"{i}"}}' for i in range(10))
    for batches in (1, 2):
        run.drain(jobs.publish_items(items, topic, cp))
        assert _values(topics.read(spark, topic)) == sorted(want * batches)


def test_console_tail_interval_trigger_and_stop(spark, tmp_path):
    topic = str(tmp_path / "topic")
    _send(spark, topic, "hello")
    query = run.start(
        jobs.tail(topics.subscribe(spark, topic), str(tmp_path / "cp")), interval="100 milliseconds"
    )
    try:
        deadline = time.time() + 60
        while run.rows_read(query) < 1 and time.time() < deadline:
            time.sleep(0.2)
        assert run.rows_read(query) == 1
    finally:
        query.stop()
    assert not query.isActive and query.exception() is None


def test_stream_and_batch_enrichment_agree(spark, sf_dir, tmp_path):
    lines = codec.encode_csv(queries.trips(spark, sf_dir))
    topics.publish(lines, str(tmp_path / "lines"))
    run.drain(
        jobs.enrich(
            topics.subscribe(spark, str(tmp_path / "lines")),
            CITY_CENTERS,
            str(tmp_path / "out"),
            str(tmp_path / "cp"),
        )
    )
    streamed = jobs.decode_enriched(topics.read(spark, str(tmp_path / "out")))
    batch = clustering.enrich(queries.trips(spark, sf_dir), CITY_CENTERS).select(
        *TRIP_ENRICHED.names
    )
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()
    counts = reports.count_cluster(streamed)
    assert counts.agg(F.sum("count")).first()[0] == batch.count()


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_running_windows_follow_wall_clock_in_any_session_zone(spark, tmp_path, zone):
    topic, base = str(tmp_path / "topic"), str(tmp_path)
    keys = ("cid", "window_start", "window_end")
    # 02:30 on this day does not exist in New York.
    line = _enriched(spark, 30, 1, hour=2).replace("2014-08-01", "2014-03-09")
    _send(spark, topic, line, _enriched(spark, 10, 1, hour=3))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        counts = jobs.windows_with_watermark(jobs.decode_enriched(topics.subscribe(spark, topic)), "10 minutes")
        run.drain(jobs.keep_totals(counts, keys, f"{base}/out", f"{base}/cp"))
        got = keyed_table.latest(spark, f"{base}/out", keys).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert sorted(r["window_start"] for r in got) == [
        dt.datetime(2014, 3, 9, 2),
        dt.datetime(2014, 8, 1, 3),
    ]
