"""Sums of streaming metrics over more batches than a query remembers, and event-time state."""

import datetime as dt

from pyspark.sql import functions as F

from kerbline.functions import codec
from kerbline.sources import topics
from kerbline.streaming import jobs, run, totals


def _trip(day, hour, cid):
    return (
        f'{{"cid":{cid},"dt":"2014-08-{day:02d} {hour:02d}:10:00","lat":40.7,"lon":-73.9,"base":"B",'
        '"clat":40.6,"clon":-73.8}'
    )


def _send(spark, topic, values, files=1):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    topics.publish(df.repartitionByRange(files, "i").select("value"), topic)


def test_totals_go_beyond_the_remembered_batches(spark, tmp_path):
    topic = str(tmp_path / "topic")
    _send(spark, topic, [_trip(1, i % 24, i) if i % 4 else "junk" for i in range(212)], files=106)
    with totals.listening(spark) as sums:
        source = topics.subscribe(spark, topic, **topics.let_go(files_per_batch=1))
        query = run.drain(jobs.count_messages(jobs.decoded_enriched(source), str(tmp_path / "cp")))
        found = sums.of(query)
        sums.keep(spark, str(tmp_path / "kept"))
        sums.keep(spark, str(tmp_path / "kept"))
    assert found[totals.BATCHES] > 100 and run.rows_read(query) < 212
    assert (found[totals.INPUT], found[jobs.GOOD], found[jobs.REJECTED]) == (212, 159, 53)
    kept = {r["metric"]: r["n"] for r in totals.kept(spark, str(tmp_path / "kept")).collect()}
    assert kept == found


def test_fan_out_counts_each_message_once(spark, tmp_path):
    topic, base = str(tmp_path / "topic"), str(tmp_path)
    _send(spark, topic, [_trip(1, 5, 1), "junk", "", _trip(1, 6, 2)], files=3)
    decoded = jobs.decoded_enriched(topics.subscribe(spark, topic))
    handlers = [jobs.write_batch_counts(f"{base}/counts"), jobs.write_batch_counts(f"{base}/counts2")]
    with totals.listening(spark) as sums:
        found = sums.of(run.drain(jobs.with_dead_letters(decoded, handlers, f"{base}/dead", f"{base}/cp")))
    assert (found[totals.INPUT], found[jobs.GOOD], found[jobs.REJECTED]) == (4, 2, 2)


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    topic, out = str(tmp_path / "topic"), str(tmp_path / "windows")

    def once(*messages):
        _send(spark, topic, messages)
        rows = jobs.decode_enriched(topics.subscribe(spark, topic))
        rows = rows.repartition("cid", F.date_trunc("hour", "dt"))
        with totals.listening(spark) as sums:
            return sums.of(run.drain(jobs.append_windows(rows, "1 day", out, str(tmp_path / "cp"))))

    def written():
        found = spark.read.parquet(out).collect()
        return sorted((r["cid"], r["window_start"].day, r["window_start"].hour, r["count"]) for r in found)

    assert once(_trip(1, 5, 1), _trip(1, 5, 1), _trip(3, 7, 1))[totals.DROPPED] == 0
    assert written() == [(1, 1, 5, 2)]
    # the first two are late, as one group; the third is older than the newest but within the watermark
    found = once(_trip(1, 5, 1), _trip(1, 5, 1), _trip(2, 9, 2), _trip(9, 0, 1))
    assert (found[totals.DROPPED], found[totals.INPUT]) == (1, 4)
    assert written() == [(1, 1, 5, 2), (1, 3, 7, 1), (2, 2, 9, 1)]
    assert [r["window_end"] - r["window_start"] for r in spark.read.parquet(out).collect()] == [dt.timedelta(hours=1)] * 3


def test_word_totals_survive_a_restart(spark, tmp_path):
    from kerbline.sources import keyed_table

    topic, table = str(tmp_path / "topic"), str(tmp_path / "words")
    for lines in (["a b a", "c"], ["a", ""], ["b  b"]):
        _send(spark, topic, lines)
        run.drain(jobs.running_word_counts(topics.subscribe(spark, topic), table, str(tmp_path / "cp")))
    rows = {r["word"]: r["count"] for r in keyed_table.latest(spark, table, ("word",)).collect()}
    assert rows == {"a": 3, "b": 3, "c": 1, "": 2}
    per_batch = keyed_table.log(spark, table).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [r["count"] for r in per_batch] == [3, 2, 2]  # changed words only


def test_archived_messages_leave_the_topic(spark, tmp_path):
    topic, archive, out = (str(tmp_path / n) for n in ("topic", "archive", "out"))
    for batch in ("ab", "cd", "ef", ""):
        if batch:
            _send(spark, topic, list(batch), files=2)
        source = topics.subscribe(spark, topic, **topics.let_go(archive=archive, files_per_batch=1))
        run.drain(topics.publish_stream(source, out, str(tmp_path / "cp")))
    held = [r["value"] for r in topics.read(spark, topic).collect()]
    gone = [r["value"] for r in topics.read(spark, archive, recursiveFileLookup=True).collect()]
    assert gone and sorted(held + gone) == list("abcdef")
    assert sorted(r["value"] for r in topics.read(spark, out).collect()) == list("abcdef")


def test_typed_maps(spark):
    texts = ['{"a":1,"b":[1,{"c":"x"}],"d":null}', "{}", "[1]", "{", None, "", '{"a":1e400}', '{"a":"\\u00e9"}', '"x"']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    m = codec.json_to_variants(F.col("t"))
    rows = df.select(
        "i",
        F.map_keys(m).alias("keys"),
        codec.variant_value(m, "a", "bigint").alias("a"),
        codec.variant_value(m, "b", "string", "$[1].c").alias("c"),
        codec.variant_value(m, "missing", "string").alias("none"),
        codec.encode_map(m).alias("json"),
    ).orderBy("i")
    found = [tuple(r)[1:] for r in rows.collect()]
    assert found[0] == (["a", "b", "d"], 1, "x", None, '{"a":1,"b":[1,{"c":"x"}],"d":null}')
    assert found[1] == ([], None, None, None, "{}")
    assert found[2] == found[3] == found[4] == found[5] == found[8] == (None, None, None, None, None)
    assert found[7][4] == '{"a":"é"}'


def test_map_keys_are_ordered_and_nulls_are_written(spark):
    df = spark.sql("SELECT map('b', 1, 'a', null, 'Z', 3) AS m UNION ALL SELECT map() UNION ALL SELECT null")
    assert sorted(str(r[0]) for r in df.select(codec.encode_map(F.col("m"))).collect()) == ["None", '{"Z":3,"a":null,"b":1}', "{}"]
