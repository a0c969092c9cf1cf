import datetime as dt

import pytest
from pyspark.sql import functions as F

from kerbline.functions import codec, text
from kerbline.plans import queries
from kerbline.schemas import TRIP, TRIP_CLUSTERED, TRIP_ENRICHED, conform
from kerbline.sources import files

MIDNIGHT = dt.datetime(2014, 8, 1)
GOOD = "2014-08-01 00:00:00,40.1,-73.9,B1"


def _messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


@pytest.mark.parametrize(
    "line, want",
    [
        (GOOD, (MIDNIGHT, 40.1, -73.9, "B1", None)),
        (GOOD + ",extra", (MIDNIGHT, 40.1, -73.9, "B1", None)),
        ("2014-08-01 00:00:00,40.1,-73.9,,extra", (MIDNIGHT, 40.1, -73.9, None, None)),
        ("bad,x", (None, None, None, None, "bad,x")),
        (
            "2014-08-01 00:00:00,xx,-73.9,B1",
            (MIDNIGHT, None, -73.9, "B1", "2014-08-01 00:00:00,xx,-73.9,B1"),
        ),
        (
            "2014-08-01 00:00:00,40.1,-73.9",
            (MIDNIGHT, 40.1, -73.9, None, "2014-08-01 00:00:00,40.1,-73.9"),
        ),
        ("", (None, None, None, None, "")),
        (GOOD.replace("40.1", "NaN"), (MIDNIGHT, None, -73.9, "B1", GOOD.replace("40.1", "NaN"))),
        (GOOD.replace("-73.9", "Infinity"), (MIDNIGHT, 40.1, float("inf"), "B1", GOOD.replace("-73.9", "Infinity"))),
    ],
)
def test_csv_lines(spark, line, want):
    got = tuple(codec.decode_csv(_messages(spark, line)).first())
    assert tuple(None if x != x else x for x in got) == want


def test_csv_good_and_dead_letters_partition_the_input(spark):
    decoded = codec.decode_csv(_messages(spark, GOOD, "bad,x", GOOD + ",e"))
    assert codec.good(decoded).schema == TRIP and codec.good(decoded).count() == 2
    assert [r["value"] for r in codec.dead_letters(decoded).collect()] == ["bad,x"]


def test_strict_decoders_raise(spark):
    assert codec.decode_csv(_messages(spark, GOOD), strict=True).count() == 1
    with pytest.raises(Exception, match="malformed trip line"):
        codec.decode_csv(_messages(spark, "bad,x"), strict=True).collect()
    with pytest.raises(Exception):
        codec.decode_json(_messages(spark, "junk"), TRIP_ENRICHED, strict=True).collect()


def test_json_messages(spark):
    rows = codec.decode_json(
        _messages(spark, '{"cid":3,"zz":1}', "junk", '{"dt":"2014-08-01 00:00:00","lat":40.5}'),
        TRIP_CLUSTERED,
    ).collect()
    assert (rows[0]["cid"], rows[0]["_corrupt"]) == (3, None)
    assert rows[1]["_corrupt"] == "junk"
    assert (rows[2]["dt"], rows[2]["lat"]) == (MIDNIGHT, 40.5)


def test_json_messages_without_content_or_required_fields_are_corrupt(spark):
    lines = ["", "{}", "null", '{"zz":1}', '{"cid":3}', '{"cid":3,"dt":"2014-08-01 00:00:00","lat":"NaN"}']
    rows = codec.decode_json(_messages(spark, *lines), TRIP_CLUSTERED, required=("dt", "cid")).collect()
    assert [r["_corrupt"] for r in rows] == lines
    good = codec.decode_json(_messages(spark, '{"cid":3}'), TRIP_CLUSTERED).first()
    assert (good["cid"], good["_corrupt"]) == (3, None)


def test_times_with_and_without_an_offset(spark, tmp_path):
    lines = [
        '{"dt":"2014-08-01 00:00:00","cid":1}',
        '{"dt":"2014-08-01T00:00:00.000-07:00","cid":2}',
        '{"dt":"2014-08-01T00:00:00Z","cid":3}',
        '{"dt":"noon","cid":4}',
        '{"dt":"2014-08-01 00:00:00","lat":"x","cid":5}',
        '{"cid":6}',
    ]
    (tmp_path / "t.json").write_text("\n".join(lines))
    rows = {r["cid"]: r for r in files.json_scan(spark, str(tmp_path / "t.json"), corrupt=True).collect()}
    assert [rows[i]["dt"] for i in (1, 2, 3, 4, 6)] == [MIDNIGHT] * 3 + [None, None]
    assert [rows[i]["_corrupt"] for i in (1, 2, 3, 4, 6)] == [None, None, None, "noon", None]
    assert rows[5]["_corrupt"] == lines[4]
    (tmp_path / "t.csv").write_text("2014-08-01 00:00:00,40.1,-73.9,B\n2014-08-01T00:00:00+02:00,x,-73.9,B\n")
    got = files.csv_scan(spark, str(tmp_path / "t.csv"), corrupt=True).collect()
    assert [r["dt"] for r in got] == [MIDNIGHT] * 2 and got[0]["_corrupt"] is None and got[1]["_corrupt"]


def test_wire_format(spark, sf_dir):
    row = spark.createDataFrame(
        [(MIDNIGHT, 40.5, -73.9, 3, 40.6, -74.0, "B1"), (MIDNIGHT, 40.5, -73.9, 3, 40.6, -74.0, None)],
        TRIP_ENRICHED,
    )
    got = [r["value"] for r in codec.encode_enriched(row).collect()]
    assert got == [
        '{"cid":3,"dt":"2014-08-01 00:00:00","lat":40.5,"lon":-73.9,"base":"B1",'
        '"clat":40.6,"clon":-74.0}',
        '{"cid":3,"dt":"2014-08-01 00:00:00","lat":40.5,"lon":-73.9,"clat":40.6,"clon":-74.0}',
    ]
    items = spark.createDataFrame([(0, 0), (7, 8)], "id int, value int")
    assert [r["value"] for r in codec.encode_items(items).collect()] == [
        '{"id":"0","value":"0"}',
        '{"id":"7","value":"8"}',
    ]


def test_json_map(spark):
    got = _messages(spark, '{"a":"x","b":2}').select(codec.json_to_map(F.col("value"))).first()[0]
    assert got == {"a": "x", "b": "2"}


@pytest.mark.parametrize(
    "value, want",
    [
        ("a b  ", ["a", "b"]),
        ("", [""]),
        (" ", []),
        (" a  b", ["", "a", "", "b"]),
        ("a\tb\n c", ["a\tb\n", "c"]),
    ],
)
def test_words(spark, value, want):
    assert _messages(spark, value).select(text.words("value")).first()[0] == want


def test_rowkey_prints_null(spark):
    df = spark.createDataFrame([(1, None, "t")], "cid int, base string, dt string")
    assert df.select(text.rowkey("cid", "base", "dt")).first()[0] == "1_null_t"


def test_key_predicates(spark):
    df = spark.createDataFrame(
        [(k,) for k in ("0_B", "1_B", "2_B", "10_B", "11_B", "19_B", "20_B", "x")], "key string"
    )

    def keys(cond):
        return {r["key"] for r in df.where(cond).collect()}

    assert keys(text.key_at_most("key", "11")) == {"0_B", "10_B"}
    assert keys(text.key_of_cluster("key", 2)) == {"2_B"}
    assert keys(text.key_has_prefix("key", "2")) == {"2_B", "20_B"}
    assert keys(text.key_cluster("key") < 11) == {"0_B", "1_B", "2_B", "10_B"}


def test_sorted_json_is_in_global_order_and_modes_apply(spark, sf_dir, tmp_path):
    path = str(tmp_path / "out")
    source = conform(queries.clustered(spark, sf_dir), TRIP_CLUSTERED)
    hot = source.unionAll(source.where("cid = 17").withColumn("dt", F.lit(MIDNIGHT)))
    files.write_json_sorted(hot, path)
    back = files.json_scan(spark, path).withColumn("f", F.input_file_name())
    spans = sorted(
        back.groupBy("f").agg(F.min("dt").alias("lo"), F.max("dt").alias("hi")).collect(),
        key=lambda r: r["f"],
    )
    assert all(a["hi"] <= b["lo"] for a, b in zip(spans, spans[1:]))
    assert back.drop("f").exceptAll(hot).isEmpty() and back.count() == hot.count()
    with pytest.raises(Exception, match="(?i)exists"):
        files.write_json_sorted(hot, path)
    files.write_json_sorted(hot, path, mode="overwrite")


def test_identical_rows_are_spread_by_the_sorted_write(spark, tmp_path):
    one = "timestamp_ntz'2014-08-01 00:00:00' AS dt, 40.5D AS lat, -73.9D AS lon, 1 AS cid, 'B' AS base"
    copies = spark.range(40_000).selectExpr(*one.split(", "))
    with_conf = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files.write_json_sorted(copies, str(tmp_path / "copies"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", with_conf)
    sizes = [
        r["count"]
        for r in files.json_scan(spark, str(tmp_path / "copies"))
        .groupBy(F.input_file_name())
        .count()
        .collect()
    ]
    assert sum(sizes) == 40_000 and max(sizes) < 15_000
