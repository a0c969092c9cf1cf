"""The jobs end to end through the command line."""

from kerbline import cli
from kerbline.plans import queries
from kerbline.sources import files, keyed_table, topics
from kerbline.streaming import jobs


def test_pipeline(spark, sf_dir, tmp_path, capfd):
    d = str(tmp_path)
    trips = queries.trips(spark, sf_dir).select("dt", "lat", "lon", "base")
    blank = trips.limit(3).selectExpr("dt", "cast(null as double) AS lat", "lon", "base")
    files.write_csv(trips.unionAll(blank), f"{d}/csv")
    n = trips.count()

    def run(line, **extra):
        argv = line.format(d=d).split()
        cli.main(argv + [a for k, v in extra.items() for a in (f"--{k}", v)])

    run("train --trips {d}/csv --model {d}/model --json {d}/json --k 8 --max-iter 1 --cache")
    shown = capfd.readouterr().out
    assert "center 7: " in shown and "training cost: " in shown
    run("train --trips {d}/csv --model {d}/model2 --json {d}/json2 --k 3 --max-iter 1 --split-key base")
    run("report --json {d}/json")
    run("replay --once --folder {d}/csv --target {d}/lines --checkpoint {d}/cp0")
    for variant in ("enrich --once", "enrich --sorted --once"):
        out = "sorted" if "sorted" in variant else "out"
        run(
            variant + " --model {d}/model --source {d}/lines --target {d}/" + out
            + " --checkpoint {d}/cp-" + out
        )
        assert jobs.decode_enriched(topics.read(spark, f"{d}/{out}")).count() == n
        assert topics.read(spark, f"{d}/{out}-rejected").count() == 3
    run("reject --once --source {d}/lines --target {d}/dead --checkpoint {d}/cp2")
    source = " --once --source {d}/out --checkpoint {d}/cp-"
    run("batch-counts --target {d}/bc" + source + "bc")
    capfd.readouterr()
    run("batch-report --counts {d}/bc --report hour")
    assert "batch_id" in capfd.readouterr().out
    run("window-counts --target {d}/wc0" + source + "wc0")
    run("compact-counts --counts {d}/wc0 --target {d}/wc0-copy")
    run("window-counts --target {d}/wc" + source + "wc", watermark="1 day")
    assert "dropped as later than 1 day: 0" in capfd.readouterr().out
    run("word-count --target {d}/words" + source + "words")
    run("upsert --target {d}/kv --counts {d}/kvc" + source + "kv")
    run("upsert --target {d}/kv2" + source + "kv2")
    run("compact --table {d}/kv --target {d}/kvx")
    one, two = keyed_table.latest(spark, f"{d}/kvx"), keyed_table.latest(spark, f"{d}/kv2")
    assert one.select("rowkey").exceptAll(two.select("rowkey")).isEmpty() and one.count() == two.count()
    capfd.readouterr()
    run("scan --table {d}/kvx --cluster 2 --rows 1")
    assert "|2_" in capfd.readouterr().out
    run("scan --table {d}/kvx --at-most 11 --prefix 0")
    run("produce --once --target {d}/items --checkpoint {d}/cp-items")
    assert topics.read(spark, f"{d}/items").count() == 10
    run("tail --once --source {d}/items --checkpoint {d}/cp-tail")
