"""Command line for spark-submit: one subcommand per job.

    spark-submit kerbline/cli.py enrich --model M --source IN --target OUT --checkpoint CP

Topics are folders unless ``--kind kafka`` is given; connector settings go in
``--option name=value``.
"""

import argparse
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from kerbline.functions import text  # noqa: E402
from kerbline.operators import clustering  # noqa: E402
from kerbline.plans import batch_jobs  # noqa: E402
from kerbline.schemas import TRIP_CATALOG  # noqa: E402
from kerbline.session import get_spark  # noqa: E402
from kerbline.sources import count_log, keyed_table, topics  # noqa: E402
from kerbline.streaming import jobs, run, totals  # noqa: E402


def _source(spark, args, position=False):
    return topics.subscribe(spark, args.source, args.kind, position, **args.option)


def _trips(spark, args, handlers, position=False):
    """Good enriched messages to the handlers, the others to the dead-letter topic."""
    decoded = jobs.decoded_enriched(_source(spark, args, position), args.strict)
    dead = args.dead or jobs.rejected(args.target)
    _finish(jobs.with_dead_letters(decoded, handlers, dead, args.checkpoint, args.kind, **args.option), args)


def _finish(writer, args):
    query = run.start(writer, args.once, args.interval)
    query.awaitTermination()
    return query


def train(spark, args):
    model, made = batch_jobs.train_and_report(
        spark,
        args.trips,
        args.model,
        args.json,
        k=args.k,
        max_iter=args.max_iter,
        split_key=args.split_key,
        cache=args.cache,
        mode=args.mode,
    )
    for cid, (lat, lon) in enumerate(clustering.centers_of(model)):
        print(f"center {cid}: {lat}, {lon}")
    print(f"training cost: {clustering.training_cost(model)}")
    _show(made)


def report(spark, args):
    _show(batch_jobs.report_json(spark, args.json))


def _show(made):
    for name, df in made.items():
        print(name)
        df.show()


def enrich(spark, args):
    centers = clustering.centers_of(clustering.load_model(args.model))
    writer = jobs.enrich(
        _source(spark, args),
        centers,
        args.target,
        args.checkpoint,
        args.kind,
        dead=args.dead,
        in_order=args.sorted,
        strict=args.strict,
        **args.option,
    )
    _finish(writer, args)


def reject(spark, args):
    _finish(
        jobs.reject_lines(
            _source(spark, args), args.target, args.checkpoint, args.kind, **args.option
        ),
        args,
    )


def batch_counts(spark, args):
    _trips(spark, args, [jobs.write_batch_counts(args.target)])


def batch_report(spark, args):
    report = jobs.batch_report(spark, args.counts, args.report)
    report.orderBy("batch_id", *[c for c in ("window_start", "hr", "cid") if c in report.columns]).show(args.rows)


def window_counts(spark, args):
    if args.watermark:
        counts = jobs.windows_with_watermark(jobs.decode_enriched(_source(spark, args)), args.watermark)
        keys = ("cid", "window_start", "window_end")
        with totals.listening(spark) as sums:
            query = _finish(jobs.keep_totals(counts, keys, args.target, args.checkpoint), args)
            found = sums.of(query)
        print(f"groups of rows dropped as later than {args.watermark}: {found.get(totals.DROPPED, 0)}")
    else:
        _trips(spark, args, [jobs.write_batch_counts(args.target)])
        jobs.window_totals(spark, args.target).orderBy("window_start", "cid").show()


def word_count(spark, args):
    _finish(jobs.batch_word_counts(_source(spark, args), args.target, args.checkpoint), args)
    jobs.word_totals(spark, args.target).orderBy("count", ascending=False).show()


def upsert(spark, args):
    handlers = [jobs.write_puts(args.target)]
    if args.counts:
        handlers.append(jobs.write_batch_counts(args.counts))
    _trips(spark, args, handlers, position=True)


def scan(spark, args):
    catalog = Path(args.catalog).read_text() if args.catalog else TRIP_CATALOG
    rows = keyed_table.scan_catalog(spark, args.table, catalog)
    key = rows.columns[0]
    if args.at_most is not None:
        rows = rows.where(text.key_at_most(key, args.at_most))
    if args.prefix is not None:
        rows = rows.where(text.key_has_prefix(key, args.prefix))
    if args.cluster is not None:
        rows = rows.where(text.key_of_cluster(key, args.cluster))
    rows.show(args.rows, truncate=False)


def compact(spark, args):
    keyed_table.copy_current(spark, args.table, args.target)


def compact_counts(spark, args):
    count_log.copy_totals(spark, args.counts, args.target, args.columns.split(","))


def produce(spark, args):
    items = jobs.constant_items(spark, args.count)
    _finish(
        jobs.publish_items(items, args.target, args.checkpoint, args.kind, **args.option), args
    )


def replay(spark, args):
    writer = jobs.replay(
        spark,
        args.folder,
        args.target,
        args.checkpoint,
        args.files_per_batch,
        args.kind,
        **args.option,
    )
    _finish(writer, args)


def tail(spark, args):
    _finish(jobs.tail(_source(spark, args), args.checkpoint, args.rows), args)


def _pair(value):
    name, _, setting = value.partition("=")
    return name, setting


def parser():
    root = argparse.ArgumentParser(prog="kerbline")
    commands = root.add_subparsers(required=True)

    def command(name, job, *required):
        sub = commands.add_parser(name)
        sub.set_defaults(job=job)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        return sub

    def stream(name, job, *required):
        sub = command(name, job, "checkpoint", *required)
        sub.add_argument("--kind", choices=["file", "kafka"], default="file")
        sub.add_argument("--option", type=_pair, action="append", default=[])
        sub.add_argument("--once", action="store_true", help="stop at the end of the data")
        sub.add_argument("--interval", default=run.BATCH_INTERVAL)
        return sub

    sub = command("train", train, "trips", "model", "json")
    sub.add_argument("--k", type=int, default=20)
    sub.add_argument("--max-iter", type=int, default=5)
    sub.add_argument("--mode", default="errorifexists")
    sub.add_argument("--split-key", help="column to split by; the whole row otherwise")
    sub.add_argument("--cache", action="store_true")
    command("report", report, "json")

    def trip_stream(name, job, *required):
        sub = stream(name, job, *required)
        sub.add_argument("--dead", help="topic for messages that do not decode; target with -rejected otherwise")
        sub.add_argument("--strict", action="store_true", help="fail on a message that does not decode")
        return sub

    sub = trip_stream("enrich", enrich, "model", "source", "target")
    sub.add_argument("--sorted", action="store_true")
    stream("reject", reject, "source", "target")
    trip_stream("batch-counts", batch_counts, "source", "target")
    sub = command("batch-report", batch_report, "counts")
    sub.add_argument("--report", choices=["cluster", "hour", "windows"], default="cluster")
    sub.add_argument("--rows", type=int, default=20)
    sub = trip_stream("window-counts", window_counts, "source", "target")
    sub.add_argument("--watermark", help="keep windows in bounded state and drop rows later than this")
    stream("word-count", word_count, "source", "target")
    trip_stream("upsert", upsert, "source", "target").add_argument("--counts")
    sub = command("scan", scan, "table")
    sub.add_argument("--catalog", help="file with a JSON catalog")
    sub.add_argument("--at-most")
    sub.add_argument("--prefix")
    sub.add_argument("--cluster", type=int)
    sub.add_argument("--rows", type=int, default=20)
    command("compact", compact, "table", "target")
    sub = command("compact-counts", compact_counts, "counts", "target")
    sub.add_argument("--columns", default="n_rows,n_cid", help="columns that add up")
    stream("produce", produce, "target").add_argument("--count", type=int, default=jobs.ITEM_COUNT)
    stream("replay", replay, "folder", "target").add_argument("--files-per-batch", type=int)
    stream("tail", tail, "source").add_argument("--rows", type=int, default=20)
    return root


def main(argv=None):
    args = parser().parse_args(argv)
    if hasattr(args, "option"):
        args.option = dict(args.option)
    args.job(get_spark(), args)


if __name__ == "__main__":
    main()
