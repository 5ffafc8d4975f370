"""Command line of the jobs: ``spark-submit <this file> <job> ...``.

    produce FEED       send source rows as messages
    land FEED          land a feed's messages as they arrive
    backfill FEED      land a feed's old messages
    rollup SERIES      put bucket values over landed rows
    live SERIES        put bucket values from the messages as they arrive
    recount SERIES     count the buckets again that landed rows have touched since the last time
    history            write or show calculated buckets
    fold SERIES        fold the many small writes of a live roll-up, day by day
    compact FEED       pack the small files of landed tables
    sweep FEED         delete files of landed tables that nothing refers to any more
"""

from __future__ import annotations

import argparse
import os
import sys
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

if __package__ in (None, ""):  # run as a file
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pulsebar.layout import BUCKET_SECONDS, FEEDS, KEYWORDS, PAIR, TRACK_WORDS
from pulsebar.operators import parse
from pulsebar.plans import jobs
from pulsebar.sources import messages, series, tables
from pulsebar.streaming import landing
from pulsebar.streaming import rollup as stream_rollup

SERIES = (series.SOCIAL, series.PRICE)


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="pulsebar", description=__doc__.splitlines()[0])
    jobs_ = parser.add_subparsers(dest="job", required=True)

    root = argparse.ArgumentParser(add_help=False)
    root.add_argument("--root", required=True, help="folder of the tables")
    source = argparse.ArgumentParser(add_help=False)
    source.add_argument("--servers", help="message brokers")
    source.add_argument("--topic", help="topic to read")
    source.add_argument("--tasks", type=int, help="read the topic in at least that many tasks")
    source.add_argument("--per-batch", type=int, help="most messages of a topic in one batch")
    source.add_argument("--path", help="folder of message files instead of a topic")
    source.add_argument("--format", default="parquet", help="format of the files")
    source.add_argument("--zone", default="UTC", help="where the feed's clock runs")
    span = argparse.ArgumentParser(add_help=False)
    span.add_argument("--start", type=int, required=True, help="first second")
    span.add_argument("--stop", type=int, required=True, help="second to stop before")

    shape = argparse.ArgumentParser(add_help=False)
    shape.add_argument("--pair", default=PAIR, help="pair whose price is averaged")
    shape.add_argument("--word", action="append", help="btc=TEXT or bitcoin=TEXT: what a post has to hold")
    shape.add_argument("--width", type=int, default=BUCKET_SECONDS, help="seconds in a bucket")

    produce = jobs_.add_parser("produce")
    produce.add_argument("feed", choices=FEEDS)
    produce.add_argument("--rows", required=True, help="folder of parquet files with the feed's source columns")
    produce.add_argument("--servers", help="message brokers")
    produce.add_argument("--topic", help="topic to send to")
    produce.add_argument("--out", help="folder of message files instead of a topic")
    produce.add_argument("--checkpoint", required=True, help="folder for the progress")
    produce.add_argument("--track", action="append", help="word a post must hold one of")
    produce.add_argument("--zone", default="UTC", help="where the feed's clock runs")
    produce.add_argument("--once", action="store_true", help="stop when all there is has been sent")
    land = jobs_.add_parser("land", parents=[root, source])
    land.add_argument("feed", choices=FEEDS)
    land.add_argument("--once", action="store_true", help="stop when all there is has been read")
    backfill = jobs_.add_parser("backfill", parents=[root, source])
    backfill.add_argument("feed", choices=FEEDS)
    backfill.add_argument("--start", type=int, help="land what is later than this second")
    backfill.add_argument("--stop", type=int, help="and not later than this one")
    backfill.add_argument("--resume", action="store_true", help="land the offsets no job has landed or refused yet")
    rollup = jobs_.add_parser("rollup", parents=[root, span, shape])
    rollup.add_argument("series", choices=SERIES)
    live = jobs_.add_parser("live", parents=[root, source, shape])
    live.add_argument("series", choices=SERIES)
    live.add_argument("--delay", default=stream_rollup.DELAY, help="how late a row may come and still be counted")
    live.add_argument("--once", action="store_true", help="stop when all there is has been read")
    recount = jobs_.add_parser("recount", parents=[root, shape])
    recount.add_argument("series", choices=SERIES)
    fold = jobs_.add_parser("fold", parents=[root])
    fold.add_argument("series", choices=SERIES)
    for upkeep in ("compact", "sweep"):
        jobs_.add_parser(upkeep, parents=[root]).add_argument("feed", choices=FEEDS)
    history = jobs_.add_parser("history", parents=[root, span])
    history.add_argument("--zone", default="UTC", help="zone of the shown times")
    history.add_argument("--keep", choices=("matched", "all"), default="matched", help="buckets where every word occurs, or all")
    history.add_argument("--pair", help="pair whose price is shown, if several are stored")
    history.add_argument("--word", action="append", help="btc=TEXT or bitcoin=TEXT: whose counts are shown, if several are stored")
    history.add_argument("--base", type=int, default=BUCKET_SECONDS, help="with --pair or --word: seconds in a stored bucket")
    history.add_argument("--width", type=int, help="fold buckets into larger ones of so many seconds")
    history.add_argument("--out", help="folder to write all buckets to, as CSV with names")
    history.add_argument("--rows", type=int, default=20, help="rows to preview where nothing is written")
    return parser


def _source(args: argparse.Namespace) -> tuple[str, dict[str, str]]:
    if args.path:
        return args.format, {"path": args.path}
    if not (args.servers and args.topic):
        raise SystemExit("give --servers and --topic, or --path")
    return messages.KAFKA, messages.broker_options(
        args.servers, args.topic, args.tasks, args.per_batch
    )


def _words(args: argparse.Namespace) -> dict[str, str]:
    given = dict(word.split("=", 1) for word in args.word or ())
    if not given.keys() <= KEYWORDS.keys():
        raise SystemExit(f"--word takes {' or '.join(KEYWORDS)}")
    return KEYWORDS | given


def _series(args: argparse.Namespace) -> series.Series:
    if args.series == series.PRICE:
        return series.price(args.pair, args.width)
    return series.social(_words(args), args.width)


def _produce(args: argparse.Namespace, spark: SparkSession) -> None:
    if not (args.out or args.servers and args.topic):
        raise SystemExit("give --servers and --topic, or --out")
    schema = spark.read.parquet(args.rows).schema
    rows = spark.readStream.schema(schema).parquet(args.rows)

    def put(batch: DataFrame) -> None:
        if args.out:
            messages.keep(batch, args.out)
        else:
            messages.send(batch, args.servers, args.topic)

    trigger = landing.CATCH_UP if args.once else landing.LIVE
    words = tuple(args.track or TRACK_WORDS)
    jobs.produce(rows, FEEDS[args.feed], put, args.checkpoint, args.zone, words, trigger).awaitTermination()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _arguments().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"pulsebar-{args.job}").getOrCreate()
    if args.job == "produce":
        _produce(args, spark)
    elif args.job == "rollup":
        series.roll_up(spark, args.root, _series(args), args.start, args.stop)
    elif args.job == "recount":
        series.recount(spark, args.root, _series(args))
    elif args.job == "fold":
        for one in series.stored(spark, args.root, args.series):
            series.fold(spark, args.root, one)
    elif args.job == "compact":
        tables.compact(spark, args.root, FEEDS[args.feed])
    elif args.job == "sweep":
        tables.sweep(spark, args.root, FEEDS[args.feed])
    elif args.job == "history":
        counts = series.social(_words(args), args.base) if args.word else None
        prices = series.price(args.pair, args.base) if args.pair else None
        shown = jobs.history(spark, args.root, args.start, args.stop, args.zone, counts, prices, args.keep, args.width)
        if args.out:
            shown.write.mode("errorifexists").option("header", True).csv(args.out)
        else:
            shown.show(args.rows, truncate=False)
    elif args.job == "backfill":
        fmt, options = _source(args)
        old = messages.read_messages(spark, fmt, **options)
        jobs.backfill(old, FEEDS[args.feed], args.root, args.start, args.stop, args.zone, args.resume)
    else:
        fmt, options = _source(args)
        new = messages.stream_messages(spark, fmt, **options)
        trigger = landing.CATCH_UP if args.once else landing.LIVE
        if args.job == "land":
            source = quote(args.topic or args.path.rstrip("/").rpartition("/")[2], safe="")
            query = landing.land(new, FEEDS[args.feed], args.root, args.zone, trigger, source)
        else:
            of = _series(args)
            rows = parse.accepted(parse.parse(new, of.feed, args.zone))
            query = stream_rollup.publish(rows, args.root, of, trigger, args.delay)
        query.awaitTermination()


if __name__ == "__main__":
    main()
