"""Batch jobs: replay old messages, send new ones, roll buckets up, show the history."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsebar.layout import BUCKET_SECONDS, KEYWORDS, PAIR, TRACK_WORDS, TRIGGER_INTERVAL, Feed
from pulsebar.operators import calc, ledger, parse
from pulsebar.operators import produce as produce_
from pulsebar.sources import series, tables
from pulsebar.sources.workdir import new_folder, remove


def backfill(
    messages: DataFrame,
    feed: Feed,
    root: str,
    start: int | None = None,
    stop: int | None = None,
    zone: str = "UTC",
    resume: bool = False,
) -> None:
    """Land the messages with ``start < epoch_s <= stop`` from a replay, in one commit.

    ``resume`` leaves out the offsets that were landed or refused before, by whichever job, and lands all
    others: what an earlier range left out, and what lies before offsets a stream has seen. Running a backfill
    again lands no message twice: one that is there stays, and one that is there with other content is
    replaced where it lies. Messages are parsed once, into a staged table that goes when the job is done.
    """
    spark = messages.sparkSession
    seen = tables.log_of(spark, root, feed).read()
    tables.check_zone(seen, feed, zone)
    if resume:
        messages = ledger.outside(messages, tables.read_covered(spark, root, feed))
    parsed = parse.without_read_text(parse.parse(messages, feed, zone))
    wanted = F.lit(True)
    if start is not None:
        wanted &= F.col("epoch_s") > start
    if stop is not None:
        wanted &= F.col("epoch_s") <= stop
    stage, counted = new_folder(spark, f"backfill-{feed.name}"), Observation()
    kept = parsed.where(F.col("reason").isNotNull() | wanted)
    try:
        kept.observe(counted, F.count("reason").alias("refused")).write.parquet(stage)
        staged = spark.read.schema(parsed.schema).parquet(stage)
        tables.land_parsed(staged, feed, root, zone, counted.get["refused"], replace=True)
    finally:
        remove(spark, stage)


def produce(
    rows: DataFrame, feed: Feed, put: Callable[[DataFrame], None], checkpoint: str, zone: str = "UTC",
    words: tuple[str, ...] = TRACK_WORDS, trigger: dict | None = None,
) -> StreamingQuery:
    """Send a stream of source rows as messages: ``put`` takes each batch of them.

    A batch that was cut off is sent again, so a message may be sent twice.
    """

    def send_batch(batch: DataFrame, number: int) -> None:
        put(produce_.messages(batch, feed, zone, words))

    return (
        rows.writeStream.queryName(f"produce-{feed.name}")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER_INTERVAL}))
        .foreachBatch(send_batch)
        .start()
    )


def roll_up_social(
    spark: SparkSession, root: str, start: int, stop: int, keywords: dict[str, str] = KEYWORDS, width: int = BUCKET_SECONDS
) -> None:
    """Put post and keyword counts of the buckets of ``[start, stop)``."""
    series.roll_up(spark, root, series.social(keywords, width), start, stop)


def roll_up_price(
    spark: SparkSession, root: str, start: int, stop: int, pair: str = PAIR, width: int = BUCKET_SECONDS
) -> None:
    """Put sums and counts of prices of the buckets of ``[start, stop)``."""
    series.roll_up(spark, root, series.price(pair, width), start, stop)


def history(
    spark: SparkSession, root: str, start: int, stop: int, zone: str = "UTC", counts: series.Series | None = None,
    prices: series.Series | None = None, keep: str = "matched", width: int | None = None,
) -> DataFrame:
    """Calculated buckets of ``[start, stop)``, gaps as 0, with local time. See ``series.read_calc`` for the rest."""
    table = series.read_calc(spark, root, start, stop, counts, prices, keep, width)
    return calc.history(table, start, stop, zone)
