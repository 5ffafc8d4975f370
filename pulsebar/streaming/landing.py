"""Lands a feed's messages as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from pulsebar.layout import TRIGGER_INTERVAL, Feed
from pulsebar.operators import parse
from pulsebar.sources import tables
from pulsebar.sources.workdir import folders, make_folder

LIVE = {"processingTime": TRIGGER_INTERVAL}
#: work through what is there and stop
CATCH_UP = {"availableNow": True}


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The run a checkpoint belongs to. It is kept inside, so it goes when the checkpoint goes."""
    known = [name for name in folders(spark, checkpoint) if name.startswith("run=")]
    if not known:
        known = [f"run={tables.new_run()}"]
        make_folder(spark, f"{checkpoint}/{known[0]}")
    return known[0].removeprefix("run=")


def land(
    messages: DataFrame,
    feed: Feed,
    root: str,
    zone: str = "UTC",
    trigger: dict = LIVE,
    source: str = "main",
) -> StreamingQuery:
    """Start landing a stream of messages under ``root``.

    A restart goes on from the checkpoint kept beside the tables. A batch that
    was cut off before its commit has left nothing and is landed again.
    ``source`` names the topic or folder, so that two of one feed have checkpoints of their own.
    """
    spark = messages.sparkSession
    tables.check_zone(tables.log_of(spark, root, feed).read(), feed, zone)
    checkpoint = f"{root}/checkpoints/land-{feed.name}-{source}"
    run = run_of(spark, checkpoint)

    def land_batch(batch: DataFrame, number: int) -> None:
        write_batch(batch, number, feed, root, zone, run)

    return (
        messages.writeStream.queryName(f"land-{feed.name}-{source}")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(land_batch)
        .start()
    )


def write_batch(
    batch: DataFrame, number: int, feed: Feed, root: str, zone: str = "UTC", run: str = "single"
) -> None:
    """Parse, key and land one batch in one commit, but for messages another run or a backfill has landed.

    A second may go on over batches, late or after a restart. How many rows of
    it came earlier stands in the ``seconds`` table, one small row per second,
    so numbering needs no state in the stream and never drops a late row. A batch that comes again is
    known by its run and number and left out.
    """
    # parsed once and used several times
    parsed = parse.without_read_text(parse.parse(batch, feed, zone))
    parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counted = parsed.agg(F.count(F.lit(1)).alias("rows"), F.count("reason").alias("refused")).first()
        if counted.rows:
            tables.land_parsed(parsed, feed, root, zone, counted.refused, (run, number))
    finally:
        parsed.unpersist()
