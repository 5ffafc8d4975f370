"""Roll-ups of a stream: one watermarked aggregate with one state store."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsebar.layout import BUCKET_SECONDS, KEYWORDS, PAIR
from pulsebar.operators import rollup
from pulsebar.sources import series
from pulsebar.streaming.landing import LIVE

#: how late a row may come and still be counted
DELAY = "10 minutes"


def _windowed(rows: DataFrame, delay: str, width: int):
    return (
        rows.withColumn("event_time", F.timestamp_seconds("epoch_s"))
        .withWatermark("event_time", delay)
        .groupBy(F.window("event_time", f"{width} seconds"))
    )


_KEY = "unix_seconds(window.start) AS key"


def social_stream(
    posts: DataFrame,
    keywords: dict[str, str] = KEYWORDS,
    delay: str = DELAY,
    width: int = BUCKET_SECONDS,
    keep: str = "matched",
) -> DataFrame:
    """Posts and posts per word in each bucket of a stream."""
    counts = _windowed(posts, delay, width).agg(
        F.count(F.lit(1)).alias("messages"), *rollup.keyword_counts(keywords)
    )
    if keep == "matched":
        counts = rollup.matched(counts, keywords)
    return counts.selectExpr(_KEY, "messages", *keywords)


def price_stream(
    ticks: DataFrame, pair: str = PAIR, delay: str = DELAY, width: int = BUCKET_SECONDS
) -> DataFrame:
    """What the mean price of a pair is made of (see ``rollup.price_parts``) in each bucket of a stream."""
    prices = _windowed(ticks.where(F.col("pair") == pair), delay, width).agg(
        F.sum("last").alias("total"), F.count("last").alias("n"), F.count(F.lit(1)).alias("counted")
    )
    return prices.selectExpr(_KEY, "total", "n", "counted")


def series_stream(rows: DataFrame, of: series.Series, delay: str = DELAY) -> DataFrame:
    """The values of a series in each bucket of a stream of its feed's rows."""
    if of.name == series.PRICE:
        return price_stream(rows, of.of[0], delay, of.width)
    counts = social_stream(rows, dict(zip(KEYWORDS, of.of)), delay, of.width, keep="all")
    return counts.withColumn("counted", F.col("messages"))


def publish(rows: DataFrame, root: str, of: series.Series, trigger: dict = LIVE, delay: str = DELAY) -> StreamingQuery:
    """Put the buckets of a series that changed in each batch into the calculated table.

    Update mode gives a bucket its running value at once and again with every
    change; the value counted from most rows holds. Rows later than the watermark are left
    out. ``series.recount`` counts the buckets such rows have touched from the landed rows, and from then on
    its value holds, whatever the stream still says of the bucket.
    """

    def put(batch: DataFrame, number: int) -> None:
        series.put_live(batch, root, of)

    name = f"{of.name}-{zlib.crc32(repr(of).encode()):08x}"
    return (
        series_stream(rows, of, delay).writeStream.queryName(f"roll-up-{name}")
        .outputMode("update")
        .option("checkpointLocation", f"{root}/checkpoints/roll-up-{name}")
        .trigger(**trigger)
        .foreachBatch(put)
        .start()
    )
