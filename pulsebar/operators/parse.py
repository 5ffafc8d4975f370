"""Messages to typed rows, with the reason a message is refused."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsebar.functions import clock, wire
from pulsebar.layout import CHATS, IDENTITY, POSTS, TICKS, Feed

FIELD_COUNT = "field_count"
TIME = "time"


def parse(messages: DataFrame, feed: Feed, zone: str = "UTC") -> DataFrame:
    """Typed columns of every message plus ``epoch_s``, ``day`` and ``reason``.

    ``reason`` is null for a good message, ``field_count`` where the number or
    shape of the fields is wrong and ``time`` where the time text is no time.
    ``zone`` is where the feed's wall clock runs. A number that cannot be read is null, and
    ``texts`` keeps what the message said (see ``Feed``).
    """
    value = F.col("value")
    pieces = F.col("pieces")
    splitter = wire.split_post if feed is POSTS else wire.tuple_items
    # A projected split would be copied into every filter pushed below it and
    # run once per use. A generator of one row is a step filters stay above.
    split = messages.select(*IDENTITY, "value", F.explode(F.array(splitter(value))).alias("pieces"))
    if feed is POSTS:
        columns, shape = wire.post_columns(pieces), wire.post_shape(pieces)
    elif feed is TICKS:
        columns, shape = wire.tick_columns(pieces), wire.tick_shape(value, pieces)
    elif feed is CHATS:
        columns, shape = wire.chat_columns(pieces), wire.chat_shape(value, pieces)
    else:
        raise ValueError(f"unknown feed {feed}")
    # the same for the time, which the checks and the keys both ask for
    timed = split.withColumn(feed.time, F.explode(F.array(columns.pop(feed.time))))
    typed = timed.select(
        *IDENTITY,
        "value",
        F.coalesce(shape, F.lit(False)).alias("shaped"),
        *[column.alias(name) for name, column in columns.items()],
        feed.time,
    )
    typed = typed.withColumn("texts", _differing(feed) if feed.numbers else F.lit(None).cast("array<string>"))
    when = F.col(feed.time)
    return (
        typed.withColumn(
            "reason", F.when(~F.col("shaped"), FIELD_COUNT).when(when.isNull(), TIME)
        )
        .withColumn("epoch_s", clock.epoch_seconds(when, zone))
        .withColumn("day", clock.day_of(F.col("epoch_s")))
        .drop("shaped")
    )


def _differing(feed: Feed) -> Column:
    """The texts of the numbers, or null where all are what the numbers would be written as."""
    same = [
        F.coalesce(F.col(name).cast("string"), F.lit("")) == F.coalesce(F.get("texts", place), F.lit(""))
        for place, name in enumerate(feed.numbers)
    ]
    return F.when(~reduce(and_, same), F.col("texts"))


def accepted(parsed: DataFrame) -> DataFrame:
    """The good rows of a parsed feed."""
    return parsed.where("reason IS NULL").drop("value", "reason")


def rejects(parsed: DataFrame, feed: Feed) -> DataFrame:
    """The refused messages of a parsed feed, whole, with the reason."""
    return parsed.where("reason IS NOT NULL").select(
        F.lit(feed.name).alias("source"), *IDENTITY, "value", "reason"
    )


def without_read_text(parsed: DataFrame) -> DataFrame:
    """A parsed feed to be kept for a while: good rows need their text no more."""
    return parsed.withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value")))
