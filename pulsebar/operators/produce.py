"""Source rows to messages: filter, arrival time, wire text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsebar.functions import clock, wire
from pulsebar.functions.text import tracked
from pulsebar.layout import CHATS, POSTS, TICKS, TRACK_WORDS, Feed

POST_ROW = ("followers", "friends", "statuses", "text", "screen_name", "language", "location", "created")
TICK_ROW = (
    "pair", "last", "lowest_ask", "highest_bid", "percent_change", "base_volume", "quote_volume",
    "is_frozen", "high_24h", "low_24h",
)
CHAT_ROW = ("kind", "number", "user", "message", "reputation")


def messages(
    rows: DataFrame, feed: Feed, zone: str = "UTC", words: tuple[str, ...] = TRACK_WORDS, arrived: Column | None = None
) -> DataFrame:
    """The rows with their wire text as ``value``.

    Posts are kept where they hold one of ``words``. Ticks and chats get the time they arrive,
    now, as a wall clock of ``zone``, unless ``arrived`` gives another.
    """
    arrived = clock.now(zone) if arrived is None else arrived
    if feed is POSTS:
        return rows.where(tracked(F.col("text"), words)).withColumn("value", wire.encode_post(*map(F.col, POST_ROW)))
    if feed is TICKS:
        return rows.withColumn("value", wire.encode_tick(*map(F.col, TICK_ROW), arrived=arrived))
    if feed is CHATS:
        return rows.withColumn("value", wire.encode_chat(*map(F.col, CHAT_ROW), arrived=arrived))
    raise ValueError(f"unknown feed {feed}")
