"""Record layouts and the fixed values every other module shares."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. Names, constants and formats that have to match the data
# already stored and sent by the feeds; they are not tunable.
# ---------------------------------------------------------------------------

# seconds per bucket and row keys per second
BUCKET_SECONDS = 300
KEYS_PER_SECOND = 1000

# currency pair and words the roll-ups look for; words the post feed tracks
PAIR = "USDT_BTC"
KEYWORDS = {"btc": "BTC", "bitcoin": "Bitcoin"}
TRACK_WORDS = ("bitcoin", "btc")

# raw cells: family, then qualifier -> column of the typed table
POST_FAMILY = "Twitter"
POST_CELLS = {
    "followers_count": "followers",
    "friends_count": "friends",
    "status": "statuses",
    "text": "text",
    "screenname": "screen_name",
    "language": "language",
    "location": "location",
    "created": "created",
}
TICK_FAMILY = "CurrencyRate"
TICK_CELLS = {
    "currencypair": "pair",
    "last": "last",
    "lowestask": "lowest_ask",
    "highestbid": "highest_bid",
    "percentchange": "percent_change",
    "basevolume": "base_volume",
    "quotevolume": "quote_volume",
    "isfrozen": "is_frozen",
    "24high": "high_24h",
    "24low": "low_24h",
}
CHAT_FAMILY = "Trollbox"
CHAT_CELLS = {"troll": "user", "trollmessage": "message"}

# calculated cells: family:qualifier -> column of the calculated table
CALC_CELLS = {
    "Twitter:Messages": "messages",
    "Twitter:BTC": "btc",
    "Twitter:Bitcoin": "bitcoin",
    "CurrencyRate:last": "last",
}

# number of fields in a post and of items in a tick or chat tuple
POST_FIELDS = 8
TICK_ITEMS = 11
CHAT_ITEMS = 6

# micro-batch interval of the landing jobs
TRIGGER_INTERVAL = "5 minutes"

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

#: one message as every source delivers it
MESSAGE_SCHEMA = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

#: where a message came from; unique for every message
IDENTITY = ("topic", "partition", "offset")

#: one stored cell as JSON text
CELL_SCHEMA = T.StructType([
    T.StructField("row", T.StringType()),
    T.StructField("columnFamily", T.StringType()),
    T.StructField("qualifier", T.StringType()),
    T.StructField("value", T.StringType()),
])

#: calculated table
CALC_SCHEMA = T.StructType([
    T.StructField("key", T.LongType()),
    T.StructField("messages", T.LongType()),
    T.StructField("btc", T.LongType()),
    T.StructField("bitcoin", T.LongType()),
    T.StructField("last", T.DoubleType()),
])

CALC_VALUES = ("messages", "btc", "bitcoin", "last")


#: refused messages
REJECT_SCHEMA = (
    "topic STRING, partition INT, offset BIGINT, value STRING, reason STRING, "
    "source STRING, part STRING"
)
#: rows per second and part
SECOND_SCHEMA = "topic STRING, epoch_s BIGINT, n BIGINT, day DATE, part STRING"
#: ranges of offsets that were looked at, both ends included
COVERED_SCHEMA = "topic STRING, partition INT, start BIGINT, stop BIGINT, part STRING"


@dataclass(frozen=True)
class Feed:
    """A raw feed: its table name, cell family, cell columns, time column, the
    types of its own columns, and which of them are read as numbers.

    Where the text of a number is not what the number would be written as, ``texts`` keeps
    the texts of all of them, in the order of ``numbers``.
    """

    name: str
    family: str
    cells: dict[str, str]
    time: str
    columns: str
    numbers: tuple[str, ...] = ()

    @property
    def schema(self) -> str:
        """Schema of the landed table."""
        return (
            "topic STRING, partition INT, offset BIGINT, "
            f"{self.columns}, texts ARRAY<STRING>, epoch_s BIGINT, row_key BIGINT, day DATE, part STRING"
        )


POSTS = Feed(
    "posts",
    POST_FAMILY,
    POST_CELLS,
    "created",
    "followers BIGINT, friends BIGINT, statuses BIGINT, text STRING, screen_name STRING, "
    "language STRING, location STRING, created TIMESTAMP_NTZ",
    ("followers", "friends", "statuses"),
)
TICKS = Feed(
    "ticks",
    TICK_FAMILY,
    TICK_CELLS,
    "ts",
    "pair STRING, last DOUBLE, lowest_ask DOUBLE, highest_bid DOUBLE, percent_change DOUBLE, "
    "base_volume DOUBLE, quote_volume DOUBLE, is_frozen INT, high_24h DOUBLE, low_24h DOUBLE, "
    "ts TIMESTAMP_NTZ",
    (
        "last", "lowest_ask", "highest_bid", "percent_change", "base_volume", "quote_volume",
        "is_frozen", "high_24h", "low_24h",
    ),
)
CHATS = Feed(
    "chats", CHAT_FAMILY, CHAT_CELLS, "ts", "user STRING, message STRING, ts TIMESTAMP_NTZ"
)
FEEDS = {feed.name: feed for feed in (POSTS, TICKS, CHATS)}
