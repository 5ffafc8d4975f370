"""The test tables seen as feeds.

``events`` stand for ticks and for short posts, ``documents`` for posts and
``conversations`` for chat. Each function gives typed rows; the ``*_messages``
functions give the same rows as wire text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsebar.functions import clock, wire
from pulsebar.layout import MESSAGE_SCHEMA

#: first second of the tables that have no time of their own
BASE = 1_704_067_200
#: seconds from one document to the next
STEP = 37
#: words and pair that occur in the tables
EVENT_WORDS = {"btc": "click", "bitcoin": "7"}
DOCUMENT_WORDS = {"btc": "The", "bitcoin": "Tion"}
EVENT_PAIR = "purchase"
TEXT_WORDS = ("license", "token")
#: events below this value are sent again, corrected
CORRECTED = 20


#: schemas of the tables read here; given, they save a look at the files
SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table read as a stream of its files."""
    # a pattern, since a stream takes a plain path for a folder
    return spark.readStream.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parque[t]")


def _identity(topic: str, offset: Column) -> list[Column]:
    return [
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        offset.cast("bigint").alias("offset"),
    ]


def _message(topic: str, offset: Column, value: Column, timestamp: Column) -> list[Column]:
    columns = [value.alias("value"), *_identity(topic, offset), timestamp.cast("timestamp").alias("timestamp")]
    assert len(columns) == len(MESSAGE_SCHEMA)
    return columns


# -- events -------------------------------------------------------------------


def event_posts(events: DataFrame) -> DataFrame:
    """Events as posts whose text is the type and the properties."""
    return events.select(
        F.concat_ws(" ", "event_type", "props").alias("text"),
        clock.civil_seconds(F.col("ts")).alias("epoch_s"),
    )


def event_post_messages(events: DataFrame) -> DataFrame:
    """The same posts as wire text."""
    plain = F.lit("")
    value = wire.encode_post(
        F.lit(0), F.lit(0), F.lit(0), F.concat_ws(" ", "event_type", "props"), plain, plain, plain, F.col("ts")
    )
    return events.select(*_message("event-posts", F.col("event_id"), value, F.col("ts")))


def event_ticks(events: DataFrame) -> DataFrame:
    """Events as ticks: the type is the pair and the value the price."""
    return events.select(
        *_identity("ticks", F.col("event_id")),
        F.col("event_type").alias("pair"),
        F.col("value").alias("last"),
        clock.civil_seconds(F.col("ts")).alias("epoch_s"),
    )


def tick_fields() -> dict[str, Column]:
    """Fields of an event's tick in wire order, prices with two decimals."""
    price = F.col("value").cast("decimal(18,2)")
    step = F.lit("1.25").cast("decimal(18,2)")
    return {
        "pair": F.col("event_type"),
        "last": price.cast("string"),
        "lowest_ask": (price + step).cast("string"),
        "highest_bid": (price - step).cast("string"),
        "percent_change": F.get_json_object("props", "$.k"),
        "base_volume": F.col("user_id").cast("string"),
        "quote_volume": F.col("event_id").cast("string"),
        "is_frozen": (F.col("event_type") == "error").cast("int"),
        "high_24h": (price + 2 * step).cast("string"),
        "low_24h": (price - 2 * step).cast("string"),
        "arrived": F.col("ts"),
    }


def tick_rows(events: DataFrame) -> DataFrame:
    """Events as tick rows, still as text, the way cells store them."""
    fields = {name: field for name, field in tick_fields().items() if name != "arrived"}
    return events.select(
        *_identity("ticks", F.col("event_id")),
        *[field.alias(name) for name, field in fields.items()],
        clock.civil_seconds(F.col("ts")).alias("epoch_s"),
    )


def corrected_ticks(events: DataFrame) -> DataFrame:
    """The events whose value is below ``CORRECTED``, sent again as ticks of another pair."""
    wrong = events.where(F.col("value") < CORRECTED)
    return tick_messages(wrong.withColumn("event_type", F.concat(F.lit("not "), "event_type")))


def tick_messages(events: DataFrame) -> DataFrame:
    value = wire.encode_tick(**tick_fields())
    return events.select(*_message("ticks", F.col("event_id"), value, F.col("ts")))


# -- documents ----------------------------------------------------------------


def _created() -> Column:
    return clock.civil_time(BASE + F.col("doc_id") * STEP)


def document_posts(documents: DataFrame) -> DataFrame:
    """Documents as posts, one every ``STEP`` seconds."""
    return documents.select("text", (BASE + F.col("doc_id") * STEP).alias("epoch_s"))


def post_rows(documents: DataFrame) -> DataFrame:
    """Documents as source rows of posts."""
    return documents.select(
        F.col("n_chars").alias("followers"),
        F.col("doc_id").alias("friends"),
        F.col("doc_id").alias("statuses"),
        "text",
        F.col("source").alias("screen_name"),
        F.col("lang").alias("language"),
        F.concat_ws(", ", "source", "lang").alias("location"),
        _created().alias("created"),
    )


def post_messages(documents: DataFrame) -> DataFrame:
    value = wire.encode_post(
        followers=F.col("n_chars"),
        friends=F.col("doc_id"),
        statuses=F.col("doc_id"),
        text=F.col("text"),
        screen_name=F.col("source"),
        language=F.col("lang"),
        location=F.concat_ws(", ", "source", "lang"),
        created=_created(),
    )
    return documents.select(*_message("posts", F.col("doc_id"), value, _created()))


def careless_post_messages(documents: DataFrame) -> DataFrame:
    """Posts from a sender that escapes no comma and, outside English, writes
    its dates with slashes."""
    created = clock.civil_text(_created())
    value = F.concat_ws(
        ",",
        F.col("n_chars").cast("string"),
        F.col("doc_id").cast("string"),
        F.col("doc_id").cast("string"),
        "text",
        "source",
        "lang",
        "source",
        F.when(F.col("lang") == "en", created).otherwise(F.replace(created, F.lit("-"), F.lit("/"))),
    )
    return documents.select(*_message("posts", F.col("doc_id"), value, _created()))


# -- conversations ------------------------------------------------------------


def chat_text() -> Column:
    """A turn's text with the characters tuple text has to quote or escape."""
    return F.concat(
        F.col("text"),
        F.when(F.col("role") == "user", " it's")
        .when(F.col("role") == "assistant", " \"it's\", 'so'\t")
        .otherwise(' c:\\new "x"'),
    )


def _chat_time() -> Column:
    return clock.civil_time(BASE + F.col("conv_id"))


def chat_messages(conversations: DataFrame, lane: Column | None = None, *more: str) -> DataFrame:
    """Turns as chat messages; the turns of a conversation share a second.

    ``lane`` gives the topic partition, and ``more`` names columns to keep.
    """
    value = wire.encode_chat(
        kind=F.lit("trollboxMessage"),
        number=F.col("conv_id"),
        user=F.col("role"),
        message=chat_text(),
        reputation=F.col("turn"),
        arrived=_chat_time(),
    )
    offset = F.col("conv_id") * 1000 + F.col("turn")
    sent = conversations.select(*_message("chats", offset, value, _chat_time()), *more, *([] if lane is None else [lane.cast("int").alias("lane")]))
    return sent if lane is None else sent.withColumn("partition", F.col("lane")).drop("lane")


def chat_rows(conversations: DataFrame) -> DataFrame:
    """Turns as source rows of chats."""
    return conversations.select(
        F.lit("trollboxMessage").alias("kind"), F.col("conv_id").alias("number"), F.col("role").alias("user"),
        chat_text().alias("message"), F.col("turn").alias("reputation"),
    )
