"""The registered queries over the test tables, each beside its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsebar.functions import clock, text
from pulsebar.layout import CALC_VALUES, CHATS, POSTS, TICKS, Feed
from pulsebar.operators import calc, cells, parse, rollup, sequence
from pulsebar.plans import feeds, jobs
from pulsebar.plans.feeds import BASE, DOCUMENT_WORDS, EVENT_PAIR, EVENT_WORDS, TEXT_WORDS
from pulsebar.sources import series, tables, workdir
from pulsebar.sources.messages import keep, read_messages, stream_messages
from pulsebar.sources.workdir import new_folder
from pulsebar.streaming import landing
from pulsebar.streaming import rollup as stream_rollup

Query = Callable[[SparkSession, str], DataFrame]

DAY = clock.DAY_SECONDS
# ranges the range queries read: whole days, and a replay that starts mid-day
HISTORY = (BASE + 5 * DAY, BASE + 20 * DAY)
SCAN = (BASE + 3 * DAY + 3600, BASE + 10 * DAY)
#: a zone with summer time
ZONE = "Europe/Zurich"
REPLAY = (BASE + 4 * DAY + 1800, BASE + 9 * DAY + 5400)


def _rounded(frame: DataFrame) -> DataFrame:
    return frame.withColumn("last", F.round("last", 6))


def _readable(frame: DataFrame, column: str) -> DataFrame:
    """Wall-clock times as text, which every engine writes the same way."""
    return frame.withColumn(column, clock.civil_text(F.col(column)))


# -- roll-ups -----------------------------------------------------------------


def price_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = feeds.event_ticks(feeds.table(spark, sf_dir, "events"))
    return _rounded(rollup.price(ticks, EVENT_PAIR))


def price_5m_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(rollup.price_from_cells(_tick_cells(spark, sf_dir), EVENT_PAIR))


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_5m(spark, sf_dir).orderBy("key").limit(20)


def message_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.message_count(feeds.event_posts(feeds.table(spark, sf_dir, "events")))


def keyword_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = feeds.event_posts(feeds.table(spark, sf_dir, "events"))
    return rollup.keyword_count(posts, EVENT_WORDS)


def social_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.social(feeds.event_posts(feeds.table(spark, sf_dir, "events")), EVENT_WORDS)


def social_documents_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = feeds.document_posts(feeds.table(spark, sf_dir, "documents"))
    return rollup.social(posts, DOCUMENT_WORDS)


def _calc(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    counts = rollup.social(feeds.event_posts(events), EVENT_WORDS)
    return counts, rollup.price(feeds.event_ticks(events), EVENT_PAIR)


def calc_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(calc.combine(*_calc(feeds.table(spark, sf_dir, "events"))))


def _landed_events(spark: SparkSession, sf_dir: str) -> str:
    """A root where the events are landed by backfill, as ticks and as posts."""
    root = new_folder(spark, "events")
    events = feeds.table(spark, sf_dir, "events")
    jobs.backfill(feeds.tick_messages(events), TICKS, root)
    jobs.backfill(feeds.event_post_messages(events), POSTS, root)
    return root


def _rolled_up(spark: SparkSession, sf_dir: str) -> str:
    root = _landed_events(spark, sf_dir)
    jobs.roll_up_social(spark, root, *HISTORY, keywords=EVENT_WORDS)
    jobs.roll_up_price(spark, root, *HISTORY, pair=EVENT_PAIR)
    return root


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land, roll up, read back."""
    return _readable(_rounded(jobs.history(spark, _rolled_up(spark, sf_dir), *HISTORY)), "date_time")


def history_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the wall clock of a zone that has summer time."""
    shown = jobs.history(spark, _rolled_up(spark, sf_dir), *HISTORY, zone=ZONE)
    return _readable(_rounded(shown), "date_time")


def calc_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of the calculated table as cells."""
    stored = series.read_calc(spark, _rolled_up(spark, sf_dir), *HISTORY)
    return calc.as_cells(stored).where("qualifier <> 'last'")


def price_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roll up, replay with corrections, roll up again: no value of a corrected bucket is left of the first time."""
    root, events = new_folder(spark, "corrected"), feeds.table(spark, sf_dir, "events")
    for sent in (feeds.tick_messages(events), feeds.corrected_ticks(events)):
        jobs.backfill(sent, TICKS, root)
        jobs.roll_up_price(spark, root, BASE, BASE + 400 * DAY, EVENT_PAIR)
    return _rounded(series.read_calc(spark, root).select("key", "last"))


def price_recounted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by counting only the buckets that each job has touched."""
    root, events = new_folder(spark, "recounted"), feeds.table(spark, sf_dir, "events")
    for sent in (feeds.tick_messages(events), feeds.corrected_ticks(events)):
        jobs.backfill(sent, TICKS, root)
        series.recount(spark, root, series.price(EVENT_PAIR))
    return _rounded(series.read_calc(spark, root).select("key", "last"))


def price_1h_from_5m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly means folded from the stored five-minute buckets."""
    shown = series.read_calc(spark, _rolled_up(spark, sf_dir), *HISTORY, width=3600)
    return _rounded(shown.where("last IS NOT NULL").select("key", "last"))


def history_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = _calc(feeds.table(spark, sf_dir, "events"))
    return _rounded(calc.append(*frames).na.fill(0, list(CALC_VALUES)))


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = feeds.table(spark, sf_dir, "orders")
    updates = orders.select(
        F.col("o_custkey").alias("key"),
        F.col("o_orderkey").alias("version"),
        F.col("o_orderkey").alias("messages"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")).alias("btc"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey")).alias("bitcoin"),
        F.col("o_totalprice").alias("last"),
    )
    return calc.latest(updates).na.fill(0, list(CALC_VALUES))


# -- raw rows -----------------------------------------------------------------


def row_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = feeds.event_ticks(feeds.table(spark, sf_dir, "events"))
    return sequence.with_row_key(sequence.number_in_second(ticks)).select(
        F.col("offset").alias("event_id"), "row_key"
    )


def chat_row_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = feeds.chat_messages(feeds.table(spark, sf_dir, "conversations"))
    chats = parse.accepted(parse.parse(messages, CHATS))
    return sequence.with_row_key(sequence.number_in_second(chats)).select("offset", "row_key")


def _parsed_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks that went over the wire: parsed, keyed, with the texts their cells need."""
    messages = feeds.tick_messages(feeds.table(spark, sf_dir, "events"))
    return sequence.with_row_key(sequence.number_in_second(parse.accepted(parse.parse(messages, TICKS))))


def _tick_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.with_row_key(
        sequence.number_in_second(feeds.tick_rows(feeds.table(spark, sf_dir, "events")))
    )


def _tick_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.melt(_tick_rows(spark, sf_dir), TICKS)


def cells_melt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.melt(_parsed_ticks(spark, sf_dir), TICKS)


def cells_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.explode_lines(cells.cell_lines(_tick_rows(spark, sf_dir), TICKS))


def cells_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.widen(_tick_cells(spark, sf_dir), ["currencypair", "last", "isfrozen"])


def _all_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = feeds.tick_rows(feeds.table(spark, sf_dir, "events"))
    posts = parse.accepted(
        parse.parse(feeds.post_messages(feeds.table(spark, sf_dir, "documents")), POSTS)
    )
    chats = parse.accepted(
        parse.parse(feeds.chat_messages(feeds.table(spark, sf_dir, "conversations")), CHATS)
    )
    return calc.append(
        cells.melt(ticks, TICKS, "offset"),
        cells.melt(posts, POSTS, "offset"),
        cells.melt(chats, CHATS, "offset"),
    )


def family_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.family_profile(_all_cells(spark, sf_dir))


def family_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.of_family(_all_cells(spark, sf_dir), CHATS.family)


def range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "range-scan")
    jobs.backfill(feeds.tick_messages(feeds.table(spark, sf_dir, "events")), TICKS, root)
    return tables.scan(spark, root, TICKS, *SCAN).select("offset", "pair", "last", "epoch_s")


def cells_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells whose JSON has whole numbers as such, read with the schema inferred from all of them."""
    stored = _tick_cells(spark, sf_dir)
    number, head = F.col("value").try_cast("bigint"), [F.col("row").cast("bigint").alias("row"), "columnFamily", "qualifier"]
    whole = F.to_json(F.struct(*head, number.alias("value")))
    line = F.when(number.isNotNull(), whole).otherwise(F.to_json(F.struct(*head, "value")))
    found = cells.explode_inferred(stored.select(line.alias("lines")))
    return found.select("row", "columnFamily", "qualifier", "value")


def _replayed(messages: DataFrame, feed: Feed, start: int, stop: int) -> DataFrame:
    """Two backfills over overlapping halves of a range, read back."""
    spark, third = messages.sparkSession, (stop - start) // 3
    root = new_folder(spark, f"replay-{feed.name}")
    jobs.backfill(messages, feed, root, start, start + 2 * third)
    jobs.backfill(messages, feed, root, start + third, stop)
    return tables.read_rows(spark, root, feed)


def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = feeds.tick_messages(feeds.table(spark, sf_dir, "events"))
    return _replayed(messages, TICKS, *REPLAY).select("offset", "pair", "last", "epoch_s", "row_key")


def backfill_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range, and then whatever it has left out on either side."""
    root, messages = new_folder(spark, "resume"), feeds.tick_messages(feeds.table(spark, sf_dir, "events"))
    jobs.backfill(messages, TICKS, root, *REPLAY)
    jobs.backfill(messages, TICKS, root, resume=True)
    return tables.read_rows(spark, root, TICKS).select("offset", "pair", "last", "epoch_s", "row_key")


def offsets_covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranges of offsets a backfill of a range has looked at."""
    root, messages = new_folder(spark, "covered"), feeds.tick_messages(feeds.table(spark, sf_dir, "events"))
    jobs.backfill(messages, TICKS, root, *REPLAY)
    return tables.read_covered(spark, root, TICKS)


def backfill_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = feeds.table(spark, sf_dir, "documents")
    last = BASE + documents.agg(F.max("doc_id")).first()[0] * feeds.STEP
    rows = _replayed(feeds.post_messages(documents), POSTS, BASE - 1, last)
    return _readable(rows.drop("topic", "partition", "day", "texts"), POSTS.time)


def backfill_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = feeds.table(spark, sf_dir, "conversations")
    last = BASE + conversations.agg(F.max("conv_id")).first()[0]
    rows = _replayed(feeds.chat_messages(conversations), CHATS, BASE - 1, last)
    return _readable(rows.drop("topic", "partition", "day", "texts"), CHATS.time)


def tick_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks of a feed whose clock runs in a zone with summer time."""
    messages = feeds.tick_messages(feeds.table(spark, sf_dir, "events"))
    rows = parse.accepted(parse.parse(messages, TICKS, ZONE))
    return rows.select("offset", "epoch_s", F.col("day").cast("string").alias("day"))


def produce_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as source rows: filtered, encoded, kept as message files, landed."""
    root = new_folder(spark, "produce")
    rows = feeds.post_rows(feeds.table_stream(spark, sf_dir, "documents"))
    jobs.produce(
        rows, POSTS, lambda batch: keep(batch, f"{root}/posts-topic"), f"{root}/progress",
        words=TEXT_WORDS, trigger=landing.CATCH_UP,
    ).awaitTermination()
    sent = read_messages(spark, "parquet", path=f"{root}/posts-topic")
    jobs.backfill(sent, POSTS, root)
    rows = tables.read_rows(spark, root, POSTS)
    return _readable(rows.drop("topic", "partition", "offset", "row_key", "day", "texts"), POSTS.time)


def produce_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as source rows of ticks: stamped with the time they arrive, encoded, kept as message files, landed."""
    fields = {name: field for name, field in feeds.tick_fields().items() if name != "arrived"}
    rows = feeds.table_stream(spark, sf_dir, "events").select(*[field.alias(name) for name, field in fields.items()])
    return _produced(rows, TICKS)


def produce_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _produced(feeds.chat_rows(feeds.table_stream(spark, sf_dir, "conversations")), CHATS)


def _produced(rows: DataFrame, feed: Feed) -> DataFrame:
    """What lands of rows that are sent now: all but the time and what follows from it."""
    spark, root = rows.sparkSession, new_folder(rows.sparkSession, "produce")
    put = lambda batch: keep(batch, f"{root}/topic")
    jobs.produce(rows, feed, put, f"{root}/progress", trigger=landing.CATCH_UP).awaitTermination()
    jobs.backfill(read_messages(spark, "parquet", path=f"{root}/topic"), feed, root)
    own = [name for name in feed.cells.values() if name != feed.time]
    return tables.read_rows(spark, root, feed).select(*own)


# -- wire format --------------------------------------------------------------


def encode_post(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.post_messages(feeds.table(spark, sf_dir, "documents")).select("offset", "value")


def encode_tick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.tick_messages(feeds.table(spark, sf_dir, "events")).select("offset", "value")


def encode_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.chat_messages(feeds.table(spark, sf_dir, "conversations")).select("offset", "value")


def _parsed(messages: DataFrame, feed: Feed) -> DataFrame:
    rows = parse.accepted(parse.parse(messages, feed))
    return _readable(rows.drop("topic", "partition", "day", "texts"), feed.time)


def parse_post(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(feeds.post_messages(feeds.table(spark, sf_dir, "documents")), POSTS)


def parse_tick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(feeds.tick_messages(feeds.table(spark, sf_dir, "events")), TICKS)


def parse_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(feeds.chat_messages(feeds.table(spark, sf_dir, "conversations")), CHATS)


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = feeds.careless_post_messages(feeds.table(spark, sf_dir, "documents"))
    return parse.rejects(parse.parse(messages, POSTS), POSTS)


def track_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = feeds.table(spark, sf_dir, "documents")
    return documents.where(text.tracked(F.col("text"), TEXT_WORDS)).select("doc_id", "text")


def printable(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = feeds.table(spark, sf_dir, "documents")
    return documents.select("doc_id", text.printable(F.col("text")).alias("text"))


# -- streams ------------------------------------------------------------------
# Each runs over all files of its table, stops, and gives the table it wrote.


def _landed(messages: DataFrame, feed: Feed) -> DataFrame:
    spark = messages.sparkSession
    root = new_folder(spark, f"stream-{feed.name}")
    landing.land(messages, feed, root, trigger=landing.CATCH_UP).awaitTermination()
    rows = tables.read_rows(spark, root, feed).drop("topic", "partition", "day", "texts")
    return _readable(rows, feed.time)


def stream_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(feeds.post_messages(feeds.table_stream(spark, sf_dir, "documents")), POSTS)


def stream_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(feeds.tick_messages(feeds.table_stream(spark, sf_dir, "events")), TICKS)


def stream_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(feeds.chat_messages(feeds.table_stream(spark, sf_dir, "conversations")), CHATS)


def stream_row_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chats dealt over files and partitions, so that each second comes back in later batches,
    with a restart in between."""
    root = new_folder(spark, "stream-keys")
    dealt = feeds.table(spark, sf_dir, "conversations").withColumn("turn_file", F.col("turn") % 3)
    sent = feeds.chat_messages(dealt, F.col("turn") % 2, "turn_file").where("turn_file < 2").drop("turn_file")
    rest = feeds.chat_messages(dealt, F.col("turn") % 2, "turn_file").where("turn_file = 2").drop("turn_file")
    for part in (sent, rest):
        part.repartition(3, "offset").write.mode("append").parquet(f"{root}/in")
        new = stream_messages(spark, "parquet", path=f"{root}/in", maxFilesPerTrigger="1")
        landing.land(new, CHATS, root, trigger=landing.CATCH_UP).awaitTermination()
    rows = tables.read_rows(spark, root, CHATS)
    # which of a second's keys a message has hangs on the batch it came in; the keys themselves do not
    return rows.select("epoch_s", "row_key")


def _in_two_batches(frame: DataFrame, first, root: str) -> DataFrame:
    """A stream that gets the rows of ``first`` and then the others, in a batch each, whose files many tasks write and read."""
    spark = frame.sparkSession
    files = spark.sparkContext.defaultParallelism
    for place, part in enumerate((frame.where(first), frame.where(~first))):
        part.repartition(files, "offset").write.parquet(f"{root}/part-{place}")
        # a batch takes as many files as the first part has, and the second has no more
        if not place:
            files = sum(name.endswith(".parquet") for name in workdir.files(spark, f"{root}/part-0"))
    return spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", str(files)).parquet(f"{root}/part-*")


def stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks landed in several batches, packed in between and afterwards."""
    root, events = new_folder(spark, "packed"), feeds.table(spark, sf_dir, "events")
    sent = feeds.tick_messages(events)
    middle = F.col("offset") * 2 < events.agg(F.max("event_id")).first()[0]
    jobs.backfill(sent.where(middle), TICKS, root)
    tables.compact(spark, root, TICKS)
    landing.land(_in_two_batches(sent, middle, f"{root}/in"), TICKS, root, trigger=landing.CATCH_UP).awaitTermination()
    tables.compact(spark, root, TICKS)
    return _readable(tables.read_rows(spark, root, TICKS).drop("topic", "partition", "day", "texts"), TICKS.time)


def stream_social_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts of which the earlier ones come last, far behind the watermark: landed, they are counted by a recount."""
    root, events = new_folder(spark, "late"), feeds.table(spark, sf_dir, "events")
    sent, of = feeds.event_post_messages(events), series.social(EVENT_WORDS)
    late = _in_two_batches(sent, F.col("timestamp") >= F.lit("2024-01-16").cast("timestamp"), f"{root}/in")
    stream_rollup.publish(parse.accepted(parse.parse(late, POSTS)), root, of, landing.CATCH_UP).awaitTermination()
    landing.land(late, POSTS, root, trigger=landing.CATCH_UP).awaitTermination()
    series.recount(spark, root, of)
    return series.read_calc(spark, root).drop("last")


def _published(rows: DataFrame, of: series.Series) -> DataFrame:
    spark = rows.sparkSession
    root = new_folder(spark, f"stream-{of.name}")
    stream_rollup.publish(rows, root, of, landing.CATCH_UP).awaitTermination()
    return series.read_calc(spark, root)


def stream_social(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = feeds.post_messages(feeds.table_stream(spark, sf_dir, "documents"))
    posts = parse.accepted(parse.parse(messages, POSTS))
    return _published(posts, series.social(DOCUMENT_WORDS)).drop("last")


def stream_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = feeds.tick_messages(feeds.table_stream(spark, sf_dir, "events"))
    ticks = parse.accepted(parse.parse(messages, TICKS))
    return _rounded(_published(ticks, series.price(EVENT_PAIR)).select("key", "last"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        price_5m,
        price_5m_cells,
        preview,
        message_count,
        keyword_count,
        social_5m,
        social_documents_5m,
        calc_full,
        history,
        history_union,
        upsert_latest,
        row_key,
        chat_row_key,
        cells_melt,
        cells_explode,
        cells_wide,
        family_profile,
        family_scan,
        range_scan,
        backfill,
        backfill_posts,
        backfill_chats,
        backfill_resume,
        offsets_covered,
        tick_zone,
        price_corrected,
        price_recounted,
        price_1h_from_5m,
        cells_inferred,
        history_local,
        calc_cells,
        produce_posts,
        produce_ticks,
        produce_chats,
        encode_post,
        encode_tick,
        encode_chat,
        parse_post,
        parse_tick,
        parse_chat,
        rejects,
        track_filter,
        printable,
        stream_posts,
        stream_ticks,
        stream_chats,
        stream_row_key,
        stream_social,
        stream_social_late,
        stream_compacted,
        stream_price,
    )
}
